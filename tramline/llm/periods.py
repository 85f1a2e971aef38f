"""Maximal periodic runs of words by a dictionary of basic factors.

A run is a stretch of words with smallest period q, at least 2 q and ``least`` words long, that no
neighbouring word extends. The dictionary names all factors of 1, 2, 4, ... words of a text: equal
factors have equal names, and the name of a factor is that of the pair of its halves. Only factors
that their text repeats need a name, so the work falls from length to length as repeats do.

A run of period q repeats its first m words q later, m being the power of two with m <= q < 2 m. So
for each m the successive occurrences of a name less than 2 m apart propose all periods:

* Occurrences at most m / 2 apart lie in arithmetic progressions whose difference p is the period of
  the factor. Two places of one progression propose nothing: what lies between has the period p.
* At most a few progressions (or single occurrences) of a name begin within 2 m words. The distances
  between the members of two of them are a progression again, with difference p; the part of it from
  m to 2 m - 1 are the proposed periods, each with one pair of places.

Each proposal is extended to both sides by the dictionary, largest factors first. A stretch found with
several periods has the smallest of them, since all true runs are proposed. The docstring's bounds
make the number of proposals of each m at most proportional to the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.words import Words, text_slices


def word_names(words: Words) -> np.ndarray:
    """Equal numbers for equal words, compared by their bytes."""
    length = words.ends - words.starts
    ends = np.cumsum(length)
    inside = np.repeat(words.starts - ends + length, length) + np.arange(int(length.sum()))
    data = pa.py_buffer(words.bytes[inside])
    offsets = pa.py_buffer(np.append(0, ends).astype(np.int64))
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, offsets, data])
    return column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def repeated(keys: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of all ``n`` places, -1 where the key at that place (``at``) occurs once; places with a name by (name, place)."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = sorted_keys[1:] != sorted_keys[:-1]
    often = ~(new[:-1] & new[1:])
    name = np.cumsum(new[:-1]) - 1
    places, named = at[order[often]], name[often]
    names = np.full(n, -1, np.int32)
    names[places] = named
    return names, places, named


def factors(words: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The dictionary, a table for each power of two while a text repeats a factor of that length."""
    n, m = len(words), 1
    if not n:
        return
    names, places, named = repeated(row * (int(words.max()) + 1) + words, np.arange(n), n)
    while len(places):
        yield names, places, named
        left = np.sort(places)
        left = left[left + m < n]
        right = names[left + m]
        both = right >= 0  # names tell texts apart, so do pairs of them but at a text's end
        both &= row[left] == row[np.minimum(left + m, n - 1)]
        left = left[both]
        keys = names[left].astype(np.int64) * n + names[left + m]
        m *= 2
        names, places, named = repeated(keys, left, n)


def proposals(places: np.ndarray, named: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) proposed by the occurrences of factors of ``m`` words, m <= period < 2 m."""
    if len(places) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = np.diff(places)
    same = named[1:] == named[:-1]
    tied = same & (gap <= m // 2)
    head = np.flatnonzero(np.append(True, ~tied))
    size = np.diff(np.append(head, len(places)))
    step = np.where(size > 1, np.append(gap, 0)[head], 0)
    first, name = places[head], named[head]
    last = first + step * (size - 1)
    out_place, out_period = [], []
    for apart in range(1, len(head)):
        a = np.flatnonzero((name[apart:] == name[:-apart]) & (first[apart:] - last[:-apart] < 2 * m))
        if not len(a):
            break
        b = a + apart
        base = first[b] - last[a]
        p = np.maximum(np.maximum(step[a], step[b]), 1)
        low = np.maximum(-(-(m - base) // p), 0)
        high = np.minimum((2 * m - 1 - base) // p, size[a] + size[b] - 2)
        count = np.maximum(high - low + 1, 0)
        pair = np.repeat(np.arange(len(a)), count)
        j = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count) + low[pair]
        back = np.minimum(j, size[a][pair] - 1)
        out_place.append(last[a][pair] - back * step[a][pair])
        out_period.append(base[pair] + j * p[pair])
    if not out_place:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_place), np.concatenate(out_period)


def extended(tables: list[np.ndarray], place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of the stretch around ``place`` in which words ``period`` apart are equal."""
    n = len(tables[0])
    end, start = place.copy(), place.copy()
    for k in range(len(tables) - 1, -1, -1):
        names, m = tables[k], 1 << k
        # the largest factors may fit many times, the others once at most
        active = np.arange(len(place))
        while len(active):
            at = end[active]
            ok = at + period[active] < n
            at = np.where(ok, at, 0)
            left = names[at]
            ok &= (left >= 0) & (left == names[np.minimum(at + period[active], n - 1)])
            active = active[ok]
            end[active] += m
            if k < len(tables) - 1:
                break
        active = np.arange(len(place))
        while len(active):
            at = start[active] - m
            ok = at >= 0
            at = np.maximum(at, 0)
            left = names[at]
            ok &= (left >= 0) & (left == names[np.minimum(at + period[active], n - 1)])
            active = active[ok]
            start[active] -= m
            if k < len(tables) - 1:
                break
    return start, end + period


def find_runs(words: np.ndarray, row: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end, period) of every run of texts laid end to end, by first word and period."""
    tables, found = [], []
    for names, places, named in factors(words, row):
        tables.append(names)
        found.append(proposals(places, named, 1 << len(tables) - 1))
    if not tables:
        return (np.zeros(0, np.int64),) * 3
    place, period = (np.concatenate(x) for x in zip(*found, strict=True))
    start, end = extended(tables, place, period)
    long = (end - start >= 2 * period) & (end - start >= least)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)  # of a stretch's periods the smallest
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def periodic_runs(
    docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, n_words long, runs array<struct<start, length, period>>, collapsed string) for every row.

    Words are runs of bytes other than space and U+0009 to U+000D; ``runs`` are ordered by start and
    period and number words from 0. ``collapsed`` has the words that no run contains after its first
    period, joined by one space. Null and empty texts have no words, no runs and an empty
    ``collapsed``; null ids and repeated rows are rows like others. Other columns are not read.
    A task holds 4 MB of text, or one text, and four bytes a word for every power of two up to the
    longest repeat in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "t"):
            words = Words(batch.column("t"), lower=False)
            start, end, period = find_runs(word_names(words), words.row, least)
            of = np.searchsorted(words.first, start, "right") - 1
            drop = np.zeros(len(words) + 1, np.int64)
            np.add.at(drop, start + period, 1)
            np.add.at(drop, end, -1)
            kept = np.cumsum(drop)[:-1] == 0
            values = [pa.array(x.astype(np.int64)) for x in (start - words.first[of], end - start, period)]
            ends = np.searchsorted(of, np.arange(batch.num_rows + 1))
            structs = pa.StructArray.from_arrays(values, ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
            n = pa.array(words.counts.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), n, lists, joined(words, kept)], ["id", "n_words", "runs", "collapsed"]
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    runs = "array<struct<start:bigint,length:bigint,period:bigint>>"
    found = rows.mapInArrow(run, f"id {kind}, n_words long, runs {runs}, collapsed string")
    return found.withColumnRenamed("id", id_col)


def joined(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each row with one space between them."""
    at = np.flatnonzero(kept)
    row = words.row[at]
    last = np.ones(len(at), bool)
    last[:-1] = row[1:] != row[:-1]
    length = words.ends[at] - words.starts[at]
    wide = length + ~last
    ends = np.cumsum(wide)
    inside = np.repeat(words.starts[at] - ends + wide, wide) + np.arange(int(wide.sum()))
    data = words.bytes[inside]
    data[(ends - 1)[~last]] = 0x20
    offsets = np.append(0, ends)[np.searchsorted(row, np.arange(len(words.first)))]
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    return pa.LargeStringArray.from_buffers(len(words.first) - 1, buffers[1], buffers[2]).cast(pa.string())
