"""Language-model scoring with a weighted backoff automaton.

The model is an n-gram model with absolute discounting and backoff. Its states are the histories
of kept n-grams; a kept n-gram is an arc with a weight, and every state has a failure arc to the
longest shorter history that is a state, with the backoff weight. One left-to-right traversal
carries the state of each text and adds up log10 weights; the texts of a slice advance together.

``score_corpus``, which the query uses, keeps every n-gram: arcs and failure arcs are looked up by group, place by
place, and the model is in no one place. ``train`` and ``score`` are for a bounded model. There, statistics cover all
training rows, and only tables of proven size are broadcast:

* Word counts are exact for every word, however rare. The at most ``1 / word_share`` words with
  that share of all tokens are the automaton's alphabet.
* An n-gram of two or more words is kept when its count is at least ``share`` of all training
  tokens, so there are at most ``1 / share`` of each length at any input size. To find them
  without shuffling all n-grams, ``BUCKETS`` hashed sums per length are taken first; an n-gram
  whose bucket stays below the limit cannot reach it. The others are counted exactly.
* A word below its share occurs in no kept n-gram. The traversal backs off to the empty history
  there; what is left, the word's own log10 weight, is joined from the exact counts by hash, where
  no key can hold more than ``word_share`` of the training tokens.

The empty history gives a word of count c the weight (c + 1) / (N + V + 1), for N training tokens
and V distinct ones, which leaves one share for unknown words: the weights of a state add up to one.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.graph import discard, release
from tramline.llm.words import Words, join_hashes, mix, text_slices, windows, within_rows
from tramline.session import stage

END = np.uint64(0x5DEECE66D1234567)  # the hash that stands for the end of a text
SLICE = 8 << 20  # bytes of text that advance together
BUCKETS = 1 << 20
COMMON = 4e-6  # share of the training tokens from which an n-gram's count is broadcast
KNOWN_WORDS = 2e-7  # and a word's, for the groups of ``score_corpus``: at most 5 million, 16 bytes each
POSITIONS = 1 << 19  # places of texts in a group
HOT = 0.25  # of a group; a word with more places has them in many groups
PLACE_SLICE = 2 << 20  # bytes of text whose places are dealt together: some 20 arrays of 8 bytes a word stand at once
PASSES = 3  # over the texts; each settles the places of a part of the histories, and what it staged goes
WIDE = 32  # bucket sums in one row
DISCOUNT = 0.5


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token, and where each text begins; the end is the last token of each text."""
    w = Words(column, lower=True)
    return np.insert(w.hashes(), w.first[1:], END), w.first + np.arange(len(w.first))


@dataclass
class Automaton:
    """Arrays of the automaton; state 0 is the empty history."""

    words: np.ndarray  # sorted hashes of the alphabet
    own: np.ndarray  # log10 weight of each word after the empty history
    home: np.ndarray  # state after a word alone
    arcs: np.ndarray  # sorted state * len(words) + word
    weight: np.ndarray
    target: np.ndarray
    fail: np.ndarray
    backoff: np.ndarray  # log10 weight of the failure arc
    to_empty: np.ndarray  # sum of the backoffs down to the empty history

    def word_ids(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, at, -1)

    def score(self, word: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log10 weight of each text, without the own weight of words outside the alphabet."""
        if not len(self.arcs):  # the only state is the empty history
            own = np.append(self.own, 0.0)[word]  # -1, outside the alphabet, finds the last
            return np.add.reduceat(own, first[:-1]) if len(first) > 1 else np.zeros(0)
        length = np.diff(first)
        order = np.argsort(-length, kind="stable")
        begin, ends = first[:-1][order], np.sort(-length)
        total = np.zeros(len(order))
        state = np.zeros(len(order), np.int64)
        arcs = self.arcs if len(self.arcs) else np.array([-1])
        for t in range(int(length.max(initial=0))):
            active = int(np.searchsorted(ends, -t, "left"))
            w, s = word[begin[:active] + t], state[:active].copy()
            outside = w < 0
            total[:active][outside] += self.to_empty[s[outside]]
            s[outside] = 0
            open_ = np.flatnonzero(~outside & (s > 0))
            after = np.where(outside, 0, self.home[w]) if len(self.home) else np.zeros(active, np.int64)
            gain = np.where(outside, 0.0, self.own[w]) if len(self.own) else np.zeros(active)
            while len(open_):
                key = s[open_] * len(self.words) + w[open_]
                at = np.minimum(np.searchsorted(arcs, key), len(arcs) - 1)
                hit = arcs[at] == key
                gain[open_[hit]], after[open_[hit]] = self.weight[at[hit]], self.target[at[hit]]
                open_ = open_[~hit]
                total[open_] += self.backoff[s[open_]]
                s[open_] = self.fail[s[open_]]
                open_ = open_[s[open_] > 0]
            total[:active] += gain
            state[:active] = after
        result = np.empty(len(order))
        result[order] = total
        return result


def build(words: np.ndarray, counts: np.ndarray, kept: dict[tuple[int, ...], int], n: int, v: int) -> Automaton:
    """words: hashes of the alphabet; kept: counts of the n-grams of two or more word numbers."""
    order = np.argsort(words)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    words, counts = words[order], counts[order]
    kept = {tuple(int(number[w]) for w in gram): c for gram, c in kept.items()}
    history = {gram[:-1] for gram in kept}
    # Histories of one word need a count, which the alphabet has; longer ones are kept themselves.
    states = {(): 0} | {h: i + 1 for i, h in enumerate(sorted(history, key=lambda h: (len(h), h)))}

    def suffix(gram: tuple[int, ...]) -> int:
        while gram not in states:
            gram = gram[1:]
        return states[gram]

    def count(gram: tuple[int, ...]) -> int:
        return int(counts[gram[0]]) if len(gram) == 1 else kept[gram]

    own = np.log10((counts + 1) / (n + v + 1))
    names = list(states)
    fail = np.array([suffix(h[1:]) if h else 0 for h in names], np.int64)
    linear = {gram: (c - DISCOUNT) / count(gram[:-1]) for gram, c in kept.items()}
    after: dict[tuple[int, ...], list[int]] = {}
    for gram in kept:
        after.setdefault(gram[:-1], []).append(gram[-1])
    backoff = np.zeros(len(names))

    def probability(h: tuple[int, ...], w: int) -> float:
        """Of a word after a history whose shorter ones have their backoff already."""
        factor = 1.0
        while h:
            if (p := linear.get((*h, w))) is not None:
                return factor * p
            if h in states:
                factor *= 10 ** backoff[states[h]]
            h = h[1:]
        return factor * 10 ** own[w]

    for i, h in enumerate(names[1:], 1):  # shorter histories first
        direct = sum(linear[(*h, w)] for w in after[h])
        lower = sum(probability(h[1:], w) for w in after[h])
        backoff[i] = math.log10((1 - direct) / (1 - lower))
    to_empty = np.zeros(len(names))
    for i in range(1, len(names)):
        to_empty[i] = backoff[i] + to_empty[fail[i]]
    arcs = np.array([states[g[:-1]] * len(words) + g[-1] for g in kept], np.int64)
    sort = np.argsort(arcs)
    weight = np.array([math.log10(linear[g]) for g in kept], float)
    target = np.array([suffix(g if g in states else g[1:]) for g in kept], np.int64)
    home = np.array([states.get((w,), 0) for w in range(len(words))], np.int64)
    return Automaton(words, own, home, arcs[sort], weight[sort], target[sort], fail, backoff, to_empty)


@dataclass
class Model:
    automaton: Automaton
    counts: DataFrame  # (k, c) of every training word, staged
    n: int
    v: int
    least: float  # count from which a word is in the alphabet


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("t"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(k, c) of every word, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "t", SLICE):
            keys, n = np.unique(tokens(batch.column("t"))[0], return_counts=True)
            yield pa.RecordBatch.from_pydict({"k": keys.view(np.int64), "c": n})

    return texts.mapInArrow(run, "k long, c long").groupBy("k").agg(F.sum("c").alias("c"))


def bucket_sums(texts: DataFrame, order: int) -> DataFrame:
    """(size, row, s0..): n-gram counts by hash bucket, ``WIDE`` buckets to a row."""
    names = [f"s{i}" for i in range(WIDE)]

    def run(batches):
        sums = {size: np.zeros(BUCKETS, np.int64) for size in range(2, order + 1)}
        for batch in text_slices(batches, "t"):
            h, first = tokens(batch.column("t"))
            for size, total in sums.items():
                grams = windows(h, size)[within_rows(first, size)]
                total += np.bincount((grams % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        for size, total in sums.items():
            table = total.reshape(-1, WIDE)
            at = np.flatnonzero(table.any(axis=1))
            for cut in np.array_split(at, max(1, len(at) >> 13)):
                columns = {"size": np.full(len(cut), size, np.int32), "row": cut.astype(np.int32)}
                yield pa.RecordBatch.from_pydict(columns | {c: table[cut, i] for i, c in enumerate(names)})

    schema = "size int, row int, " + ", ".join(f"{c} long" for c in names)
    return texts.mapInArrow(run, schema).groupBy("size", "row").agg(*(F.sum(c).alias(c) for c in names))


def kept_ngrams(texts: DataFrame, order: int, least: float) -> DataFrame:
    """(w0..., c): n-grams of 2 to ``order`` words with a count of ``least`` or more, short ones ending in nulls."""
    sums = bucket_sums(texts, order)
    each = F.posexplode(F.array(*(f"s{i}" for i in range(WIDE)))).alias("i", "n")
    heavy = sums.select("size", "row", each).where(F.col("n") >= least)
    passes = np.zeros((order + 1, BUCKETS), bool)  # at most 1/share buckets reach the limit
    for r in heavy.select("size", (F.col("row") * WIDE + F.col("i")).alias("b")).toLocalIterator():
        passes[r.size, r.b] = True
    packed = texts.sparkSession.sparkContext.broadcast(np.packbits(passes, axis=1))
    names = [f"w{i}" for i in range(order)]

    def run(batches):
        table = np.unpackbits(packed.value, axis=1).astype(bool)
        for batch in text_slices(batches, "t", SLICE):
            h, first = tokens(batch.column("t"))
            for size in range(2, order + 1):
                at = within_rows(first, size)
                grams = windows(h, size)[at]
                hit = table[size][(grams % np.uint64(BUCKETS)).astype(np.int64)]
                _, place, n = np.unique(grams[hit], return_index=True, return_counts=True)
                begin = at[hit][place]
                arrays = [pa.array(h[begin + i].view(np.int64)) if i < size else pa.nulls(len(n), pa.int64()) for i in range(order)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(n)], [*names, "c"])

    rows = texts.mapInArrow(run, ", ".join(f"{c} long" for c in names) + ", c long")
    return rows.groupBy(*names).agg(F.sum("c").alias("c")).where(F.col("c") >= least)


def train(
    docs: DataFrame, text_col: str = "text", order: int = 3, share: float = 4e-6, word_share: float = 1e-6
) -> Model:
    """The model of all texts of ``docs``; null texts are empty ones. No rows give an empty model."""
    texts = _texts(docs, text_col)
    counts = stage(word_counts(texts), "word_counts")
    release(counts)
    totals = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = totals.n or 0, totals.v
    least = max(word_share * n, 1)
    table = counts.where(F.col("c") >= least).toArrow()  # at most 1/word_share rows
    words, c = table["k"].to_numpy().view(np.uint64), table["c"].to_numpy()
    number = {int(w): i for i, w in enumerate(words)}
    kept = {}
    if order > 1 and n:
        found = kept_ngrams(texts, order, max(share, word_share) * n).toArrow()  # at most 1/share rows a length
        for *gram, times in zip(*(found[c].to_pylist() for c in found.column_names), strict=True):
            kept[tuple(number[w & (1 << 64) - 1] for w in gram if w is not None)] = times
    return Model(build(words, c, kept, n, v), counts, n, v, least)


def score(model: Model, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, n_known, base_score, score) for every row of ``docs``.

    Null texts are empty: one token, the end. Null ids are kept; each of several equal rows gets
    its own result row. Other columns are not read; an empty table gives no rows.
    """
    return _summed(model, _scored(model, docs, id_col, text_col), id_col)


def _scored(model: Model, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """What the automaton says of the rows of ``docs``, staged."""
    automaton = docs.sparkSession.sparkContext.broadcast(model.automaton)

    def run(batches):
        model = automaton.value
        for batch in text_slices(batches, "t", SLICE):
            h, first = tokens(batch.column("t"))
            word = model.word_ids(h)
            known = word >= 0
            length = np.diff(first)
            own = np.where(known, model.own[word], 0.0) if len(model.own) else np.zeros(len(word))
            yield _rows(
                batch, np.arange(batch.num_rows), None, np.ones(batch.num_rows, np.int64), length,
                np.add.reduceat(known.astype(np.int64), first[:-1]), np.add.reduceat(own, first[:-1]), model.score(word, first),
            )
            row = np.repeat(np.arange(batch.num_rows), length)[~known]
            rare = h[~known]
            order = np.lexsort((rare, row))
            row, rare = row[order], rare[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (rare[1:] != rare[:-1])
            at = np.flatnonzero(new)
            yield _rows(batch, row[at], rare[at].view(np.int64), np.diff(np.append(at, len(row))))

    names = F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")
    rows = docs.select(*names).withColumn("h", F.xxhash64("t"))
    schema = "id long, h long, k long, m long, n_tokens long, n_known long, base double, score double"
    scored = stage(rows.mapInArrow(run, schema), "scored")
    release(scored)
    return scored


def _summed(model: Model, scored: DataFrame, id_col: str) -> DataFrame:
    """Sums by row."""
    whole = scored.where("k IS NULL").drop("k")
    rare = scored.where("k IS NOT NULL").select("id", "h", "k", "m")
    counts = model.counts.where(F.col("c") < model.least)
    rare = rare.join(counts, "k", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    base = F.col("m") * F.log10((F.col("c") + 1) / F.lit(float(model.n + model.v + 1)))
    rare = rare.select(
        "id", "h", F.lit(0).cast("long").alias("m"), F.lit(0).cast("long").alias("n_tokens"),
        F.when(F.col("c") > 0, F.col("m")).otherwise(0).cast("long").alias("n_known"), base.alias("base"), base.alias("score"),
    )
    # Equal rows were summed into one: share the sums out to as many rows again.
    sums = whole.unionByName(rare).groupBy("id", "h").agg(*(F.sum(c).alias(c) for c in ("m", "n_tokens", "n_known", "base", "score")))
    sums = sums.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    return sums.select(
        F.col("id").alias(id_col),
        F.expr("n_tokens div m").alias("n_tokens"),
        F.expr("n_known div m").alias("n_known"),
        (F.col("base") / F.col("m")).alias("base_score"),
        (F.col("score") / F.col("m")).alias("score"),
    )


def _bigram(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two words, as ``windows`` of size 2 gives it."""
    return mix(join_hashes(left, right) + np.uint64(2))


@dataclass
class Counts:
    """Sorted hashes and their counts."""

    keys: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray) -> Counts:
        order = np.argsort(keys)
        return cls(keys[order], counts[order])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Count of each key, 0 if it is not here."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)


def _places(batches, common, groups: int, turn: int):
    """For each slice of texts a batch of rows (bucket, slice, lists): its places by the group that settles them.

    A place is a word w, the one before it b and the hash p of the two before it (0: none), and t, twice the number of
    its text in the slice, plus one in a training text. A turn has the places of its
    share of the words b, so that bigrams, trigrams and histories (p) are each of one turn. Places with one word b
    meet in one group, unless b is hot. Those of a hot word meet by bigram (b, w); those of a common bigram, whose count is
    broadcast, by trigram, and common trigrams are not sent. A first row of each slice has the names of its texts, their tokens of this turn, and
    what places that are not sent add to their sums. A slice is told apart by a hash of its texts and its place.
    """
    context, hot = TaskContext.get(), common.get("hot")
    task = np.uint64(context.partitionId() if context else 0)
    for number, batch in enumerate(text_slices(batches, "t", PLACE_SLICE)):
        words, first = tokens(batch.column("t"))
        text = batch.column("h").to_numpy().view(np.uint64)
        ids = batch.column("id").fill_null(0).to_numpy().view(np.uint64)
        each = join_hashes(join_hashes(np.arange(len(text), dtype=np.uint64), text), ids)
        name = join_hashes(join_hashes(np.bitwise_xor.reduce(each, keepdims=True), task), np.uint64(number))
        before = np.roll(words, 1)
        before[first[:-1]] = mix(text + _ONE)
        here = np.flatnonzero(before % np.uint64(PASSES) == turn)
        row = np.repeat(np.arange(len(text)), np.diff(first))[here]
        nth, w, key = here - first[row], words[here], before[here]
        b = np.where(nth > 0, key, np.uint64(0))
        p = np.where(nth > 1, _bigram(words[here - 2], b), np.uint64(0))
        value = own = known = np.zeros(len(text))
        sent = np.arange(len(here))
        cb = hot.find(b) if hot else np.zeros(len(b), np.int64)
        at = np.flatnonzero(cb)
        if len(at):
            s = _bigram(b[at], w[at])
            three = np.where(nth[at] > 1, join_hashes(p[at], s), mix(text[row[at]] + _ONE))
            c2 = common["pairs"].find(s)
            c3 = np.where(nth[at] > 1, common["triples"].find(three), 0)
            key[at] = np.where(c2 > 0, three, s)
            v = np.zeros(len(at))
            after = (c2 > 0) & (w[at] != END)
            v[after] -= np.log10(c2[after])
            v[c3 > 0] += np.log10(c3[c3 > 0] - DISCOUNT)
            value = np.bincount(row[at], v, len(text))
            at = at[c3 > 0]
            own = np.bincount(row[at], np.log10((cb[at] + 1) / common["all"]), len(text)).astype(float)  # of no rows numpy gives whole numbers
            known = np.bincount(row[at], minlength=len(text))
            sent = np.delete(sent, at)
        bucket = (mix(key) % np.uint64(groups)).astype(np.uint16 if groups <= 1 << 16 else np.int64)[sent]
        order = np.argsort(bucket, kind="stable")
        sent, bucket = sent[order], bucket[order]
        begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else sent
        t = (2 * row + batch.column("learn").to_numpy(zero_copy_only=False)[row]).astype(np.int32)
        cuts = np.concatenate([[0, 0], begin[1:], [len(sent)]]) if len(begin) else np.zeros(2, np.int64)
        whole = np.append(0, np.full(len(cuts) - 1, len(text)))
        columns = {"bucket": np.append(name % np.uint64(groups), bucket[begin]).astype(np.int64)}
        columns["slice"] = np.full(len(cuts) - 1, name.view(np.int64)[0])
        sums = {"v": value, "base": own, "n_known": known.astype(np.int64), "n_tokens": np.bincount(row, minlength=len(text))}
        for c, x in {"id": batch.column("id"), "h": batch.column("h"), **sums}.items():
            columns[c] = pa.ListArray.from_arrays(pa.array(whole, pa.int32()), pa.array(x))
        for c, x in (("t", t), ("p", p), ("b", b), ("w", w)):
            x = x[sent]
            columns[c] = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x.view(np.int64) if x.dtype == np.uint64 else x))
        yield pa.RecordBatch.from_pydict(columns)


_ONE = np.uint64(1)
NAMED = "id array<long>, h array<long>, v array<double>, base array<double>, n_known array<long>, n_tokens array<long>"
PLACES = f"bucket long, slice long, {NAMED}, t binary, p binary, b binary, w binary"
FOUND = f"kind int, slice long, {NAMED}, ts binary, vs binary, bases binary, knowns binary, t int, p long, b long, w long, c long, n long, a double"
_NAMES = [x.split()[0] for x in NAMED.split(", ")]
_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}
# Kinds of rows of FOUND; what is asked is looked up when all groups of a turn have told what they know.
SUMS, ASK_P, STATE, FOLLOWERS, RARE, HOT_FOLLOWERS, ASK_B, ASK_HOT_B, ASK_W, NAMES = range(10)


def _packed(batches):
    """``_places`` with lists of numbers as bytes, which Spark moves in one piece."""
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        for c in ("t", "p", "b", "w"):
            offsets, values = columns[c].offsets.to_numpy(), columns[c].values.to_numpy()
            columns[c] = _bytes(values, offsets)
        yield pa.RecordBatch.from_pydict(columns)


def _bytes(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    places = (offsets * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(values))])


def _numbers(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of bytes, and how many there are in each row."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype), np.array([len(x) for x in rows], np.int64) // np.dtype(dtype).itemsize


def _found(kind: int, rows: int, /, **columns) -> pa.RecordBatch:
    fields = [(f.split()[0], _ARROW[f.split()[1]]) for f in FOUND.split(", ")]
    given = {"kind": np.full(rows, kind, np.int32), **columns}
    arrays = [given[c] if c in given else pa.nulls(rows, type_) for c, type_ in fields]
    arrays = [pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) if isinstance(x, np.ndarray) else x for x in arrays]
    return pa.RecordBatch.from_arrays([x.cast(t) for x, (_, t) in zip(arrays, fields, strict=True)], [c for c, _ in fields])


def _arcs(table: pa.Table, common) -> pa.Table:
    """What one group knows, as rows of ``FOUND``: sums of what it settles, and what only other groups or the word counts tell.

    All places of a word b that is not hot are here, so its arcs, its histories and their failure weights are settled here,
    but for counts of rare words.
    """
    names = table.filter(pc.greater(pc.list_value_length(table["id"]), 0))
    out = [_found(NAMES, len(names), **{c: names[c].combine_chunks() for c in ("slice", *_NAMES)})] if len(names) else []
    (t, size), (p, _), (b, _), (w, _) = (_numbers(table[c], d) for c, d in (("t", np.int32), ("p", np.uint64), ("b", np.uint64), ("w", np.uint64)))
    if not len(t):
        return pa.Table.from_batches(out or [_found(SUMS, 0)])
    slice_ = np.repeat(table["slice"].to_numpy(), size)
    s, all_ = _bigram(b, w), common["all"]
    taught, second, third = t & 1 == 1, b != 0, p != 0
    _, place3, of3 = np.unique(join_hashes(p, s), return_index=True, return_inverse=True)
    _, place2, of2 = np.unique(s[place3], return_index=True, return_inverse=True)
    place2, of2 = place3[place2], of2[of3]
    word, of = np.unique(b[place2], return_inverse=True)
    of = of[of2]
    hot_count = common["hot"].find(word)
    hot = hot_count > 0
    cb = np.where(hot, hot_count, np.bincount(of, taught & second, len(word)))
    is_hot, broadcast = hot[of], np.zeros(len(w), np.int64)
    broadcast[is_hot] = common["pairs"].find(s[is_hot])
    c2 = np.where(broadcast > 0, broadcast, np.bincount(of2, taught & second, len(place2)).astype(np.int64)[of2])
    c3 = np.bincount(of3, taught & third, len(place3)).astype(np.int64)[of3]
    value = np.zeros(len(w))
    value[c3 > 0] += np.log10(c3[c3 > 0] - DISCOUNT)
    after = (broadcast == 0) & (c2 > 0) & (w != END)
    value[after] -= np.log10(c2[after])

    # Failure arcs to the state of the last word: here, or of a hot word from what all groups know of the history.
    miss, known = np.flatnonzero(c3 == 0), place3[c3[place3] > 0]
    near = miss[third[miss] & ~is_hot[miss]]
    history, t2, a2 = _states(p[known[~is_hot[known]]], c2[known[~is_hot[known]]])
    at = np.minimum(np.searchsorted(history, p[near]), max(len(history) - 1, 0))
    near, at = (near[history[at] == p[near]], at[history[at] == p[near]]) if len(history) else (near[:0], at[:0])
    value[near] += np.log10(DISCOUNT * t2[at]) - np.log10(1 - (a2[at] - DISCOUNT * t2[at]) / cb[of[near]])
    far = miss[third[miss] & is_hot[miss]]
    out.append(_found(ASK_P, len(far), slice=slice_[far], t=t[far], p=p[far], c=cb[of[far]].astype(np.int64)))
    history, t2, a2 = _states(p[known[is_hot[known]]], c2[known[is_hot[known]]])
    out.append(_found(STATE, len(history), p=history, n=t2, a=a2))

    # The arc of the last word, or the failure arc to the empty history and the word's own weight.
    seen, bare = miss[c2[miss] > 0], miss[c2[miss] == 0]
    value[seen] += np.log10(c2[seen] - DISCOUNT) - np.log10(cb[of[seen]])
    c1 = common["words"].find(w[bare])
    value[bare[c1 > 0]] += np.log10((c1[c1 > 0] + 1) / all_)
    far = bare[c1 == 0]
    out.append(_found(ASK_W, len(far), slice=slice_[far], t=t[far], w=w[far]))
    asked = np.zeros(len(word), bool)
    asked[of[bare]] = True
    asked &= (cb > 0) & ~hot
    follower = place2[(c2[place2] > 0) & (asked | hot)[of[place2]] & (broadcast[place2] == 0)]
    c1, of_f = common["words"].find(w[follower]), of[follower]
    t1 = np.bincount(of_f[c1 > 0], minlength=len(word))
    a1 = np.bincount(of_f[c1 > 0], c1[c1 > 0] + 1.0, len(word))
    rare = np.bincount(of_f[c1 == 0], minlength=len(word)) > 0
    out.append(_found(RARE, int((c1 == 0).sum()), b=b[follower[c1 == 0]], w=w[follower[c1 == 0]]))
    for kind, these in ((FOLLOWERS, asked & rare), (HOT_FOLLOWERS, hot)):
        out.append(_found(kind, int(these.sum()), b=word[these], n=t1[these], a=a1[these], c=cb[these].astype(np.int64)))
    for kind, these in ((ASK_B, asked & rare), (ASK_HOT_B, hot)):
        far = bare[these[of[bare]]]
        out.append(_found(kind, len(far), slice=slice_[far], t=t[far], b=b[far]))
    to_empty = np.zeros(len(word))
    whole = asked & ~rare
    to_empty[whole] = np.log10(DISCOUNT * t1[whole] / cb[whole]) - np.log10(1 - a1[whole] / all_)
    value[bare] += to_empty[of[bare]]

    place = np.repeat(np.arange(len(size)), size)
    begin = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (place[1:] != place[:-1])))
    sums, cuts = np.add.reduceat(value, begin), np.searchsorted(place[begin], np.arange(len(size) + 1))
    # All places after a training word that is not hot are here, so it is counted here.
    base = np.add.reduceat(np.where(second, np.log10((cb + 1) / all_)[of], 0.0), begin)
    known = np.add.reduceat((second & (cb > 0)[of]).astype(np.int32), begin)
    packed = {"ts": t[begin], "vs": sums, "bases": base, "knowns": known.astype(np.int32)}
    out.append(_found(SUMS, len(size), slice=table["slice"].combine_chunks(), **{c: _bytes(x, cuts) for c, x in packed.items()}))
    return pa.Table.from_batches(out)


def _states(p, c):
    """Histories with their number of arcs and the sum of the followers' counts."""
    history, of = np.unique(p, return_inverse=True)
    return history, np.bincount(of, minlength=len(history)), np.bincount(of, c, len(history))


def _settled(table: pa.Table) -> pa.Table:
    """One slice's rows of ``SETTLED``: what its places of a turn add to the sums of each of its texts."""
    names = table.filter(pc.is_valid(table["id"]))
    sums = {c: names[c].combine_chunks().flatten() for c in _NAMES}
    packed, one = table.filter(pc.is_valid(table["ts"])), table.filter(pc.is_valid(table["t"]))
    text, n = _numbers(packed["ts"], np.int32)[0] >> 1, len(sums["id"])
    for c, name, kind in (("v", "vs", np.float64), ("base", "bases", np.float64), ("n_known", "knowns", np.int32)):
        more = np.bincount(text, _numbers(packed[name], kind)[0], n)
        sums[c] = sums[c].to_numpy() + (more if c != "n_known" else more.astype(np.int64))
    sums["v"] = sums["v"] + np.bincount(one["t"].to_numpy() >> 1, one["x"].to_numpy(), n)
    return pa.table(sums)


SETTLED = "id long, h long, v double, base double, n_known long, n_tokens long"


def score_corpus(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Model]:
    """``score`` of all rows by the model of order 3 that keeps every n-gram of the rows with ``learn``.

    The automaton is never in one place. Each place of a text looks up the arc of its last two words and itself; where
    there is none, it takes the failure arc to the state of its last word, then to the empty history. Arcs and
    failure weights are what groups of places count (``POSITIONS`` a group). Words that would fill ``HOT`` of a group are hot: their places are
    dealt to many groups, and only the at most ``1 / COMMON`` n-grams of that share of the training tokens are broadcast with their counts.

    All training n-grams are kept, so a state h of count c, t followers and followers' counts A below its
    failure state f has 1 - direct = DISCOUNT * t / c and 1 - lower = 1 - (A - DISCOUNT * t) / c(f).
    The factor 1 / c of arcs and failure arcs alike is added where the bigram h itself ends.
    """
    texts = _texts(docs.where(learn), text_col)
    model = train(docs.where(learn), text_col, order=1)
    all_, spark = float(model.n + model.v + 1), docs.sparkSession
    named = F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"), F.coalesce(learn, F.lit(False)).alias("learn")
    rows = docs.select(*named).withColumn("h", F.xxhash64("t"))
    places = _places_expected(rows, model.n)
    # Unsigned remainders: bits 63 and 0 to 62 of the hash are added up.
    low = F.col("k").bitwiseAND(F.lit((1 << 63) - 1)) % PASSES
    turn = (low + F.when(F.col("k") < 0, pow(2, 63, PASSES)).otherwise(0)) % PASSES
    shares = model.counts.groupBy(turn.alias("turn")).agg(F.sum("c").alias("c")).collect()
    shares = {x.turn: x.c / model.n for x in shares}
    groups = [1 + int(places * max(shares.get(turn, 0), 1 / PASSES)) // POSITIONS for turn in range(PASSES)]
    grams = kept_ngrams(texts, 3, max(COMMON * model.n, 1)).toArrow() if model.n else None  # at most 1/COMMON rows a length
    table = model.counts.where(F.col("c") >= KNOWN_WORDS * model.n).toArrow()
    empty = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = Counts.of(table["k"].to_numpy().view(np.uint64), table["c"].to_numpy())
    hot = words.counts * (places / max(model.n, 1)) > POSITIONS * HOT
    common = {"words": words, "hot": Counts(words.keys[hot], words.counts[hot]), "pairs": Counts(*empty), "triples": Counts(*empty), "all": all_}
    fixed = [_found(SUMS, 0)]
    if grams is not None and len(grams):
        x, y, c = (grams[name].to_numpy().view(np.uint64) for name in ("w0", "w1", "c"))
        z = grams["w2"].fill_null(0).to_numpy().view(np.uint64)
        two, c = grams["w2"].is_null().to_numpy(), c.view(np.int64)
        common["pairs"] = Counts.of(_bigram(x[two], y[two]), c[two])
        p, s = _bigram(x[~two], y[~two]), _bigram(y[~two], z[~two])
        common["triples"] = Counts.of(join_hashes(p, s), c[~two])
        at = common["hot"].find(y[~two]) > 0  # of other words, groups count the common ones too
        history, t2, a2 = _states(p[at], common["pairs"].find(s[at]))
        fixed.append(_found(STATE, len(history), p=history, n=t2, a=a2))
        at = common["hot"].find(x[two]) > 0
        b, w = x[two][at], y[two][at]
        c1, cb = words.find(w), common["hot"].find(b)
        fixed.append(_found(HOT_FOLLOWERS, int((c1 > 0).sum()), b=b[c1 > 0], n=np.ones(int((c1 > 0).sum()), np.int64), a=c1[c1 > 0] + 1.0, c=cb[c1 > 0]))
        fixed.append(_found(RARE, int((c1 == 0).sum()), b=b[c1 == 0], w=w[c1 == 0]))
    shared = spark.sparkContext.broadcast(common)

    def group(table):
        return _arcs(table, shared.value)

    first = stage(spark.createDataFrame(pa.Table.from_batches(fixed).combine_chunks(), FOUND), "common_arcs")
    counts = model.counts.select(F.col("k").alias("w"), F.col("c").alias("c1"))
    settled = []
    for turn in range(PASSES):
        sent = rows.mapInArrow(lambda batches, turn=turn: _packed(_places(batches, shared.value, groups[turn], turn)), PLACES)
        part = stage(sent.groupBy("bucket").applyInArrow(group, FOUND), "arcs")
        release(part)
        asked = stage(_rare(part, first, counts), "rare_words")
        settled.append(stage(_weights(part, first, asked, all_), "weights"))
        discard(part, asked)
        release(settled[-1])
    end = model.counts.where(F.col("k") == F.lit(int(END.view(np.int64)))).select("c").first()
    end = end.c if end else 0
    # Each turn has a row for each text; equal rows were summed into one: share the sums out to as many rows again.
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "v")]
    sums = functools.reduce(DataFrame.unionByName, settled).groupBy("id", "h").agg(F.expr(f"count(*) div {PASSES}").alias("m"), *sums)
    sums = sums.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    found = sums.select(
        F.col("id").alias(id_col),
        F.expr("n_tokens div m").alias("n_tokens"),
        (F.expr("n_known div m") + F.lit(int(end > 0)).cast("long")).alias("n_known"),
        (F.col("base") / F.col("m") + F.lit(math.log10((end + 1) / all_))).alias("base_score"),
        (F.col("v") / F.col("m")).alias("score"),
    )
    return found, model


def _places_expected(rows: DataFrame, n: int) -> float:
    """Number of tokens of all texts: those of training texts are ``n``, the others are taken to be as dense."""
    size = F.coalesce(F.octet_length("t"), F.lit(0))
    seen = F.count_if("learn").alias("learnt"), F.sum(F.when(F.col("learn"), size)).alias("learnt_bytes")
    found = rows.agg(F.count("*").alias("texts"), F.sum(size).alias("bytes"), *seen).first()
    if not found.learnt_bytes:
        return found.texts + (found.bytes or 0) / 2
    return found.texts + (n - found.learnt) * found.bytes / found.learnt_bytes


def _rare(part: DataFrame, common: DataFrame, counts: DataFrame) -> DataFrame:
    """(kind, b, slice, t, c1): the rows that ask for the count of a word, with it."""
    rows = part.unionByName(common).where(F.col("kind").isin(RARE, ASK_W)).select("kind", "b", "slice", "t", "w")
    return rows.join(counts, "w", "left").drop("w")


def _weights(part: DataFrame, common: DataFrame, rare_words: DataFrame, all_: float) -> DataFrame:
    """The rows of ``SETTLED`` of a turn."""
    known = part.unionByName(common)
    states = known.where(F.col("kind") == STATE).groupBy("p").agg(F.sum("n").alias("t2"), F.sum("a").alias("a2"))
    rare = rare_words.where(F.col("kind") == RARE)
    one = F.lit(1).cast("long").alias("n")
    rare = rare.select("b", one, (F.col("c1") + 1).cast("double").alias("a"), F.lit(None).cast("long").alias("c"), F.lit(0).alias("kind"))
    followers = known.where(F.col("kind").isin(FOLLOWERS, HOT_FOLLOWERS)).select("b", "n", "a", "c", "kind").unionByName(rare)
    followers = followers.groupBy("b").agg(F.sum("n").alias("t1"), F.sum("a").alias("a1"), F.max("c").alias("cb"), F.max("kind").alias("of"))
    to_empty = F.log10(DISCOUNT * F.col("t1") / F.col("cb")) - F.log10(1 - F.col("a1") / all_)
    followers = stage(followers.select("b", to_empty.alias("x"), "of"), "followers")
    hot = F.broadcast(followers.where(F.col("of") == HOT_FOLLOWERS))
    to_word = F.log10(DISCOUNT * F.col("t2")) - F.log10(1 - (F.col("a2") - DISCOUNT * F.col("t2")) / F.col("c"))
    own = F.log10((F.coalesce("c1", F.lit(0)) + 1) / all_)

    def asked(kind, *columns):
        return part.where(F.col("kind") == kind).select("slice", "t", *columns)

    told = asked(ASK_P, "p", "c").join(states, "p").select("slice", "t", to_word.alias("x"))
    told = told.unionByName(asked(ASK_B, "b").join(followers, "b").select("slice", "t", "x"))
    told = told.unionByName(asked(ASK_HOT_B, "b").join(hot, "b").select("slice", "t", "x"))
    told = told.unionByName(rare_words.where(F.col("kind") == ASK_W).select("slice", "t", own.alias("x")))
    told = told.groupBy("slice", "t").agg(F.sum("x").alias("x"))
    sums = part.where(F.col("kind").isin(SUMS, NAMES)).select("slice", *_NAMES, "ts", "vs", "bases", "knowns")
    return sums.unionByName(told, allowMissingColumns=True).groupBy("slice").applyInArrow(_settled, SETTLED)


def _rows(batch, row, key, m, n_tokens=None, n_known=None, base=None, score=None):
    """One row a text (key None), or one a rare word of a text."""
    at, n = pa.array(row), len(row)
    arrays = [batch.column("id").take(at), batch.column("h").take(at)]
    arrays.append(pa.nulls(n, pa.int64()) if key is None else pa.array(key))
    arrays.append(pa.array(np.asarray(m, np.int64)))
    arrays += [pa.nulls(n, pa.int64()) if x is None else pa.array(x.astype(np.int64)) for x in (n_tokens, n_known)]
    arrays += [pa.nulls(n, pa.float64()) if x is None else pa.array(x) for x in (base, score)]
    return pa.RecordBatch.from_arrays(arrays, ["id", "h", "k", "m", "n_tokens", "n_known", "base", "score"])
