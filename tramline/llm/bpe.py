"""Byte-level BPE token ids of texts and the bytes of token ids, by ``tiktoken`` and a local rank file.

A rank file has a token in base64 and its rank in each line. A text is cut into the matches of a
split pattern, and each match is merged on its own. A long text is first cut at safe places: in
front of a blank or line feed that follows a visible character every match of the pattern ends, and
nothing behind that place can change the matches before it. So a text of any length is encoded
piece by piece with the ids of the whole. Runs of white space too long for the library's matcher
are merged without it: followed by something, all but the last character are one match.

Decoding joins the tokens' bytes and never reads them as text, so ids may end within a character.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.words import text_slices

LONG = 1 << 16  # characters; longer texts are cut
# Characters that patterns with \s take as white space, and a visible character before a cut.
WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SAFE = re.compile(r"(?<=[^\s\u180e\u200b\ufeff])[ \n]")


@functools.cache
def encoding(ranks_path: str, pattern: str):
    """One encoder for all tasks of a worker."""
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, file))}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def segments(text: str, long: int = LONG) -> Iterator[tuple[str, bool]]:
    """The text in order as (part, whole): a part is to be encoded by itself, a whole one is a single match."""
    at, run = 0, re.compile(f"{WHITE}{{{max(long, 2)},}}")
    while at < len(text):
        cut = SAFE.search(text, at + long) if len(text) - at > long else None
        end = cut.start() if cut else len(text)
        for white in run.finditer(text, at, end) if end - at > long else ():
            last = white.end() - (white.end() < len(text))
            if white.start() > at:
                yield text[at : white.start()], False
            yield text[white.start() : last], True
            at = last
        if at < end:
            yield text[at:end], False
        at = end


def token_ids(text: str, encoder, long: int = LONG) -> np.ndarray:
    """Ids of one text; special tokens do not exist, their strings are ordinary text."""
    if len(text) <= long:
        return np.array(encoder.encode_ordinary(text), np.int32)
    parts = [encoder._encode_single_piece(part) if whole else encoder.encode_ordinary(part) for part, whole in segments(text, long)]
    return np.fromiter(itertools.chain.from_iterable(parts), np.int32, sum(map(len, parts)))


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", long: int = LONG
) -> DataFrame:
    """(id_col, ids array<int>) for every row of ``docs``.

    Null and empty texts have no ids; so every row has a result, repeated rows and null ids too.
    Bytes that are not UTF-8 count as U+FFFD. Other columns are not read. ``ranks_path`` must be
    readable at the executors. A task holds 4 MB of text, or one text, and its ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks_path, pattern)
        for batch in text_slices(batches, "t"):
            texts = batch.column("t").cast(pa.large_binary()).to_pylist()
            found = [token_ids(text.decode("utf-8", "replace"), encoder, long) for text in texts]
            ends = np.cumsum([0, *map(len, found)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), ids], ["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(coded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """``coded`` with the bytes that its ids stand for in the new last column ``into``.

    Null ids give null, no ids no bytes; an id without a token, or a null among the ids, fails the job.
    """
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in coded.schema)}, `{into}` binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [None if ids is None else encoder.decode_bytes(ids) for ids in part.column(ids_col).to_pylist()]
                columns = [*part.columns, pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, into])

    return coded.mapInArrow(run, schema)
