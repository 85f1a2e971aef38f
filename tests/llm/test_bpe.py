import hashlib
import random

import public_tokenizers
import pytest
import regex

from tramline.llm import bpe
from tramline.llm.queries import QUERIES

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def merged(piece, ranks):
    """Byte pairs of one match by the definition: always the lowest rank, leftmost first."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def brute(text, cache={}):
    ranks = bpe.encoding(RANKS, PATTERN)._mergeable_ranks
    out = []
    for match in regex.findall(PATTERN, text):
        if match not in cache:
            cache[match] = merged(match.encode(), ranks)
        out += cache[match]
    return out


def test_query_equals_brute_force(spark, sf_dir):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    df = QUERIES["op11_byte_bpe"](spark, sf_dir)
    assert df.dtypes[:4] == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    got = {r.doc_id: tuple(r)[1:4] for r in df.collect()}
    want = {}
    for i, text in rows.items():
        ids = brute(text)
        digests = (" ".join(map(str, ids)).encode(), text.encode())
        want[i] = (len(ids), *(hashlib.sha256(d).hexdigest() for d in digests))
    assert got == want


@pytest.mark.parametrize("long", [1, 2, 7, 40])
def test_cuts_change_nothing(long):
    rng = random.Random(long)
    encoder = bpe.encoding(RANKS, PATTERN)
    parts = ["it's", "we'll", "'", "s", " ", "  ", "\n", "\n\n ", "\t", "\xa0", "\u3000", "\x85", "\x1c", "\u00e9", "\u65e5\u672c", "12", "\u0663", "!?", "-", "a" * 9, " " * 9, "\n" * 5]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randint(0, 40)))
        assert bpe.token_ids(text, encoder, long).tolist() == brute(text), text
        assert "".join(p for p, _ in bpe.segments(text, long)) == text


def test_very_long_texts(spark, docs):
    rng = random.Random(5)
    prose = " ".join(rng.choices(["alpha", "béta", "it's", "12,5", "\n\n", "  x"], k=60000))
    rows = [(i, t, None, None, None) for i, t in enumerate([prose, " " * 1_300_000 + "x", "y" + "\n" * 1_300_000, "z" * 400_000, "漢" * 100_000])]
    coded = bpe.decode(bpe.encode(docs(rows), RANKS, PATTERN), RANKS, PATTERN)
    got = {r.doc_id: r for r in coded.collect()}
    assert all(bytes(got[i].decoded) == t.encode() for i, t, *_ in rows)
    assert got[0].ids == bpe.encoding(RANKS, PATTERN).encode_ordinary(prose)
    encoder = bpe.encoding(RANKS, PATTERN)
    assert got[1].ids == encoder._encode_single_piece(" " * 1_299_999) + encoder.encode_ordinary(" x")
    assert got[2].ids == encoder.encode_ordinary("y") + encoder._encode_single_piece("\n" * 1_300_000)


def test_edge_rows(spark, docs):
    rows = [(None, "a b", None, None, None), (1, None, "en", "s", 1), (2, "", "en", "s", 1), (3, "<|endoftext|>", "en", "s", 1), (3, "<|endoftext|>", "en", "s", 1)]
    table = docs(rows).selectExpr("*", "1 AS id", "2 AS ids", "'d' AS decoded", "3 AS t")
    got = bpe.encode(table, RANKS, PATTERN)
    assert got.columns == ["doc_id", "ids"]
    special = brute("<|endoftext|>")
    assert len(special) > 1
    assert sorted(((r.doc_id or 0), r.ids) for r in got.collect()) == [(0, brute("a b")), (1, []), (2, []), (3, special), (3, special)]
    assert bpe.encode(table.where("false"), RANKS, PATTERN).count() == 0


def test_decoding_is_of_bytes(spark):
    half = spark.createDataFrame([(1, brute("漢")[:1]), (2, []), (3, None)], "n int, ids array<int>")
    got = {r.n: r.decoded for r in bpe.decode(half, RANKS, PATTERN).collect()}
    whole = "漢".encode()
    assert whole.startswith(bytes(got[1])) and 0 < len(got[1]) < len(whole)
    assert bytes(got[2]) == b"" and got[3] is None


def test_bytes_that_are_not_text(spark):
    table = spark.sql("SELECT 1L AS doc_id, cast(unhex('61FF62') AS string) AS text")
    assert [r.ids for r in bpe.encode(table, RANKS, PATTERN).collect()] == [brute("a\ufffdb")]
