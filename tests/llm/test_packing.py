import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tramline.llm import packing
from tramline.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None,
    "",
    "Hello  world\n\n it's 12345 \t ok <|endoftext|> é ü 日本語   x\x1fy  ",
    "a" * 3000,
    "word " * 5000,
    " \n" * 700,
    "Ünïcode’s “quotes” — 50 € 😀\r\n",
]


def ids(text):
    slow = Tokenizer.from_file(PATH)
    slow.encode_special_tokens = True
    return [*slow.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, texts, size=1024):
    """rows: result rows of documents with unique ids; returns the number of sequences."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for i, text in texts.items():
        tokens, at = ids(text), 0
        got = sorted(by_doc[i], key=lambda r: r.piece)
        for k, r in enumerate(got):
            assert (r.piece, r.start) == (k, at)
            assert r.length == size or k == 0
            assert r.ids_crc32 == zlib.crc32(np.array(tokens[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(tokens) and len(got) == -(-len(tokens) // size)
    for group in by_sequence.values():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence)


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    df = QUERIES["op1_best_fit_packing"](spark, sf_dir)
    assert df.dtypes[:7] == [
        ("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"),
        ("sequence_id", "bigint"), ("offset", "bigint"),
    ]
    rows = df.collect()
    least = -(-sum(r.length for r in rows) // 1024)
    assert check(rows, texts) <= least * 1.01 + 1


def test_odd_texts_and_sequences(spark, docs):
    table = docs([(i, t, None, None, None) for i, t in enumerate(TEXTS)]).selectExpr("*", "1 AS length", "2 AS id", "3 AS piece")
    rows = packing.pack_documents(table, PATH, with_ids=True)
    check(rows.collect(), dict(enumerate(TEXTS)))
    whole = packing.sequences(rows).collect()
    assert sorted(t for r in whole for t in r.ids) == sorted(t for x in TEXTS for t in ids(x))


def test_encoders_agree(spark, sf_dir):
    encoder = packing.Encoder(PATH)
    assert encoder.fast
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()[:100]:
        assert encoder(r.text).tolist() == ids(r.text)[:-1]


def test_null_ids_repeats_and_empty(spark, docs):
    table = docs([(None, "a b", None, None, None), (1, "x", "en", None, 1), (1, "x", "en", None, 1), (2, None, None, None, None)])
    rows = packing.pack_documents(table, PATH).collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 1, 2]
    assert {r.sequence_id for r in rows} == {0} and len({r.offset for r in rows}) == 4
    assert packing.pack_documents(table.where("false"), PATH).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.choice([10, 64, 200]))
    histogram = {int(x): int(rng.integers(1, 10 ** rng.integers(1, 4))) for x in rng.choice(np.arange(1, size + 1), size // 2 + 1, replace=False)}
    plan = packing.plan(histogram, size)
    length = np.concatenate([np.full(n, x) for x, n in histogram.items()])
    number = np.concatenate([np.arange(n) for n in histogram.values()])
    sequence, offset = plan.place(length, number)
    for s in np.unique(sequence):
        at = np.argsort(offset[sequence == s])
        lengths = length[sequence == s][at]
        assert (offset[sequence == s][at] == np.cumsum(lengths) - lengths).all() and lengths.sum() <= size
    assert len(np.unique(sequence)) == plan.sequences
    big = sum(n for x, n in histogram.items() if 2 * x > size)
    assert plan.sequences <= max(big, -(-int(length.sum()) // size)) * 1.15 + 2


def test_exact_halves_and_thirds():
    assert packing.plan({512: 10, 256: 20}, 1024).sequences == 10
    assert packing.plan({1024: 3, 1: 1}, 1024).sequences == 4
    assert packing.plan({600: 5, 424: 5}, 1024).sequences == 5


@pytest.mark.parametrize("seed", range(3))
def test_knapsack_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    price = np.append(0, rng.random(12))
    best = Counter()
    worth = np.zeros(13)
    for room in range(1, 13):
        worth[room] = max([worth[room - 1], *(price[k] + worth[room - k] for k in range(1, room + 1))])
    times = packing.best_pattern(price, 12)
    assert times @ price == pytest.approx(worth[12]) and times @ np.arange(13) <= 12 and not best
