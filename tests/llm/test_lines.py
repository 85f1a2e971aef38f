import random
import re

import numpy as np
import pytest
import regex

from tramline.llm import lines
from tramline.llm.queries import QUERIES


def normal(line):
    words = regex.sub(r"[^\p{L}\p{N}\p{M}]+", " ", line.lower()).strip(" ")
    return words or re.sub("[ \t]+", " ", line.lower()).strip(lines.EDGE)


def edit(a, b):
    """Levenshtein distance, a row of the table at a time."""
    b, places = np.array([ord(c) for c in b]), np.arange(len(b) + 1)
    row = places.copy()
    for i, x in enumerate(a, 1):
        change = np.minimum(row[1:] + 1, row[:-1] + (b != ord(x)))
        row = np.minimum.accumulate(np.append(i, change) - places) + places
    return int(row[-1])


def majority(hashes):
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def blocks(w, h):
    """SimHashes of the blocks of a line."""
    n = len(w)
    if n < lines.BLOCK:
        return {majority([h[x] for x in b]) for b in [w, *([w[:i] + w[i + 1 :] for i in range(n)] if n >= 3 else [])]}
    mask = (1 << max(n.bit_length() - 1 - lines.DENSITY, 1)) - 1
    last = n - lines.BLOCK
    at = [i for i in range(last + 1) if i in (0, last) or not h[w[i]] & mask]
    return {majority([h[w[i + j], w[i + j + 1]] for j in range(0, lines.BLOCK, 2)]) for i in at}


def followed(line):
    """Each word and the next."""
    w = line.split(" ")
    return list(zip(w, [*w[1:], ""]))


def hashed(spark, texts):
    """Spark's hashes of all words and word pairs."""
    words = {x for t in texts for x in t.split(" ")}
    pairs = {p for t in texts for p in followed(t)}
    out = {}
    if words:
        for r in spark.createDataFrame([(x,) for x in words], "a string").selectExpr("a", "xxhash64(a) h").collect():
            out[r.a] = r.h & (1 << 64) - 1
    if pairs:
        for r in spark.createDataFrame(list(pairs), "a string, b string").selectExpr("a", "b", "xxhash64(a, b) h").collect():
            out[r.a, r.b] = r.h & (1 << 64) - 1
    return out


def brute(spark, docs, most=12, similarity=0.8, few=-1):
    """{id: kept text}; hashes of words come from Spark, all else is computed here."""
    places = {}
    for i, t in docs:
        for pos, line in enumerate((t or "").split("\n")):
            if normal(line):
                places.setdefault(normal(line), []).append((i, pos))
    h = hashed(spark, places)
    keys, root = list(places), {k: k for k in places}
    fp = {k: majority([h[x] for x in k.split(" ")]) for k in keys}
    fp2 = {k: majority([h[x] for x in followed(k)]) for k in keys}
    members = {}
    for n, k in enumerate(keys):
        for b in blocks(k.split(" "), h):
            members.setdefault(b, []).append(n)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    met = {(a, b) for m in members.values() for a in m for b in m if a < b}
    if few >= 0:  # pairs whose SimHashes alone bring them together
        met |= {(a, b) for b in range(len(keys)) for a in range(b) if (fp[keys[a]] ^ fp[keys[b]]).bit_count() <= few}
    for a, b in met:
        a, b = keys[a], keys[b]
        if (fp[a] ^ fp[b]).bit_count() <= most and (fp2[a] ^ fp2[b]).bit_count() <= most + lines.PAIRS_MORE:
            if 1 - edit(a, b) / max(len(a), len(b)) >= similarity - 1e-12:
                root[find(a)] = find(b)
    groups = {}
    for k in keys:
        groups.setdefault(find(k), []).extend(places[k])
    gone = {p for g in groups.values() for p in g if p != min(g)}
    return {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) if t is not None else None for i, t in docs}


def near_pairs(texts, similarity=0.8):
    """All pairs of the edit similarity; counts of characters rule most pairs out."""
    letters = sorted({c for t in texts for c in t})
    counts = np.array([[t.count(c) for c in letters] for t in texts], np.int32)
    size = counts.sum(axis=1)
    for i in range(len(texts)):
        most = np.floor(np.maximum(size[i], size[i + 1 :]) * (1 - similarity) + 1e-9)
        apart = counts[i + 1 :] - counts[i]
        least = np.maximum(np.maximum(apart, 0).sum(axis=1), np.maximum(-apart, 0).sum(axis=1))
        for j in np.flatnonzero(least <= most) + i + 1:
            if edit(texts[i], texts[j]) <= most[j - i - 1]:
                yield texts[i], texts[j]


def test_query_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op10_line_dedup"](spark, sf_dir).collect()
    want = brute(spark, docs)
    assert {r.doc_id: r.text for r in got} == want
    assert sum(r.n_removed for r in got) > 0


def test_recall_of_edit_similarity(spark, sf_dir):
    """Of all pairs of lines that edits alone call near, so many are in one group."""
    from tramline.session import stage

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = sorted({normal(x) for r in docs.collect() for x in (r.text or "").split("\n")} - {""})
    pairs = list(near_pairs([t for t in texts if len(t) <= 1500]))
    staged = stage(lines.line_nodes(docs, "doc_id", "text"), "lines").where("line <> ''")
    group = {r.node: r.component for r in lines.links(staged).collect()}
    node = {r.line: r.node for r in staged.collect()}
    found = sum(group.get(node[a], 0) == group.get(node[b], 1) for a, b in pairs)
    print(f"recall: {found} of {len(pairs)}")
    assert len(pairs) > 20 and found >= 0.9 * len(pairs)


@pytest.mark.parametrize("small,most", [(0, 12), (2, 4), (100, 12)])
def test_near_lines(spark, docs, small, most, monkeypatch):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    bases = [rng.choices(vocabulary, k=rng.choice((2, 4, 7, 8, 9, 30, 60, 90))) for _ in range(12)]
    rows = []
    for i in range(40):
        out = []
        for _ in range(rng.randint(1, 6)):
            line = list(rng.choice(bases))
            for _ in range(rng.randint(0, 2)):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            out.append(" ".join(line).capitalize() + rng.choice(("", ".", " !")))
        rows.append((i, "\n".join(out), "en", "s", 1))
    monkeypatch.setattr(lines, "SMALL", small)
    monkeypatch.setattr(lines, "CELL", 3)
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs(rows), max_distance=most).collect()}
    assert got == brute(spark, [r[:2] for r in rows], most)


def test_edge_rows(spark, docs):
    rows = [
        (1, "a b\n\nA  b!\nc", None, None, None),
        (2, None, "en", None, 1),
        (3, "", "en", None, 1),
        (4, "A B", "en", "s", 1),
        (None, "a b", "en", "s", 1),
        (5, "x y z", "en", "s", 1),
        (5, "x y z", "en", "s", 1),
        (6, "  \n..\n", "en", "s", 1),
        (7, " ".join(f"w{i}" for i in range(30000)), "en", "s", 1),
    ]
    table = docs(rows).selectExpr("*", "1 AS id", "2 AS pos", "3 AS node", "'g' AS gone", "4 AS words", "5 AS _gone", "6 AS _id", "7 AS __gone")
    out = lines.dedup_lines(table)
    assert out.columns == table.columns
    got = sorted(((r.doc_id or 0), r.text) for r in out.collect() if r.text is not None)
    assert got == sorted([
        (0, "a b"), (1, "a b\n\nc"), (3, ""), (4, ""), (5, "x y z"), (5, "x y z"), (6, "  \n..\n"), (7, rows[-1][1])
    ])
    assert lines.dedup_lines(table.where("false")).count() == 0


def test_plan_has_no_python(spark, sf_dir):
    plan = QUERIES["op10_line_dedup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_lines_with_one_tenth_of_words_edited(spark, docs):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=rng.randint(3, 8))) for _ in range(2000)]
    rows, near = [], 0
    for i in range(100):
        line = rng.choices(vocabulary, k=rng.choice((6, 12, 20, 30)))
        other = list(line)
        for at in rng.sample(range(len(line)), max(1, len(line) // 10)):
            other[at] = rng.choice(vocabulary)
        a, b = " ".join(line), " ".join(other)
        near += a != b and 1 - edit(a, b) / max(len(a), len(b)) >= 0.8
        rows += [(2 * i, a, "en", "s", 1), (2 * i + 1, b, "en", "s", 1)]
    found = {r.id for r in lines.removed_lines(docs(rows)).collect()}
    assert near > 70
    assert all(i % 2 for i in found) and 0.75 * near <= len(found) <= 100


def test_a_large_group_and_a_common_phrase(spark, docs):
    """Hundreds of variants of one line, and of unlike lines with one phrase: groups as by brute force."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    base, phrase = rng.choices(vocabulary, k=30), rng.choices(vocabulary, k=12)
    rows = []
    for i in range(150):
        line = list(base)
        line[rng.randrange(30)] = rng.choice(vocabulary)
        rows.append((2 * i, " ".join(line), "en", "s", 1))
        rows.append((2 * i + 1, " ".join(rng.choices(vocabulary, k=15) + phrase + rng.choices(vocabulary, k=15)), "en", "s", 1))
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs(rows)).collect()}
    assert got == brute(spark, [r[:2] for r in rows])
    assert sum(not t for t in got.values()) == 149


def test_many_repeated_lines_take_linear_time(spark, docs):
    text = "\n".join(f"line {i % 50}" for i in range(100_000))
    (row,) = lines.dedup_lines(docs([(1, text, "en", "s", 1)])).collect()
    assert row.text == "\n".join(f"line {i}" for i in range(50))


def test_inner_punctuation_does_not_tell_lines_apart(spark, docs):
    pairs = [("hello, world", "hello world"), ("a-b", "A b"), ("well \u2013 yes", "well yes"), ("\u201cit\u201d is", "it is"), ("\u2192\u2192", "\u2192\u2192")]
    rows = [(2 * i + j, t, "en", "s", 1) for i, two in enumerate(pairs) for j, t in enumerate(two)]
    assert sorted(r.id for r in lines.removed_lines(docs(rows)).collect()) == [1, 3, 5, 7, 9]


def test_large_near_groups_spare_most_pairs(spark, docs, monkeypatch):
    """Variants of one line in two steps: the first centres leave many outside, yet few pairs are left to compare."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=5)) for _ in range(2000)]
    base, out = rng.choices(vocabulary, k=40), []
    for _ in range(150):
        line = list(base)
        for at in rng.sample(range(40), 4):
            line[at] = rng.choice(vocabulary)
        out.append(" ".join(line))
    counted, verified = [], lines.verified

    def count(pairs, *rest):
        counted.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(lines, "verified", count)
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(out)]
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs(rows)).collect()}
    assert got == brute(spark, [r[:2] for r in rows], few=lines.FEW_BITS)
    assert sum(counted) < 20 * len(rows)


def test_near_simhashes_without_a_common_block_of_words(spark, docs):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=5)) for _ in range(3000)]
    tried = []
    for _ in range(1500):
        line = rng.choices(vocabulary, k=40)
        other = list(line)
        for at in (4, 11, 18, 25, 32, 36):
            other[at] = rng.choice(vocabulary)
        tried.append((" ".join(line), " ".join(other)))
    h, wanted = hashed(spark, [t for two in tried for t in two]), []
    for two in tried:
        fp = [majority([h[x] for x in t.split(" ")]) for t in two]
        fp2 = [majority([h[x] for x in followed(t)]) for t in two]
        a, b = (blocks(t.split(" "), h) for t in two)
        if not a & b and (fp[0] ^ fp[1]).bit_count() <= 3 and (fp2[0] ^ fp2[1]).bit_count() <= 18 and edit(*two) <= 0.2 * len(two[0]):
            wanted.append(two)
    assert wanted
    rows = [(2 * i + j, t, "en", "s", 1) for i, two in enumerate(wanted) for j, t in enumerate(two)]
    assert sorted(r.id for r in lines.removed_lines(docs(rows)).collect()) == [2 * i + 1 for i in range(len(wanted))]


def test_fingerprints_of_any_length(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abcdefgh", k=n)) for n in (1, 2, 6, 7, 8, 14, 15, 300)]
    texts.append(" ".join(rng.choices("abcdefgh", k=lines.PART + 9)))
    table = spark.createDataFrame(list(enumerate(texts)), "node long, line string")
    h = hashed(spark, texts)
    for pairs, of in ((False, lambda t: t.split(" ")), (True, followed)):
        got = {r.node: r.fp & (1 << 64) - 1 for r in lines.fingerprints(table, pairs).collect()}
        assert got == {i: majority([h[x] for x in of(t)]) for i, t in enumerate(texts)}
