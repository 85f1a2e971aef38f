"""Fuzzy line dedup with DataFrame functions only: SimHashes of normalised lines, pigeonhole blocks, edit similarity.

Lines are normalised: lower case, runs of characters other than letters, digits and marks as one
space, none at either end (of a line without letters and digits only the ends are trimmed). Two
distinct lines link if they have a block in common, the SimHashes of their words differ in at most
``max_distance`` bits and those of their word pairs in ``PAIRS_MORE`` more, and their edit similarity, 1 - distance / longer length, is at least ``similarity``.

The SimHash of each line, of its words, is cut into ``PIECES`` pieces, any two of which are a block: lines that differ in
3 bits or fewer surely share one. Lines of edit similarity 0.8 may differ in 9 to 14 of the 64 bits (measured in the README),
and blocks of which some is sure to agree then have 4 to 6 bits, which select nothing. So there are further
blocks with SimHashes of their own: the line's first and last ``BLOCK``
words, and those from each anchor on. Anchors are words chosen by their own hash, 4 to 8 in most lines, so that
they do not move with edits elsewhere; two lines that differ in fewer places than blocks lie apart have an
equal one. A line of fewer words than a block has the block of all its words and, with 3 words or more, those that
leave out one of them.

A block's SimHash is that of its word pairs (of the words, in a line shorter than a block), plain bit
arithmetic on its row, so only keys are shuffled. The SimHash of a line's word pairs is taken only
of lines that share a block with another one.

A bucket of at most ``SMALL`` lines compares all. In a larger one each line first meets the smallest line
alone. Lines outside the bucket's largest group then meet ``DRAWS`` lines of it and as many of the others, turn by turn, as
long as that links many. Only then all pairs that are not yet in one group are compared, in cells of ``CELL`` lines squared, so a
large group never yields all its pairs and a large bucket is spread over many tasks. Fingerprints and
lengths are compared in the join; only the few pairs that pass have their texts compared.

Of each connected group the occurrence with the smallest (id, line number) stays. Lines are told
apart by a 64-bit hash.
"""

from __future__ import annotations

import functools
import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.graph import components, discard, fresh, merged, release
from tramline.session import stage

SMALL = 2
CELL = 512
DRAWS = 8
WORTH = 0.1  # of the pairs with new centres, the share that must link for another turn
PIECES = 5  # of a line's SimHash
KEYS_A_TURN = 1 << 23  # of those of two pieces, ten a line: not all stand in shuffle files at once
FEW_BITS = 3  # by which SimHashes may differ that meet by two pieces
BLOCK = 8  # words, four pairs
DENSITY = 2  # a line of 2^k words has an anchor in 2^(k - DENSITY) words, 2 at least
MAX_DISTANCE = 12  # bits of 64
PAIRS_MORE = 6  # bits by which SimHashes of word pairs may differ beyond that: a word is in two pairs
BROADCAST_ROWS = 1_000_000  # of at most three longs each
BROADCAST_NUMBERS = 4_000_000  # of 4 bytes each
EDGE = " \t\r\x0b\x0c.,;:!?*#$%&-_'\"()[]"  # what does not count at the ends of a line without words
PART = 7 * 4680  # words of a line that are counted in 16 bits


def line_nodes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, line, node, size) for every line, normalised; ``node`` is its hash, ``size`` its length."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    rows = rows.where("id IS NOT NULL AND t IS NOT NULL")
    # Outer generators and no filter on what is computed: else Catalyst would push a copy of it below.
    # What is read twice is a column of its own, which Catalyst then computes once.
    lines = rows.select("id", F.posexplode_outer(F.split("t", "\n")).alias("pos", "line"))
    lines = lines.select("id", "pos", F.lower("line").alias("line"))
    plain = F.regexp_replace("line", r"[^a-z0-9]+", " ")
    other = F.regexp_replace("line", r"[^\p{L}\p{N}\p{M}]+", " ")
    words = F.when(F.octet_length("line") == F.length("line"), plain).otherwise(other)
    lines = lines.select("id", "pos", "line", F.btrim(words).alias("words"))
    bare = F.btrim(F.regexp_replace("line", "[ \\t]+", " "), F.lit(EDGE))
    lines = lines.select("id", "pos", F.when(F.col("words") != "", F.col("words")).otherwise(bare).alias("line"))
    return lines.select("id", "pos", "line", F.xxhash64("line").alias("node"), F.length("line").alias("size"))


def block_keys(lines: DataFrame) -> DataFrame:
    """(key, node, size): the SimHash of each block of each line (node, size, line).

    Words stay beside the exploded places, so anchors and blocks are found in generated code; that is
    kept small, as Java does not compile large methods.
    """
    is_short = F.col("line").rlike(f"^[^ ]*(?: [^ ]*){{0,{BLOCK - 2}}}$")
    words = lines.where(~is_short).select("node", "size", F.split("line", " ").alias("w"))
    n = F.size("w")
    rare = F.greatest(F.length(F.bin(n)) - 1 - DENSITY, F.lit(1))  # of n words, one in 2^rare is an anchor
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), rare) - 1
    places = words.select("node", "size", "w", (n - BLOCK).alias("last"), mask.alias("mask"))
    places = places.select("*", F.explode(F.sequence(F.lit(0), "last")).alias("i"))
    i = F.col("i")
    anchor = F.xxhash64(F.get("w", i)).bitwiseAND(F.col("mask")) == 0
    pairs = [F.xxhash64(F.get("w", i + j), F.get("w", i + j + 1)).alias(f"h{j}") for j in range(0, BLOCK, 2)]
    found = places.where((i == 0) | (i == F.col("last")) | anchor).select("node", "size", *pairs)
    p, q, r, s = (F.col(f"h{j}") for j in range(0, BLOCK, 2))
    three = p.bitwiseAND(q).bitwiseAND(r.bitwiseOR(s)).bitwiseOR(r.bitwiseAND(s).bitwiseAND(p.bitwiseOR(q)))
    found = found.select(three.alias("key"), "node", "size")
    few = lines.where(is_short).select("node", "size", F.explode(_bound(F.split("line", " "), _left_out)).alias("b"))
    return found.unionByName(few.select(_simhash(F.col("b")).alias("key"), "node", "size"))


def _left_out(words):
    """All words, and of 3 or more those without one of them."""
    n = F.size(words)
    without = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.slice(words, 1, i - 1), F.slice(words, i + 1, n)))
    return F.when(n >= 3, F.concat(F.array(words), without)).otherwise(F.array(words))


def _simhash(words):
    """SimHash of a few words: counts of all 64 bits stand in three longs, one a binary digit."""
    names = ("ones", "twos", "fours")

    def add(c, word):
        carry, planes = F.xxhash64(word), []
        for name in names:
            planes.append(c[name].bitwiseXOR(carry).alias(name))
            carry = carry.bitwiseAND(c[name])
        return F.struct(*planes)

    def majority(c):
        ones, twos, fours = (c[name] for name in names)
        n = F.size(words)
        three = fours.bitwiseOR(twos.bitwiseAND(ones))
        return F.when(n >= 6, fours).when(n >= 4, three).when(n >= 2, fours.bitwiseOR(twos)).otherwise(ones)

    return F.aggregate(words, F.struct(*(F.lit(0).cast("long").alias(name) for name in names)), add, majority)


def pigeonhole_keys(prints: DataFrame, turn: int, turns: int) -> DataFrame:
    """(key, node, fp): two of the ``PIECES`` pieces of each SimHash, any two over all turns.

    Two that differ in 3 bits or fewer have a key in common.
    """
    cuts = [64 * i // PIECES for i in range(PIECES + 1)]
    masks = [(1 << high) - (1 << low) for low, high in itertools.pairwise(cuts)]
    masks = [((x | y) ^ (1 << 63)) - (1 << 63) for x, y in itertools.combinations(masks, 2)]  # as signed longs
    keys = F.array(*(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(masks[i]))) for i in range(turn, len(masks), turns)))
    return prints.select(F.explode(keys).alias("key"), "node", "fp")


def fingerprints(lines: DataFrame, pairs: bool = False) -> DataFrame:
    """(node, fp): SimHash of the words of each line (node, line); with ``pairs`` of each word and the next.

    Seven words at a time are added up bit by bit, as three binary digits, in full adders; then four counts of 16 bits
    stand in a long, at last two of 32.
    """
    words = lines.select("node", F.split("line", " ").alias("w")).withColumn("n", F.size("w"))
    words = words.select("node", "n", "w", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(7))).alias("i"))

    def word(j):
        i = F.col("i") + j
        both = (F.get("w", i), F.coalesce(F.get("w", i + 1), F.lit(""))) if pairs else (F.get("w", i),)
        return F.when(i < F.col("n"), F.xxhash64(*both)).otherwise(F.lit(0).cast("long"))

    part = F.floor(F.col("i") / PART).cast("int").alias("part")
    sums = words.select("node", "n", part, *(word(j).alias(f"h{j}") for j in range(7)))
    kept = ["node", "n", "part"]
    sums = sums.select(*kept, "h6", *_added("h0", "h1", "h2", "s", "c"), *_added("h3", "h4", "h5", "t", "d"))
    sums = sums.select(*kept, "c", "d", *_added("s", "t", "h6", "ones", "e"))
    sums = sums.select(*kept, "ones", *_added("c", "d", "e", "twos", "fours"))

    def lanes(name, j):
        return F.shiftrightunsigned(F.col(name), j).bitwiseAND(F.lit(0x0001000100010001))

    four = [F.sum(lanes("ones", j) + lanes("twos", j) * 2 + lanes("fours", j) * 4).alias(f"l{j}") for j in range(16)]
    counts = sums.groupBy(*kept).agg(*four)
    both = 0x100000001  # a bit and the one 32 places higher
    wide = [F.shiftrightunsigned(F.col(f"l{j % 16}"), j // 16 * 16).bitwiseAND(F.lit(0xFFFF * both)) for j in range(32)]
    counts = counts.groupBy("node", "n").agg(*(F.sum(x).alias(f"s{j}") for j, x in enumerate(wide)))
    # Majorities of both halves at once: 2 * ones + (2^30 - 1 - n) has bit 30 if 2 * ones > n.
    least = (F.lit((1 << 30) - 1) - F.col("n")) * both
    fp = F.lit(0).cast("long")
    for j in range(32):
        majority = F.shiftrightunsigned(F.col(f"s{j}") * 2 + F.col("least"), 30).bitwiseAND(F.lit(both))
        fp = fp.bitwiseOR(F.shiftleft(majority, j))
    return counts.withColumn("least", least).select("node", fp.alias("fp"))


def _added(x: str, y: str, z: str, digit: str, carry: str) -> tuple[Column, Column]:
    """A full adder of three columns, bit by bit."""
    x, y, z = F.col(x), F.col(y), F.col(z)
    either = x.bitwiseXOR(y)
    return either.bitwiseXOR(z).alias(digit), x.bitwiseAND(y).bitwiseOR(z.bitwiseAND(either)).alias(carry)


def _bound(value, use):
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _alike(x: str, y: str, similarity: float) -> Column:
    """Lengths that allow the edit similarity."""
    least, most = F.least(x, y), F.greatest(x, y)
    return most - least <= F.floor(most * (1 - similarity) + 1e-9)


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a staged table of a few longs a row if it is small enough; else leave the join to Catalyst."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose normalised lines (node, line) have the edit similarity, staged.

    Words that both lines begin or end with are left out first, which changes no distance; what is left of
    most near lines is short. The letters that differ then bound the distance: all that is left, or, of as
    many words on both sides, those of words that stand for each other. Else the distance is first looked for below small limits.
    """
    both = pairs.join(texts.toDF("a", "s"), "a").join(texts.toDF("b", "t"), "b")
    both = both.withColumn("longest", F.greatest(F.length("s"), F.length("t")))
    both = both.withColumn("most", F.floor(F.col("longest") * (1 - similarity) + 1e-9).cast("int"))
    both = both.where(F.least(F.length("s"), F.length("t")) >= F.col("longest") - F.col("most"))
    # few bytes, much work: spread over all tasks
    both = both.repartition(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    both = both.select("a", "b", "most", F.split("s", " ").alias("s"), F.split("t", " ").alias("t"))
    trimmed = _bound(F.struct("s", "t"), lambda p: _from(p, _common(p["s"], p["t"])))
    trimmed = _bound(trimmed, lambda p: _until(p, _common(F.reverse(p["s"]), F.reverse(p["t"]))))
    letters = F.zip_with("p.s", "p.t", lambda x, y: F.when(x != y, F.greatest(F.length(x), F.length(y))).otherwise(0))
    exchanged = (F.size("p.s") == F.size("p.t")) & (F.aggregate(letters, F.lit(0), lambda n, x: n + x) <= F.col("most"))
    both = both.select("a", "b", "most", trimmed.alias("p"))
    both = both.select("a", "b", "most", "p", exchanged.alias("near"))
    # Staged: else Catalyst would move the filter below, with a copy of all this for each mention.
    both = both.select("a", "b", "most", "near", *(F.array_join(f"p.{c}", " ").alias(c) for c in ("s", "t")))
    both = stage(both, "trimmed_pairs")
    near = F.col("near") | (F.greatest(F.length("s"), F.length("t")) <= F.col("most"))
    for limit, more in ((32, 32), (128, 512)):  # work grows with the limit, so pairs too far apart pay for all
        near = near | (F.col("most") > more) & F.expr(f"levenshtein(s, t, {limit}) >= 0")
    near = stage(both.where(near | F.expr("levenshtein(s, t, most) >= 0")).select("a", "b"), "near_pairs")
    discard(both)
    return near


def _from(pair, n):
    return _bound(n, lambda k: F.struct(*(F.slice(pair[c], k + 1, F.size(pair[c])).alias(c) for c in ("s", "t"))))


def _until(pair, n):
    def cut(k):
        return F.struct(*(F.slice(pair[c], F.lit(1), F.size(pair[c]) - k).alias(c) for c in ("s", "t")))

    return _bound(n, cut)


def _common(x: Column, y: Column) -> Column:
    """Number of words at which two arrays are equal from their beginning on."""
    same = F.zip_with(x, y, lambda a, b: F.coalesce(a == b, F.lit(False)))
    place = F.array_position(same, False)
    return F.when(place > 0, place - 1).otherwise(F.least(F.size(x), F.size(y))).cast("int")


def links(lines: DataFrame, max_distance: int = MAX_DISTANCE, similarity: float = 0.8) -> DataFrame:
    """(node, component) of every line that is linked with another; ``lines`` are staged ``line_nodes``.

    Lines may repeat: a hot line reaches the shuffle once a task and key. The result is staged.
    """
    used = []
    groups = _links(lines, max_distance, similarity, used)
    discard(*(df for df in used if df is not groups))
    release(groups)
    return groups


def _links(lines: DataFrame, max_distance: int, similarity: float, used: list[DataFrame]) -> DataFrame:
    """``links``; ``used`` gets staged tables that nothing reads any more, and the result."""
    whole = stage(fingerprints(lines.groupBy("node").agg(F.min("line").alias("line"))), "word_prints")
    release(whole)
    few, alike = F.lit(min(FEW_BITS, max_distance)).alias("most"), []
    each = math.comb(PIECES, 2)
    turns = min(each, 1 + whole.count() * each // KEYS_A_TURN)
    for turn in range(turns):
        keys = pigeonhole_keys(whole, turn, turns)
        found = keys.groupBy("key").agg(
            F.count("*").alias("n"), F.bit_count(F.bit_or("fp").bitwiseXOR(F.bit_and("fp"))).alias("bits")
        )
        # Two lines alone that are too far apart need no bucket.
        found = found.where((F.col("n") > 2) | (F.col("n") == 2) & (F.col("bits") <= FEW_BITS))
        buckets = stage(found.select("key", "n"), "buckets")
        release(found)
        met = stage(keys.join(_small(buckets), "key"), "met_keys")
        # Chance brings most together: of all but large buckets only lines with another one in reach stay.
        x, y = met.where(F.col("n") <= CELL).alias("x"), met.where(F.col("n") <= CELL).alias("y")
        near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= FEW_BITS
        near = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") != F.col("y.node")) & near, "left_semi")
        alike.append(stage(near.unionByName(met.where(F.col("n") > CELL)).select("key", "node"), "alike_keys"))
        discard(met, buckets)
    together = functools.reduce(DataFrame.unionByName, alike)
    centres = together.groupBy("key").agg(F.min("node").alias("centre"))
    together = together.join(centres, "key").select("key", "node", "centre", few)
    keys = stage(block_keys(lines).select("key", "node"), "line_keys")
    found = keys.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("other")).where("centre <> other")
    buckets = stage(found.select("key", "centre"), "buckets")
    release(found)
    shared = keys.join(_small(buckets), "key").distinct().withColumn("most", F.lit(max_distance))
    shared = stage(shared.unionByName(together), "shared_keys")
    discard(keys, *alike)
    release(shared)
    asked = stage(shared.select("node").distinct(), "shared_nodes")
    texts = lines.select("node", "line").join(_small(asked), "node", "left_semi")
    texts = stage(texts.groupBy("node").agg(F.min("line").alias("line")), "line_texts")
    pairs = fingerprints(texts.repartition("node"), pairs=True).withColumnRenamed("fp", "fp2")
    prints = texts.select("node", F.length("line").alias("size")).join(whole, "node").join(pairs, "node")
    prints = stage(prints, "line_prints")
    discard(whole)
    sizes = stage(shared.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "bucket_sizes")
    shared = stage(shared.join(prints, "node").join(sizes, "key"), "printed_keys")
    release(shared)

    little, large = shared.where(F.col("n") <= SMALL), shared.where(F.col("n") > SMALL)
    pairs = _pairs(little.alias("x").join(little.alias("y"), "key").where("x.node < y.node"), max_distance, similarity)
    centres = large.where("node = centre").select("key", "node", "most", "fp", "fp2", "size")
    met = large.where("node <> centre").alias("x").join(_small(stage(centres, "centres")).alias("y"), "key")
    pairs = stage(pairs.unionByName(_pairs(met, max_distance, similarity)).distinct(), "line_pairs")
    edges = verified(pairs, texts, similarity)
    groups, tried = stage(components(edges), "line_groups"), pairs
    used += [buckets, asked, texts, prints, sizes, shared, pairs, edges, groups]
    if large.isEmpty():
        return groups

    tagged, main = _mixed_buckets(large, groups)
    for turn in itertools.count():
        if main.isEmpty():
            return groups
        # Most lines of a near group are near most others: a few more centres spare nearly all of its pairs.
        met = _outside(tagged).alias("x").join(_small(_centres(tagged, turn)).alias("y"), "key").where("x.g <> y.g")
        pairs = _pairs(met, max_distance, similarity).distinct().join(_small(tried), ["a", "b"], "left_anti")
        pairs = stage(pairs, "centre_pairs")
        found = verified(pairs, texts, similarity)
        asked, linked, tried = pairs.count(), found.count(), tried.unionByName(pairs)
        used += [pairs, found]
        if linked:
            # Groups only grow together, so no other bucket can have several now.
            groups, before = merged(groups, found), (tagged, main)
            tagged, main = _mixed_buckets(tagged, groups)
            used.append(groups)
            discard(*before)
        if linked < asked * WORTH or not linked:
            break
    others = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    # Every pair of two groups has a line outside the bucket's largest group; of two such, the smaller asks.
    # A pair that shares several buckets of one kind is compared in the one of the smallest key.
    own = stage(tagged.groupBy("node", "most").agg(F.array_sort(F.collect_set("key")).alias("keys")), "own_keys")
    dealt = tagged.join(own, ["node", "most"]).withColumn("cell", F.pmod(F.xxhash64("node"), F.col("cells")).cast("int"))
    asking = _outside(dealt).withColumn("y_cell", others).withColumnRenamed("cell", "x_cell")
    other = dealt.withColumn("x_cell", others).withColumnRenamed("cell", "y_cell")
    met = asking.alias("x").join(other.alias("y"), ["key", "x_cell", "y_cell"])
    met = met.where("x.g <> y.g AND (y.g = y.main OR x.node < y.node)")
    once = F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("key")
    rest = _pairs(met, max_distance, similarity, once).join(_small(tried), ["a", "b"], "left_anti")
    rest = stage(rest, "rest_pairs")
    found = verified(rest, texts, similarity)
    discard(tagged, main, own)
    used += [rest, found]
    return merged(groups, found)


def _mixed_buckets(large: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines of buckets that have several groups, each with its group and the bucket's largest; and those buckets."""
    tagged = large.select("key", "node", "most", "fp", "fp2", "size").join(groups, "node", "left").select("key", "node", "most", "fp", "fp2", "size", F.coalesce("component", "node").alias("g"))
    tagged = stage(tagged, "tagged_keys")
    members = stage(tagged.groupBy("key", "g").agg(F.count("*").alias("n")), "group_sizes")
    mixed = members.groupBy("key").agg(F.count("*").alias("groups"), F.max("n").alias("n"), F.sum("n").alias("lines")).where("groups > 1")
    main = members.join(stage(mixed, "mixed"), ["key", "n"]).groupBy("key").agg(F.min("g").alias("main"), F.min("lines").alias("lines"))
    main = stage(main.select("key", "main", F.ceil(F.col("lines") / CELL).cast("int").alias("cells")), "main_groups")
    dealt = stage(tagged.join(_small(main), "key"), "mixed_keys")
    discard(tagged, members)
    return dealt, main


def _outside(tagged: DataFrame) -> DataFrame:
    return tagged.where("g <> main")


def _centres(tagged: DataFrame, turn: int) -> DataFrame:
    """``DRAWS`` lines of each bucket's largest group and as many of its others; each turn has draws of its own."""
    masks = [F.xxhash64(F.lit(turn), F.lit(i)) for i in range(DRAWS)]
    least = [F.min(F.col("node").bitwiseXOR(mask)).alias(f"m{i}") for i, mask in enumerate(masks)]
    drawn = tagged.groupBy("key", F.expr("g = main").alias("within")).agg(*least)
    nodes = F.array(*(F.col(f"m{i}").bitwiseXOR(mask) for i, mask in enumerate(masks)))
    drawn = stage(drawn.select("key", F.explode(F.array_distinct(nodes)).alias("node")), "drawn")
    return stage(tagged.join(_small(drawn), ["key", "node"]).select("key", "node", "most", "fp", "fp2", "size", "g"), "centres")


def _pairs(met, max_distance, similarity, also=None):
    """(a, b) of the pairs of a join of x and y whose fingerprints and lengths allow a link, and that pass ``also``."""
    near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= F.col("x.most")
    near &= F.bit_count(F.col("x.fp2").bitwiseXOR(F.col("y.fp2"))) <= max_distance + PAIRS_MORE
    near &= _alike("x.size", "y.size", similarity)
    near = met.where(near if also is None else near & also)
    return near.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, gone array of line numbers from 0) for every document that loses a line."""
    staged = stage(line_nodes(docs, id_col, text_col), "lines")
    lines = staged.where("line <> ''")
    groups = links(lines, **how)
    firsts = lines.groupBy("node").agg(F.count("*").alias("times"), F.min("id").alias("first_id"))
    grouped = firsts.join(groups, "node", "left").select("node", "times", "first_id", F.coalesce("component", "node").alias("g"))
    grouped = stage(grouped, "grouped_lines")
    kept = grouped.groupBy("g").agg(F.sum("times").alias("n"), F.min("first_id").alias("first_id")).where("n > 1")
    kept = stage(kept.select("g", "first_id"), "first_documents")
    repeated = stage(grouped.select("node", "g").join(kept, "g"), "repeated_lines")
    # only the places of lines that are repeated are looked up
    placed = stage(lines.select("id", "pos", "node").join(_small(repeated), "node").drop("node"), "placed_lines")
    there = placed.where("id = first_id").groupBy("g").agg(F.min("pos").alias("first_pos"))
    gone = placed.join(stage(there, "first_lines"), "g").where("id <> first_id OR pos <> first_pos")
    gone = stage(gone.groupBy("id").agg(F.collect_set("pos").alias("gone")), "gone_lines")
    discard(staged, grouped, kept, repeated, placed)
    release(gone)
    return gone


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with repeated and nearly repeated lines taken out of ``text_col``.

    All rows and columns stay; a text of which nothing is left is empty. Blank lines stay, null
    texts stay null. Rows with a null id stay as they are and take no part. Rows that repeat an id
    count as one document: what goes, goes from all of them. Kept lines keep their order and are
    joined by a line feed.
    """
    return keep_lines(docs, removed_lines(docs, id_col, text_col, **how), id_col, text_col)


def keep_lines(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, counts: bool = False) -> DataFrame:
    """``docs`` without the lines that ``gone`` (id, line numbers) lists; ``counts`` adds n_lines, n_removed."""
    numbers = gone.agg(F.count("*") + F.sum(F.size("gone"))).first()[0] or 0
    ids, lost = fresh(docs, "id"), fresh(docs, "gone")
    gone = gone.toDF(ids, lost)
    gone = F.broadcast(gone) if numbers <= BROADCAST_NUMBERS else gone
    rows = docs.join(gone, docs[id_col] == gone[ids], "left")
    lines = F.split(docs[text_col], "\n")
    numbered = F.sequence(F.lit(0), F.size(lines) - 1)
    left = _bound(lines, lambda line: F.transform(F.array_except(numbered, gone[lost]), lambda i: F.get(line, i)))
    text = F.when(gone[lost].isNull(), docs[text_col]).otherwise(F.array_join(left, "\n"))
    columns = [text.alias(c) if c == text_col else docs[c] for c in docs.columns]
    if counts:
        n = F.when(docs[text_col].isNull(), 0).otherwise(F.size(lines))
        columns += [n.cast("long").alias("n_lines"), F.greatest(F.size(gone[lost]), F.lit(0)).cast("long").alias("n_removed")]
    return rows.select(*columns)
