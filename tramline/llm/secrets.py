"""Secret scan with DataFrame functions only.

Three fixed patterns give the base spans. On top, candidate strings are scanned with a sliding
window: the Shannon entropy of every window of ``window`` characters, per character class, kept up
to date by incremental counts (one character enters, one leaves). Windows at or above the class's
limit that overlap or touch become one span. Spans that match the allow-list are suppressed, what
stands around them is not; base spans always stay. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns and least lengths of the base spans, in the order in which equal starts are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = (("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32))
# What a text must hold for a base span of the kind to be possible at all.
QUICK = {"assign": r"(?i:password|passwd|secret|token|api_?key)", "access": "AKIA[A-Z0-9]{12}", "hex": "[0-9a-f]{32}"}


@dataclass(frozen=True)
class EntropyClass:
    """Strings of one alphabet and the least entropy, in bits, of a suspicious window."""

    kind: str
    pattern: str  # a candidate, leftmost and non-overlapping; at least ``window`` characters
    needs: tuple[str, ...]  # what a candidate must contain besides: single characters, so that the test is linear
    alphabet: str
    window: int
    least_bits: float


# Candidates must hold a digit (and a letter): running words are not candidates. The limits leave out about
# one of 200 random windows of hex digits, one of 100 of the two larger alphabets (by simulation).
CLASSES = (
    EntropyClass("entropy_hex", r"(?i)[0-9a-f]{20,}", ("[0-9]", "(?i)[a-f]"), "0123456789abcdef", 20, 3.0),
    EntropyClass(
        "entropy_base36",
        r"[a-z0-9]{20,}|[A-Z0-9]{20,}",
        ("[0-9]", "[A-Za-z]"),
        "abcdefghijklmnopqrstuvwxyz0123456789",
        20,
        3.45,
    ),
    EntropyClass(
        "entropy_base64",
        r"[A-Za-z0-9+/_=-]{20,}",
        ("[0-9]", "[A-Z]", "[a-z]"),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
        20,
        3.7,
    ),
)
# Known harmless shapes: placeholders, runs of one character, dates and times.
ALLOWED = (
    r"(?i)example|sample|placeholder|changeme|dummy|xxxx",
    r"^(.)\1+$",
    r"^\d{4}-\d{2}-\d{2}[T_]?[\d:-]*$",
)


def spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """array<struct<start,end,order_kind,match>> of the leftmost non-overlapping matches.

    The pieces between matches and the matches themselves alternate, so running sums of their
    lengths are the positions. A match whose ``group`` is shorter than ``least`` is dropped.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(
        F.slice(between, 1, F.size(found)),
        F.arrays_zip(found.alias("m"), values.alias("v")),
        lambda b, f: F.struct(F.length(b).alias("gap"), f["m"].alias("m"), f["v"].alias("v")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string,value:string>>").alias("out"))
    placed = F.aggregate(
        pairs,
        start,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["m"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + x["gap"]).alias("start"),
                        (acc["at"] + x["gap"] + F.length(x["m"])).alias("end"),
                        x["m"].alias("match"),
                        x["v"].alias("value"),
                    )
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.filter(placed, lambda s: F.length(s["value"]) >= least)


def _term(count: Column) -> Column:
    """c·log2(c), zero for no or one occurrence."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def window_spans(candidate: Column, shift: Column, cls: EntropyClass) -> Column:
    """array<struct<start,end>> of the merged windows of one candidate string with much entropy.

    With S the sum of c·log2(c) over the window's character counts, its entropy is
    log2(window) - S / window. S and the counts are carried from place to place.
    """
    text = F.lower(candidate) if cls.alphabet == cls.alphabet.lower() else candidate
    most = F.lit(cls.window * (math.log2(cls.window) - cls.least_bits) + 1e-9)
    n = cls.window

    state = "struct<at:int,s:double,counts:array<int>,from:int,to:int,out:array<struct<start:int,end:int>>>"
    initial = F.struct(
        F.lit(0).alias("at"),
        F.lit(0.0).alias("s"),
        F.array_repeat(F.lit(0), len(cls.alphabet) + 1).alias("counts"),
        F.lit(-1).alias("from"),
        F.lit(-1).alias("to"),
        F.array().cast("array<struct<start:int,end:int>>").alias("out"),
    ).cast(state)

    def step(codes: Column, acc: Column, entering: Column) -> Column:
        at = acc["at"] + 1  # characters seen, this one included
        leaving = F.when(at > n, F.element_at(codes, F.greatest(at - n, F.lit(1)))).otherwise(F.lit(-1))
        up = F.element_at(acc["counts"], entering + 1)
        grown = acc["s"] + _term(up + 1) - _term(up)
        # the count of the leaving character, the entering one already counted
        down = F.element_at(acc["counts"], F.greatest(leaving, F.lit(0)) + 1) + (leaving == entering).cast("int")
        s = F.when(leaving >= 0, grown + _term(down - 1) - _term(down)).otherwise(grown)
        counts = F.transform(
            acc["counts"], lambda c, i: c + (i == entering).cast("int") - (i == leaving).cast("int")
        )
        hit = (at >= n) & (s <= most)
        opens = hit & ((acc["to"] < 0) | (acc["to"] < at - n))
        closed = F.when(
            opens & (acc["to"] >= 0),
            F.concat(acc["out"], F.array(F.struct(acc["from"].alias("start"), acc["to"].alias("end")))),
        ).otherwise(acc["out"])
        return F.struct(
            at.cast("int").alias("at"),
            s.alias("s"),
            counts.alias("counts"),
            F.when(opens, at - n).otherwise(acc["from"]).cast("int").alias("from"),
            F.when(hit, at).otherwise(acc["to"]).cast("int").alias("to"),
            closed.alias("out"),
        ).cast(state)

    def finish(acc: Column) -> Column:
        last = F.array(F.struct(acc["from"].alias("start"), acc["to"].alias("end")))
        return F.when(acc["to"] >= 0, F.concat(acc["out"], last)).otherwise(acc["out"])

    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(cls.alphabet), c))
    # An array of one binds the codes, so that they are not made again at every step.
    bound = F.transform(F.array(codes), lambda cs: F.aggregate(cs, initial, lambda acc, x: step(cs, acc, x), finish))
    merged = F.element_at(bound, 1)
    return F.transform(merged, lambda x: F.struct((x["start"] + shift).alias("start"), (x["end"] + shift).alias("end")))


def entropy_spans(text: Column, cls: EntropyClass, allowed: tuple[str, ...]) -> Column:
    """array<struct<start,end,match>> of all windows with much entropy in the text's candidates."""
    candidates = F.filter(
        spans(text, cls.pattern, 0, cls.window), lambda s: reduce(Column.__and__, [s["match"].rlike(n) for n in cls.needs])
    )

    def of(s: Column) -> Column:
        return F.transform(
            window_spans(s["match"], s["start"], cls),
            lambda x: F.struct(
                x["start"].alias("start"),
                x["end"].alias("end"),
                F.substring(s["match"], x["start"] - s["start"] + 1, x["end"] - x["start"]).alias("match"),
            ),
        )

    return F.filter(F.flatten(F.transform(candidates, of)), lambda s: ~_any(s["match"], allowed))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    classes: tuple[EntropyClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """(id_col, spans array<struct<start,rank,end,kind,match>>) for every row.

    Spans are sorted by start, then by kind in the order assign, access, hex, then the entropy
    classes. Null and empty texts have an empty array; repeated rows are each reported; columns of
    other names are not read.
    """
    text = F.col("__t")
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__t"))
    kind_type = "array<struct<start:int,rank:int,end:int,kind:string,match:string>>"
    none = F.array().cast(kind_type)

    def tagged(column: Column, rank: int, kind: str) -> Column:
        return F.transform(
            column,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["match"].alias("match")
            ),
        ).cast(kind_type)

    found = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        found.append(F.when(text.rlike(QUICK[kind]), tagged(spans(text, pattern, group, least), rank, kind)).otherwise(none))
    for rank, cls in enumerate(classes, len(BASE)):
        windows = entropy_spans(text, cls, allowed)
        found.append(F.when(text.rlike(cls.pattern), tagged(windows, rank, cls.kind)).otherwise(none))
    return rows.select(F.col("__id").alias(id_col), F.array_sort(F.concat(*found)).alias("spans"))


def _any(column: Column, patterns: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | column.rlike(pattern)
    return hit
