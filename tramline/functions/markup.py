"""Text and image captions of a page section, with column functions only.

One regular expression cuts a page into tags and texts. A fold over them keeps the names of the open
elements: an end tag closes the innermost open element of its name and all within it, so a section
ends at its matching end tag, however its inner markup nests. Texts and captions are taken up on
the way by what is open at that moment; what has been closed is moved to the result at once, so the
state stays as small as the page's nesting. Pages that do not mention the section are not cut.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

VOID_TAGS = "area base br col embed hr img input link meta source track wbr".split()
IMAGE_TAG = "img"
SILENT_TAGS = ["script", "style", "template"]

# Attributes up to the closing >; quoted values may hold one. Possessive throughout: no backtracking.
_REST = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+>"""
TOKEN = "|".join([
    r"(?is)<!--.*?(?:--!?>|\z)",
    rf"<(script|style)(?=[\s/>]){_REST}(?:(?<!/>).*?(?=</\1[\s/>]|\z))?",  # what they hold is no markup
    rf"<[a-z]{_REST}",
    r"</[a-z][^>]*+>",
    r"<[!?/][^>]*+(?:>|\z)",
    r"[^<]++",
    r"<",
])
ATTRIBUTE = r"""[^\s/>"'=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
START, END, TEXT = 1, 2, 3
CHUNK = 512  # tokens
SECTIONS = "array<struct<depth:int,old_texts:string,texts:string,old_values:string,values:string>>"
SPANS = "array<struct<depth:int,around:array<int>,text:string>>"


def section_text(
    html: Column,
    tag: str = "div",
    css_class: str | None = "culture-content",
    text_tag: str = "span",
    attribute: str = "alt",
) -> Column:
    """Per section: the text of its text elements, then its attribute values, joined.

    A section is a ``tag`` element of ``css_class`` (any one without). An element inside another one
    of its kind repeats its text, as each element counts with all it holds. A page without the
    section gives an empty string.
    """
    classes = [css_class] if css_class else []
    marked = _mentions(html, classes or [f"<{tag}"])
    tokens = _tokens(html, tag, classes, attribute)
    # depth 0: closed. A text belongs to the sections, by their number, that were open at its start.
    start = F.struct(
        F.array().cast("array<string>").alias("stack"),
        F.array().cast(SECTIONS).alias("sections"),
        F.array().cast(SPANS).alias("spans"),
        F.lit("").alias("out"),
        F.lit("").alias("told"),
    )

    def step(s, x):
        return (
            F.when(x["kind"] == TEXT, _with(s, spans=F.when(_speaks(s), _said(s, x)).otherwise(s["spans"])))
            .when(x["kind"] == END, F.when(_height(s, x) >= 0, _close(s, _height(s, x))).otherwise(s))
            .otherwise(_open(s, x))
        )

    def _speaks(s):
        return (F.size(s["spans"]) > 0) & ~F.coalesce(F.element_at(s["stack"], -1).isin(SILENT_TAGS), F.lit(False))

    def _said(s, x):
        return F.transform(s["spans"], lambda p: F.when(p["depth"] > 0, _with(p, text=F.concat(p["text"], x["text"]))).otherwise(p))

    def _open(s, x):
        depth = (F.size(s["stack"]) + 1).cast("int")
        numbers = F.sequence(F.lit(0), F.size(s["sections"]) - 1)
        around = F.filter(numbers, lambda i: F.get(s["sections"], i)["depth"] > 0)
        inside = F.size(s["sections"]) > 0
        valued = F.transform(
            s["sections"],
            lambda o: F.when(o["depth"] > 0, _with(o, values=F.concat(o["values"], x["value"]))).otherwise(o),
        )
        sections = F.when(inside & x["value"].isNotNull(), valued).otherwise(s["sections"])
        section = F.struct(depth.alias("depth"), *(F.lit("").alias(n) for n in ("old_texts", "texts", "old_values", "values")))
        span = F.struct(depth.alias("depth"), around.alias("around"), F.lit("").alias("text"))
        pushed = _with(
            s,
            stack=F.array_append(s["stack"], x["name"]),
            sections=F.when(F.size(x["hits"]) > 0, F.array_append(sections, section)).otherwise(sections),
            spans=F.when(inside & (x["name"] == text_tag), F.array_append(s["spans"], span)).otherwise(s["spans"]),
        )
        return F.when(x["alone"], _with(s, sections=sections)).otherwise(pushed)

    def _close(s, height):
        spans = F.transform(s["spans"], lambda p: _with(p, depth=F.when(p["depth"] <= height, p["depth"]).otherwise(0)))
        ended = (F.size(s["spans"]) > 0) & ~F.exists(s["spans"], lambda p: (p["depth"] > 0) & (p["depth"] <= height))
        texts = F.transform(
            s["sections"],
            lambda o, i: _with(
                o,
                texts=F.concat(
                    o["texts"],
                    F.array_join(F.transform(F.filter(s["spans"], lambda p: F.array_contains(p["around"], i)), lambda p: p["text"]), ""),
                ),
            ),
        )
        cut = F.slice(s["stack"], 1, height)
        spoken = F.when(ended, _with(s, stack=cut, sections=texts, spans=F.array().cast(SPANS)))
        spoken = spoken.otherwise(_with(s, stack=cut, spans=F.when(F.size(s["spans"]) > 0, spans).otherwise(s["spans"])))
        # what follows sees the state computed once
        return F.when(F.size(s["sections"]) > 0, _bound(spoken, lambda t: _left(t, height))).otherwise(_with(s, stack=cut))

    def _left(t, height):
        over = ~F.exists(t["sections"], lambda o: (o["depth"] > 0) & (o["depth"] <= height))
        told = F.array_join(F.transform(t["sections"], lambda o: F.concat(o["old_texts"], o["texts"], o["old_values"], o["values"])), "")
        rest = F.transform(t["sections"], lambda o: _with(o, depth=F.when(o["depth"] <= height, o["depth"]).otherwise(0)))
        return F.when(over, _with(t, sections=F.array().cast(SECTIONS), out=F.concat(t["out"], told))).otherwise(_with(t, sections=rest))

    def settled(s):
        """Long texts are put aside after each chunk, so that steps only copy short ones."""
        sections = F.transform(
            s["sections"],
            lambda o: F.struct(
                o["depth"].alias("depth"),
                F.concat(o["old_texts"], o["texts"]).alias("old_texts"), F.lit("").alias("texts"),
                F.concat(o["old_values"], o["values"]).alias("old_values"), F.lit("").alias("values"),
            ),
        )
        return _with(s, sections=sections, out=F.lit(""), told=F.concat(s["told"], s["out"]))

    def end(s):
        rest = _bound(_close(s, F.lit(0)), lambda t: F.concat(t["told"], t["out"]))
        return F.when(F.size(s["sections"]) > 0, rest).otherwise(F.concat(s["told"], s["out"]))

    def folded(tokens):
        places = F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1)), F.lit(CHUNK))
        return F.aggregate(
            places, start, lambda s, i: _bound(F.aggregate(F.slice(tokens, i, F.lit(CHUNK)), s, step), settled), end
        )

    whole = _bound(tokens, folded)
    return F.when(marked, whole).when(html.isNotNull(), F.lit(""))


def first_captions(
    html: Column, classes: Sequence[str], tag: str = "div", attribute: str = "alt"
) -> Column:
    """Per class: the attribute of the first image in its first section, null if none.

    An array in the order of ``classes``; null for a page that mentions none of them.
    """
    tokens = _tokens(html, tag, classes, attribute, texts=False)
    # depth null: not begun, 0: closed; seen: its first image has passed
    first = F.struct(F.lit(None).cast("int").alias("depth"), F.lit(False).alias("seen"), F.lit(None).cast("string").alias("caption"))
    start = F.struct(F.array().cast("array<string>").alias("stack"), F.array(*[first] * len(classes)).alias("firsts"))
    names = F.array(*[F.lit(c) for c in classes])

    def step(s, x):
        depth = (F.size(s["stack"]) + 1).cast("int")
        image = F.transform(
            s["firsts"],
            lambda f: F.when(
                (f["depth"] > 0) & ~f["seen"], F.struct(f["depth"].alias("depth"), F.lit(True).alias("seen"), x["value"].alias("caption"))
            ).otherwise(f),
        )
        begun = F.transform(
            s["firsts"],
            lambda f, i: F.when(
                f["depth"].isNull() & F.array_contains(x["hits"], F.get(names, i)),
                _with(f, depth=F.when(x["alone"], 0).otherwise(depth)),
            ).otherwise(f),
        )
        firsts = F.when(x["name"] == IMAGE_TAG, image).when(F.size(x["hits"]) > 0, begun).otherwise(s["firsts"])
        stack = F.when(x["alone"], s["stack"]).otherwise(F.array_append(s["stack"], x["name"]))
        height = _height(s, x)
        ended = F.transform(s["firsts"], lambda f: F.when(f["depth"] > height, _with(f, depth=F.lit(0))).otherwise(f))
        closed = F.struct(F.slice(s["stack"], 1, height).alias("stack"), ended.alias("firsts"))
        return F.when(x["kind"] == END, F.when(height >= 0, closed).otherwise(s)).otherwise(_with(s, stack=stack, firsts=firsts))

    found = F.aggregate(tokens, start, step, lambda s: F.transform(s["firsts"], lambda f: f["caption"]))
    return F.when(_mentions(html, classes), found)


def unescaped(text: Column) -> Column:
    """Character references of HTML resolved, names without semicolon where HTML allows that."""
    parts = F.regexp_extract_all(text, F.lit(r"&#[0-9]++;?+|&#[xX][0-9a-fA-F]++;?+|&[A-Za-z][A-Za-z0-9]*+;?+|[^&]++|&"), 0)
    exact = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    legacy = F.from_json(F.lit(json.dumps({k: v for k, v in html5.items() if not k.endswith(";")})), "map<string,string>")
    longest = max(len(k) for k in html5 if not k.endswith(";"))

    def named(part):
        name = F.substring(part, 2, 1 << 20)
        sizes = F.sequence(F.least(F.length(name), F.lit(longest)), F.lit(1), F.lit(-1))
        known = F.filter(F.transform(sizes, lambda k: F.left(name, k)), lambda n: F.map_contains_key(legacy, n))
        begun = F.get(known, F.lit(0))
        rest = F.substr(name, F.length(begun) + 1)
        return F.coalesce(F.try_element_at(exact, name), F.concat(F.try_element_at(legacy, begun), rest), part)

    one = F.transform(
        parts,
        lambda p: F.when(p.startswith("&#"), _character(p)).when(p.startswith("&") & (F.length(p) > 1), named(p)).otherwise(p),
    )
    return F.when(text.contains("&"), F.array_join(one, "")).otherwise(text)


def _character(reference):
    """The character of a numeric reference; numbers that are none give U+FFFD or nothing, as HTML has it."""
    wide = F.lower(reference).startswith("&#x")
    digits = F.ltrim(F.regexp_extract(reference, "([0-9a-fA-F]+);?$", 1), F.lit("0"))
    number = F.when(F.length(digits) > 8, F.lit(1 << 32)).when(digits == "", F.lit(0))
    number = number.when(wide, F.conv(digits, 16, 10).cast("long")).otherwise(F.conv(digits, 10, 10).cast("long"))
    western = {str(i): bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)}
    old = F.from_json(F.lit(json.dumps(western)), "map<string,string>")

    def character(n):
        plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        control = ((n < 32) & ~n.isin(9, 10, 12, 13)) | (n == 127) | n.between(0xFDD0, 0xFDEF)
        return (
            F.when((n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit("�"))
            .when(n.between(0x80, 0x9F), F.try_element_at(old, n.cast("string")))
            .when(control | (n.bitwiseAND(0xFFFE) == 0xFFFE), F.lit(""))
            .otherwise(plain)
        )

    return F.get(F.transform(F.array(number), character), F.lit(0))


def _tokens(html, tag, classes, attribute, texts=True):
    """Array of (kind, name, alone, value, hits, text): start tags, end tags and texts of the page.

    ``alone``: the element has no content. ``value``: its ``attribute``. ``hits``: the classes that
    make it a section.
    """

    def parsed(t):
        kind = (
            F.when(~t.startswith("<") | (F.length(t) == 1), TEXT)
            .when(t.rlike("^<[A-Za-z]"), START)
            .when(t.rlike("^</[A-Za-z]"), END)
            .otherwise(0)
        )
        return F.struct(kind.alias("kind"), F.lower(F.regexp_extract(t, r"^</?([A-Za-z][^\s/>]*)", 1)).alias("name"), t.alias("t"))

    def read(x):
        tagged = x["kind"] == START
        lowered = F.lower(x["t"])
        value = F.when(tagged & lowered.contains(attribute.lower()), _attribute(x["t"], attribute))
        section = tagged & (x["name"] == tag)
        if classes:
            given = F.split(F.when(section & lowered.contains("class"), _attribute(x["t"], "class")), r"\s+")
            hits = F.coalesce(F.array_intersect(given, F.array(*[F.lit(c) for c in classes])), F.array().cast("array<string>"))
        else:
            hits = F.when(section, F.array(F.lit(tag))).otherwise(F.array().cast("array<string>"))
        return F.struct(
            x["kind"].alias("kind"),
            x["name"].alias("name"),
            (x["name"].isin(VOID_TAGS) | (x["t"].endswith("/>") & ~x["t"].rlike(r"""=[^\s"'>]*/>$"""))).alias("alone"),
            value.alias("value"),
            hits.alias("hits"),
            F.when(x["kind"] == TEXT, unescaped(x["t"])).alias("text"),
        )

    kinds = [START, END, TEXT] if texts else [START, END]
    cut = F.transform(F.regexp_extract_all(html, F.lit(TOKEN), 0), parsed)
    return F.transform(F.filter(cut, lambda x: x["kind"].isin(kinds)), read)


def _attribute(t, name):
    """Value of the last attribute of that name in a start tag, empty if it has none, null without it."""
    inner = F.regexp_replace(t, r"^<[^\s/>]*", "")
    found = F.filter(
        F.regexp_extract_all(inner, F.lit(ATTRIBUTE), 0),
        lambda a: F.lower(F.regexp_extract(a, r"^([^\s=]+)", 1)) == name.lower(),
    )
    last = F.try_element_at(found, F.lit(-1))
    return unescaped(F.regexp_extract(last, r"""(?s)=\s*(["']?)(.*)\1$""", 2))


def _height(s, x):
    """Open elements left when the end tag closes the innermost one of its name; -1 if there is none."""
    place = F.array_position(F.reverse(s["stack"]), x["name"])
    return F.when(place > 0, F.size(s["stack"]) - place).otherwise(-1).cast("int")


def _bound(value, use):
    """``use(value)`` with the value computed once, however often it is read."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _with(struct, **fields):
    """The struct with some fields changed; all fields in the order they are first read."""
    return reduce(lambda c, f: c.withField(f, fields[f]), fields, struct)


def _mentions(html, words):
    """True where one of ``words`` occurs; only such pages are cut into tokens."""
    lowered = F.lower(html)
    return reduce(Column.__or__, [lowered.contains(word.lower()) for word in words])
