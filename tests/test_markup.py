import html as python_html
import random
import re

import pytest
import section_reader
from pyspark.sql import functions as F

from tramline.functions import markup

C = 'class="culture-content"'


@pytest.mark.parametrize(
    "html, expected",
    [
        (f'<div {C}><span>a</span><span>b</span><img alt="c"></div>', "abc"),
        (f'<div {C}><span>a</span><img alt=""><img alt></div>', "a"),
        (f'<span>no</span><div {C}><span>a</span></div><img alt="no"><span>no</span>', "a"),
        ("<div><span>a</span></div>", ""),
        ("", ""),
        (None, None),
        # nested markup: the section ends at its own end tag
        (f"<div {C}><div><span>a</span></div><span>b</span></div><span>no</span>", "ab"),
        # a span's text counts with all it holds, so inner spans repeat
        (f"<div {C}><span>a<span>b</span>c</span></div>", "abcb"),
        (f"<div {C}><span>x &amp; y<br>z<!-- c --></span></div>", "x & yz"),
        (f"<div {C}><span>a<script>no</script></span></div>", "a"),
        # two sections: texts then captions of each
        (f'<div {C}><img alt="1"><span>a</span></div><div {C}><span>b</span></div>', "a1b"),
        (f'<div class="x culture-content y"><span alt="t">a</span></div>', "at"),
        (f"<div {C}><span>a", "a"),
        ('<div class="other">culture-content</div>', ""),
        # mentions that start no section, and sections after them
        (f'<p>culture-content</p><div {C}><span>a</span></div><div {C}><span>b</span></div>', "ab"),
        (f'<div {C}><span>a</span><div {C}><span>b</span></div></div><span>no</span>', "abb"),
        (f"<!-- culture-content --></p><div {C}><span>a</span></div>", "a"),
        (f"<DIV {C}><SPAN>a</SPAN></DIV>", "a"),
        (f"<div {C}><p><span>a</p><span>b</span></div>", "ab"),
    ],
)
def test_section_text(one, html, expected):
    assert one(markup.section_text(F.col("h")), [(html,)], "h string") == [expected]


def test_long_page_is_read_to_its_end(one):
    html = f"<div {C}>" + "<span>ab</span>" * 40_000 + '<img alt="end"></div>'
    (found,) = one(markup.section_text(F.col("h")), [(html,)], "h string")
    assert found == "ab" * 40_000 + "end"


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<div class="img-box"><img alt="a"><img alt="b"></div>', "a"),
        ('<div class="img-box"><img><img alt="b"></div>', None),
        ('<div class="img-box"><img alt=""></div>', ""),
        ('<div class="img-box"><p>x</p></div><div class="img-box"><img alt="b"></div>', None),
        ('<div><img alt="a"></div>', None),
        ('<div class="img-box"><div><a><img alt="a"/></a></div></div>', "a"),
        (None, None),
    ],
)
def test_first_caption(one, html, expected):
    first = F.get(markup.first_captions(F.col("h"), ["img-box"]), F.lit(0))
    assert one(first, [(html,)], "h string") == [expected]


def test_first_captions_of_two_classes(one):
    html = ('<div class="img-box"><img alt="box"></div><div class="culture-content"><p>x</p></div>'
            '<div class="culture-content img-box"><img alt="late"></div>')
    both = markup.first_captions(F.col("h"), ["culture-content", "img-box"])
    assert one(both, [(html,), ("<p>",)], "h string") == [[None, "box"], None]


def random_page(rng):
    """Tags that open, nest, cross and miss one another, with attributes in all styles."""
    classes = ["culture-content", "img-box", "x culture-content", "img-box culture-content", "other"]
    out = []
    for _ in range(rng.randint(0, 40)):
        tag = rng.choice(["div", "div", "div", "span", "span", "p", "b", "DIV", "Span", "section"])
        kind = rng.randrange(12)
        if kind < 4:
            attrs = rng.choice(["", f' class="{rng.choice(classes)}"', f" class='{rng.choice(classes)}'", f' id=a class = "{rng.choice(classes)}"', " class=img-box", ' title="a > b"'])
            out.append(f"<{tag}{attrs}{rng.choice(['', '', ' alt=t', ' ALT=&quot;q&quot;'])}>")
        elif kind < 7:
            out.append(f"</{tag}{rng.choice(['', ' ', ' x'])}>")
        elif kind == 7:
            alt = rng.choice(["", " alt", ' alt=""', ' alt="c d"', " alt='e'", " alt=f", ' data-alt="no"', ' title="alt=no"', ' alt="1" alt="2"', ' alt = "&lt;&eacute"'])
            out.append(f"<img src=/a{alt}{rng.choice(['>', '/>', ' />'])}")
        elif kind == 8:
            out.append(rng.choice(["<!-- <div class='culture-content'> -->", "<script>if (a<b) '<span>'</script>", "<style>p{}</style>", "<br>", "<br/>", "<!DOCTYPE html>", "<span/>", "<div class='img-box'/>", "<template>t</template>", "<a href=/b/>"]))
        else:
            out.append(rng.choice(["a", " b\n", "&amp;", "&lt;x", "&copy z", "&notit;", "&#233;", "&#x80;", "&#0;", "&#1;", "&#xD800;", "& ", "&;", "\u00e9", "2 > 1", "&bogus;", "&#99999999999;", "&hellip;"]))
    return "".join(out)


def test_random_markup_equals_python(one):
    rng = random.Random(7)
    pages = [random_page(rng) for _ in range(3000)]
    texts = one(markup.section_text(F.col("h")), [(p,) for p in pages], "h string")
    marked = [p for p in pages if "culture-content" in p]
    assert len(marked) > 1500
    want = [section_reader.section_text(p) if "culture-content" in p else "" for p in pages]
    assert [(p, t, w) for p, t, w in zip(pages, texts, want) if t != w] == []
    both = markup.first_captions(F.col("h"), ["culture-content", "img-box"])
    captions = one(both, [(p,) for p in pages], "h string")
    want = [section_reader.first_captions(p, ["culture-content", "img-box"]) if re.search("culture-content|img-box", p) else None for p in pages]
    assert [(p, c, w) for p, c, w in zip(pages, captions, want) if c != w] == []
    anchors = one(markup.section_text(F.col("h"), "p", None, text_tag="b", attribute="class"), [(p,) for p in pages], "h string")
    assert anchors == [section_reader.section_text(p, "p", None, "b", "class") for p in pages]


def test_character_references_equal_python(one):
    from html.entities import html5

    rng = random.Random(3)
    texts = [f"a&{k}b" for k in html5] + [f"&#{n};" for n in [*range(300), 0xFDD0, 0xFFFE, 0x1F600, 0x10FFFF, 0x110000]]
    texts += ["".join(rng.choices(["&", "#", "x", "1", "38", ";", "amp", "lt", "not", "in", "G", " "], k=6)) for _ in range(2000)]
    got = one(markup.unescaped(F.col("t")), [(t,) for t in texts], "t string")
    assert [(t, g) for t, g in zip(texts, got) if g != python_html.unescape(t)] == []


def test_plan_has_no_python(spark):
    pages = spark.createDataFrame([("<p>",)], "h string")
    both = markup.first_captions(F.col("h"), ["a", "b"])
    plan = pages.select(markup.section_text(F.col("h")), both)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("PythonUDF|EvalPython|InPandas|InArrow", plan)


def test_long_attributes_and_deep_nesting(one):
    image = "<img src='data:" + "A=b" * 200_000 + "' alt=i>"
    deep = "<b>" * 300 + "x" + "</b>" * 300
    page = f"<div {C}>{image}<span>{deep}</span></div>"
    assert one(markup.section_text(F.col("h")), [(page,)], "h string") == ["xi"]
