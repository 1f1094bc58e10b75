from __future__ import annotations

import itertools
import math
import re
import time
from html import unescape

import pytest

from feedloom.llm.html_extract import FRAME, STATES, Model, evidence, extract, fit, link, main_text, observed, parse


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return fit(pages)


def of_article(html):
    """The text between the article tags, by patterns that hold for these pages."""
    inner = re.search(r"<article>(.*?)(</article>|$)", html, re.S)[1]
    blocks = re.sub(r"</?(p|h1)>", "\n\n", inner.replace("<br>", " "))
    plain = re.sub(r"<[^>]*(>|$)", "", blocks)
    texts = (" ".join(unescape(block).split()) for block in plain.split("\n\n"))
    return "\n\n".join(text for text in texts if text)


def test_pages_give_their_article(spark, pages):
    for row in extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        assert row["text"] == of_article(row["html"])
        assert row["n_chars"] == len(row["text"])


def test_marginals_are_those_of_all_labellings(model):
    page = "<div class='ad'><p>x</p></div><main><p>long text <b>and</b> more</p><ul><li>y</ul></main>"
    nodes, _ = parse(page)
    potentials = [model.potential(evidence(node)) for node in nodes]
    weight, content = 0.0, [0.0] * len(nodes)
    for labels in itertools.product(STATES, repeat=len(nodes) - 1):
        states = (FRAME, *labels)
        share = math.prod(
            potentials[at][states[at]] * model.pairs[link(nodes[at])][states[nodes[at].parent]][states[at]]
            for at in range(1, len(nodes))
        )
        weight += share
        for at, state in enumerate(states):
            content[at] += share * (state == 1)
    assert model.marginals(nodes) == pytest.approx([total / weight for total in content])


@pytest.mark.parametrize("icon", ["<svg/>", '<svg class="icon" viewBox="0 0 1 1" />', "<SVG width='1'/>"])
def test_a_self_closed_svg_has_no_content(pages, model, icon):
    for row in pages.limit(20).collect():
        before = row["html"].replace("<article>", f"{icon}<article>")
        both = before.replace("</article>", "</article><svg><text>drawn</text></svg>")
        assert main_text(before, model) == main_text(both, model) == of_article(row["html"])


@pytest.mark.parametrize("container", ["<div class='content'>", "<div>", "<td>"])
def test_pages_with_another_container_give_the_same(pages, model, container):
    for row in pages.limit(60).collect():
        html = row["html"].replace("<article>", container)
        assert main_text(html, model) == of_article(row["html"])


CASES = {
    "parts named by tag": (
        "<header><h1>Site</h1><nav><a href='/'>Home</a></nav></header><main><article><h1>Title &amp; more</h1>"
        "<p>One&nbsp;two\n three <em>four</em> five.</p><form><p>Subscribe</p></form></article></main>"
        "<aside><ul><li>x</li></ul><p>Some long sidebar text that looks like prose, too.</p></aside><footer><p>(c)</p></footer>",
        "Title & more\n\nOne two three four five.",
    ),
    "parts named by class": (
        "<div id='header'><a href='/'>Home</a></div><div class='wrap'><div class='post'><h2>Title</h2><p>One <b>two</b>."
        "<p>Para <a href='x'>link</a> text goes on for a while.<ul><li>item one<li>item two</ul></div>"
        "<div class='comments'><p>Nice post, a long comment that goes on and on.</p></div>"
        "<div class='cookie-notice'><p>We use cookies</p></div></div>",
        "Title\n\nOne two.\n\nPara link text goes on for a while.\n\nitem one\n\nitem two",
    ),
    "adverts inside": (
        "<article><p>First part of it.</p><div class='ad'><p>Buy now!</p></div><section id='comments'><p>First!</p></section>"
        "<p>Last part of it.</p></article>",
        "First part of it.\n\nLast part of it.",
    ),
    "scripts and comments": (
        "<article><!-- <p>no</p> --><script>var t='</p><p>x';</script><style>p{}</style><p>Only &lt;this&gt; &#233;</p></article>",
        "Only <this> é",
    ),
    "cut off": ("<article><p>Begun and <b>not ended", "Begun and not ended"),
    "cut off in a tag": ("<article><p>Begun</p><a href='x", "Begun"),
    "stray signs": ("<article><p>1 < 2 & 3 > 2</p></article></div></p>", "1 < 2 & 3 > 2"),
    "upper case": ("<ARTICLE><P>Loud</P></ARTICLE>", "Loud"),
    "nothing": ("", ""),
    "null": (None, ""),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_pages_unlike_those_learned_from(model, name):
    html, want = CASES[name]
    assert main_text(html, model) == want


def test_deep_and_long_pages(model):
    assert main_text("<div>" * 3000 + "<article><p>deep</p></article>", model) == "deep"
    many = "<article>" + "<p>some words</p>" * 20_000 + "</article>"
    assert main_text(many, model).count("some words") == 20_000


def test_pages_that_mark_no_article_teach_nothing():
    assert observed(["<p>text</p>", "", None]) == {}
    assert main_text("<article><p>some text</p></article><footer>x</footer>", Model({})) == "some text"


@pytest.mark.parametrize("piece", ["<div>", "</b>", "</div>", "<p>", "<ul><li>", "<b><i></b>", "<p><table><tr>", "<td>", "<!--", "<p title='"])
def test_hostile_pages_are_parsed_in_linear_time(piece):
    started = time.process_time()
    nodes, _ = parse("<p><table>" + piece * 200_000)
    assert nodes and time.process_time() - started < 20


def test_a_p_is_closed_within_its_table_cell_only():
    nodes, _ = parse("<p>a<table><tr><td>b<div>c</div><p>d<div>e</div></td></tr></table>")
    parents = [(node.tag, nodes[node.parent].tag if node.parent >= 0 else None) for node in nodes]
    assert ("div", "td") in parents and ("p", "td") in parents and ("div", "p") not in parents
