"""Markup in attribute values, formulas, lists of links, labels and deep nesting."""

from __future__ import annotations

import time

import pytest

from metricspark.llm import html_text

PROSE = "This is a long paragraph of prose, with commas, that says something about the subject at hand. It goes on for a while."


def article(inside: str) -> str:
    return html_text.extract(f"<body><div><article><p>{PROSE}</p>{inside}<p>{PROSE}</p></article></div></body>").removeprefix(f"{PROSE}\n").removesuffix(f"\n{PROSE}")


@pytest.mark.parametrize(
    ("inside", "want"),
    [
        ('<p title="a<b>c">This is a long sentence, of the text.</p>', "This is a long sentence, of the text."),
        ('<p>See <a href="x?a<b" title="see <i>this</i> now">link text</a> there, as usual.</p>', "See link text there, as usual."),
        ("<p title='\"<p>\"' data-x = \"'>'\">Quotes in quotes, of both kinds.</p>", "Quotes in quotes, of both kinds."),
        ("<p>The area is <math><mi>x</mi> = 4</math> units.</p>", "The area is x = 4 units."),
        ('<ul><li><a href="a">First reference link</a></li><li><a href="b">Second reference link</a></li></ul>', "First reference link\nSecond reference link"),
        ("<p>Press the <label>big red</label> button, then wait.</p>", "Press the big red button, then wait."),
        ('<p class="x>A quote that never ends is a character.</p>', "A quote that never ends is a character."),
        ("<p>One < two, they say.</p>", "One < two, they say."),
    ],
)
def test_markup_inside_an_article(inside, want):
    assert article(inside) == want


def test_labels_of_forms_are_no_text():
    assert "name" not in article("<form><label>Your name</label><input name=n><p>Send it.</p></form>")


@pytest.mark.parametrize("depth", [10, 511, 513, 5000])
def test_depth_has_no_limit(depth):
    page = f"<article>{'<div>' * depth}<p>{PROSE}</p>{'</div>' * depth}<p>{PROSE}</p></article><div class='footer'>All rights reserved, as ever.</div>"
    assert html_text.extract(page) == f"{PROSE}\n{PROSE}"


NESTED = [
    f"<div class='page'><header><h1>Site</h1></header><div class='wrap'><nav><ul><li>a</li></ul></nav><main><article><h2>Title {k}</h2>"
    + "".join(f"<section><div><p>{PROSE} Part {j}.</p><blockquote><p>Quoted words, number {j}.</p></blockquote></div></section>" for j in range(k + 1))
    + f"</article></main><aside><p>{PROSE} Not this.</p></aside></div><footer><p>Imprint, {k}.</p></footer></div>"
    for k in range(10)
]


@pytest.mark.parametrize("k", range(10))
def test_nested_boxes(k):
    want = [f"Title {k}"] + [t for j in range(k + 1) for t in (f"{PROSE} Part {j}.", f"Quoted words, number {j}.")]
    assert html_text.extract(NESTED[k]) == "\n".join(want)


@pytest.mark.parametrize(
    "page",
    ['<a "' * 50_000, '<a ="' * 50_001, "<a ='\"" * 50_000, "<li><ul>" + "<div>" * 30_000 + "<li></li>" * 30_000, "<div>" * 100_000, "<p>" * 100_000, "<a " + "= " * 100_000, "<b" + '="' * 100_001 + ">"],
)
def test_time_is_linear_in_the_markup(page):
    began = time.perf_counter()
    html_text.extract(page)
    assert time.perf_counter() - began < 10
