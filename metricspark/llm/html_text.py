"""Main text of web pages by tag-path ratios.

A scanner turns each page into its text blocks with their root-to-leaf tag paths.
Text length outside links and punctuation are aggregated per path of the page and
fused into one ratio per path.  A path's ratio is smoothed along the tree: with
the best one of the box (``div``, ``section``, ``article`` ...) that holds the
block, and with that of the box around it, so that headings, lists, tables and
short lines share the fate of the prose they stand in.  What a page declares only
weighs in the score: names of boilerplate lower it, ``article`` and ``main``
raise it.  Blocks that reach a share of the page's best score are content.

Only elements that HTML itself defines as no part of the text are left out
unscored: navigation, footers, asides, dialogs, scripts, styles, hidden elements
and form controls.

A page is one row and is scored where it is scanned, so the job has no shuffle.
Time and memory are linear in the page, however deep its elements are nested: path
ids replace path strings, and the open elements of a name are found by look-up.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from math import sqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.llm.textops import slices

#: Share of the page's best score that content reaches.
THRESHOLD = 0.25
#: A block in declared boilerplate is no content below this score, even where it is the page's best.
FLOOR = 10.0
#: Weights of blocks in declared boilerplate, in forms, in paths that are mostly links, in ``main`` and in ``article``.
DECLARED, IN_FORM, LINKED, IN_MAIN, IN_ARTICLE = 0.02, 0.2, 0.3, 4.0, 8.0
#: What a box further out lends to a block, for each box between.
FADES = 0.9
#: Share of a box's characters that a path holds to speak for the box.
SPEAKS = 0.1

# Element names by role.
BLOCKS = frozenset(
    "html body head article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption address hr header footer nav aside form fieldset legend details summary dialog menu center".split()
)
FORMS = ("form", "fieldset")
BOXES = frozenset("html body article section main div header form fieldset center details td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg".split())
DROPPED = frozenset("head nav footer aside dialog menu button select object canvas audio video".split())
# Words of class, id and role names that declare boilerplate, and words that may stand beside them.
BOILERPLATE = frozenset(
    "ad ads adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs pagination pager sidebar aside rail complementary footer contentinfo header masthead topbar toolbar cookie "
    "cookies consent gdpr notice notices popup modal overlay alert share sharing social related recommended newsletter subscribe signup "
    "comment comments commentlist disqus respond reply replies search login".split()
)
BESIDE = frozenset(
    "area bar block body bottom box column container content form group icons inner item items layer left link links list main outer page "
    "panel policy posts primary region right secondary section site slot text thread title top widget widgets wrap wrapper".split()
)
CLOSES = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr", "table thead tbody tfoot"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
}
CLOSES = {name: (frozenset(a.split()), frozenset(b.split())) for name, (a, b) in CLOSES.items()}

# A quoted attribute value, which follows an equals sign, may hold anything; a quote that never ends is a character like others.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]|=(?:\s*(?:\"[^\"]*\"|'[^']*'))?+)*+)(?P<shut>>|\Z)",
    re.S,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。、！？；：]")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}
_CLOSES_P = (frozenset("p"), frozenset())


@lru_cache(maxsize=65536)
def declares_boilerplate(name: str) -> bool:
    """Whether one class, id or role name says boilerplate: every word of it does, or may stand beside such a word."""
    words = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if w]
    return not BOILERPLATE.isdisjoint(words) and all(w in BOILERPLATE or w in BESIDE for w in words)


class _Element:
    """An open block element: its node, what holds inside it, and the inline elements open in it."""

    __slots__ = ("name", "node", "dropped", "weight", "inline", "muted")

    def __init__(self, name: str, node: int, dropped: bool, weight: float):
        self.name, self.node, self.dropped, self.weight = name, node, dropped, weight
        self.inline: dict[str, int] = {}  # open ones by name
        self.muted: dict[str, int] = {}  # open ones that are not shown


@dataclass
class Blocks:
    """Text blocks of a page in order, and the tree of block elements they stand in."""

    text: list[str] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    node: list[int] = field(default_factory=list)
    weight: list[float] = field(default_factory=list)
    # of each node; node 0 is the page
    parent: list[int] = field(default_factory=lambda: [0])
    name: list[str] = field(default_factory=lambda: ["body"])
    named: list[str] = field(default_factory=lambda: [""])
    children: list[int] = field(default_factory=lambda: [0])


def _hidden(name: str, attrs: str) -> bool:
    return ("hidden" in attrs or "none" in attrs) and name not in ("html", "body") and _HIDDEN.search(attrs) is not None


class _Scanner:
    """One pass over a page's markup."""

    def __init__(self, page: str):
        self.page, self.out = page, Blocks()
        self.stack = [_Element("", 0, False, 1.0)]
        self.open: dict[str, list[int]] = {}  # places on the stack of the open block elements of each name
        self.parts: list[str] = []
        self.links = self.in_link = 0

    def flush(self) -> None:
        """End the block that is being read."""
        text = " ".join(html.unescape("".join(self.parts)).split()) if self.parts else ""
        if text:
            top, out = self.stack[-1], self.out
            out.text.append(text)
            out.links.append(min(self.links, len(text)))
            out.node.append(top.node)
            out.weight.append(top.weight)
        self.parts.clear()
        self.links = 0

    def pop(self) -> str:
        top = self.stack.pop()
        self.in_link -= top.inline.get("a", 0)
        self.open[top.name].pop()
        return top.name

    def innermost(self, names: Iterable[str]) -> int:
        """Place on the stack of the innermost open element of the names, 0 where none is open."""
        return max((self.open[n][-1] for n in names if self.open.get(n)), default=0)

    def open_inline(self, name: str, attrs: str) -> None:
        top = self.stack[-1]
        if name in top.muted:
            top.muted[name] += 1
        elif name in DROPPED or (name == "label" and self.innermost(FORMS)) or (attrs and _hidden(name, attrs)):
            top.muted[name] = 1
        else:
            top.inline[name] = top.inline.get(name, 0) + 1
            self.in_link += name == "a"

    def close_inline(self, name: str) -> None:
        top = self.stack[-1]
        if name in top.muted:
            top.muted[name] -= 1
            if not top.muted[name]:
                del top.muted[name]
        elif top.inline.get(name):
            top.inline[name] -= 1
            self.in_link -= name == "a"

    def close_block(self, name: str) -> None:
        if self.open.get(name):
            while self.pop() != name:
                pass

    def close_implied(self, name: str) -> None:
        """Elements that the start of ``name`` ends."""
        closing, within = CLOSES.get(name, _CLOSES_P)
        depth = self.innermost(closing)
        if depth > self.innermost(within):
            while len(self.stack) > depth:
                self.pop()

    def open_block(self, name: str, attrs: str) -> None:
        top, out = self.stack[-1], self.out
        dropped = top.dropped or bool(top.muted) or name in DROPPED or _hidden(name, attrs)
        names = [(m[1].lower(), v) for m in _NAMES.finditer(attrs) for v in (m[2] or m[3] or m[4] or "").split()] if "=" in attrs else ()
        weight = top.weight
        if weight >= 1:
            if name == "article":
                weight = IN_ARTICLE
            elif name == "main":
                weight = max(weight, IN_MAIN)
            if name in FORMS:
                weight = IN_FORM
        if weight > DECLARED and name not in ("html", "body", "main"):
            outer = name == "header" and weight <= 1 and top.name != "section"  # a page's, not an article's
            if outer or (names and any(declares_boilerplate(v) for _, v in names)):
                weight = DECLARED
        out.children[top.node] += 1
        out.parent.append(top.node)
        out.name.append(name)
        out.named.append(" ".join(sorted({re.sub(r"[0-9]+", "0", v) for k, v in names if k == "class"})) if names else "")
        out.children.append(0)
        self.open.setdefault(name, []).append(len(self.stack))
        self.stack.append(_Element(name, len(out.parent) - 1, dropped, weight))

    def run(self) -> Blocks:
        page, at = self.page, 0
        while at < len(page):
            m = _TOKEN.search(page, at)
            end = m.start() if m else len(page)
            if end > at:
                top = self.stack[-1]
                if not top.dropped and not top.muted:
                    self.parts.append(page[at:end])
                    if self.in_link:
                        self.links += end - at
            if m is None:
                break
            at = m.end()
            name = m["name"]
            if not name:
                continue
            if not m["shut"]:
                break  # the page ends inside a tag
            name = name.lower()
            if name == "br":
                self.parts.append(" ")
                continue
            block = name in BLOCKS
            if block:
                self.flush()
            if m["end"]:
                self.close_block(name) if block else self.close_inline(name)
            elif name in RAW:
                close = _RAW_END[name].search(page, at)
                at = close.end() if close else len(page)
            elif name in VOID:
                pass
            elif block:
                self.close_implied(name)
                self.open_block(name, m["attrs"])
            else:
                self.open_inline(name, m["attrs"])
        self.flush()
        return self.out


def blocks_of(page: str) -> Blocks:
    """The page's text blocks outside elements that HTML defines as no part of the text."""
    return _Scanner(page).run()


def _boxes_and_paths(b: Blocks) -> tuple[list[int], list[int]]:
    """Box and path id of each node.

    A ``div`` without block elements inside is a paragraph, not a box.  A box
    without a class has its own paths; boxes of one class share theirs.
    """
    box, path, ids = [0] * len(b.parent), [0] * len(b.parent), {}
    for e in range(1, len(b.parent)):
        up = b.parent[e]
        is_box = b.name[e] in BOXES and b.children[e] > 0
        box[e] = e if is_box else box[up]
        step = (path[up], b.name[e], b.named[e], e if is_box and not b.named[e] else -1)
        path[e] = ids.setdefault(step, len(ids) + 1)
    return box, path


def scores(b: Blocks) -> list[float]:
    """Weighted, smoothed and fused ratio of each block."""
    box_of, path_of = _boxes_and_paths(b)
    size, links, marks, count = Counter(), Counter(), Counter(), Counter()
    for i, text in enumerate(b.text):
        p = path_of[b.node[i]]
        size[p] += len(text)
        links[p] += b.links[i]
        marks[p] += len(_PUNCTUATION.findall(text))
        count[p] += 1
    own = {p: (size[p] - links[p]) / n * (1 + marks[p] / n) for p, n in count.items()}
    # the less of the page's text a path holds, the less it says; so with boxes below
    most = max(size.values(), default=1)
    own = {p: ratio * (1 + sqrt(size[p] / most)) / 2 for p, ratio in own.items()}
    # a box speaks by the best of its paths that hold a fair share of it
    held: dict[tuple[int, int], int] = Counter()
    whole: dict[int, int] = Counter()
    for i, text in enumerate(b.text):
        e = b.node[i]
        held[box_of[e], path_of[e]] += len(text)
        whole[box_of[e]] += len(text)
    near: dict[int, float] = {}
    for (x, p), n in held.items():
        if n >= SPEAKS * whole[x]:
            near[x] = max(near.get(x, 0.0), own[p])
    most = max(whole.values(), default=1)
    near = {x: ratio * sqrt(whole[x] / most) for x, ratio in near.items()}
    # an article is one text: it speaks by the best box in it; children come after parents
    inside = dict(near)
    for e in range(len(b.parent) - 1, 0, -1):
        if e in inside:
            up = box_of[b.parent[e]]
            inside[up] = max(inside.get(up, 0.0), inside[e])
            if b.name[e] == "article":
                near[e] = inside[e]
    # what the boxes around a box lend it; parents come before children
    around = [0.0] * len(b.parent)
    for e in range(1, len(b.parent)):
        if box_of[e] == e:
            up = box_of[b.parent[e]]
            around[e] = max(near.get(up, 0.0), FADES * around[up])
    out, heads = [0.0] * len(b.text), 0
    for i in range(len(b.text) - 1, -1, -1):
        e = b.node[i]
        x = box_of[e]
        heading = b.name[e] in HEADINGS
        heads = heads if heading and i + 1 < len(b.text) else x  # a heading belongs to what it heads
        p = path_of[e]
        fused = own[p] / 2 + max(near.get(heads, 0.0), near.get(x, 0.0)) / 4 + around[heads] / 4
        linked = not heading and 2 * links[p] >= size[p] and b.weight[i] < IN_ARTICLE  # an article's own lists of links stay
        out[i] = fused * b.weight[i] * (LINKED if linked else 1)
    return out


def extract(page: str, threshold: float = THRESHOLD) -> str:
    """Main text of one page: its content blocks in order, joined by a line feed."""
    b = blocks_of(page)
    score = scores(b)
    least = threshold * max(score, default=0.0)
    return "\n".join(text for text, s, w in zip(b.text, score, b.weight, strict=True) if s >= (least if w >= IN_FORM else max(least, FLOOR)))


def _text_batches(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            texts = [extract(page or "", threshold) for page in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*batch.schema.names[:-1], "text", "n_chars"],
            )

    return run


def main_text(
    pages: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    declared: Column | None = None,
) -> DataFrame:
    """``page_id, url[, declared], text, n_chars`` of every page, one row per input row.

    Null, empty and textless pages give an empty text; ids and urls may repeat or
    be null; an empty table gives an empty one; other columns are not read.
    ``declared``, a string column, is carried along.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    more = [] if declared is None else [declared.alias("declared")]
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), *more, F.col(html_col).alias("html"))
    schema = f"page_id {kind}, url string, {'declared string, ' if more else ''}text string, n_chars long"
    return rows.mapInArrow(_text_batches(threshold), schema)
