"""Main text of web pages: gradient-boosted trees over DOM nodes and a hierarchical decoding.

A page becomes a tree of its block elements with the text that stands directly in each, below one ``html`` and one ``body`` whether it
writes them or not. Every element with text
is described by its subtree (text and link density, counts), its tag and attribute words, its depth below the innermost element with all text
and its place among its siblings. Boosted trees give the chance that its text belongs to the article.

The trees learn on the driver from at most ``SAMPLE_PAGES`` pages, chosen by the hash of the id. Elements that say what they
are (``article``, ``nav``, ``class="ad"`` and the like) and what stands inside them are the labels. Every example comes again with tag and
attribute features blanked and some levels deeper, so that elements which say nothing are judged by their text and place, however they are wrapped.

Decoding takes the likeliest consistent choice for a whole page: an element is kept with all it holds, dropped with all it holds, or
opened, and only an opened one may hold both kinds. So nothing is kept inside a dropped element or dropped inside a kept one. Where that
leaves nothing, all text is kept that no element speaks against.

Null and empty pages give the empty text. Null ids and repeated rows are fine. Where no element says what it is, nothing can be learned, and all
text outside of scripts, styles, heads and form controls is kept. An empty table gives no rows. Pages are read whole, in
time linear in their length for the nesting depth of ``MOST_DEEP`` and less; deeper elements count to the one at that depth.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.boosting import BoostedTrees, fit
from rivulet.llm.registry import query, table

SAMPLE_PAGES = 1200
MOST_DEEP = 200
#: Levels at most that examples are moved down.
DEEPER = 4
#: Cost, in log chance, of opening an element.
OPENING = 0.5
#: Highest chance of an element that says it is something else and does not wrap the page.
AGAINST = 0.05

# Fixed word lists of HTML and of common attribute names.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp".split())
DROPPED = RAW | set("head svg math object button select canvas audio video map datalist".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
KEEP_TAGS, DROP_TAGS = {"article", "main"}, {"nav", "aside", "footer", "form", "header", "menu", "dialog"}
KEEP_WORDS = set("article articlebody content entry main post story text body".split())
DROP_WORDS = set(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer form header "
    "hidden legal login masthead menu modal nav navbar navigation newsletter notice pagination popup promo related replies respond "
    "search share sharing sidebar signup social sponsor sponsored subscribe toc toolbar widget".split()
)
HEADINGS, LISTS, CELLS = {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "li", "dl", "dt", "dd", "menu"}, {"table", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"}

_TAG = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
_NAMES = re.compile(r"""(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    words: set[str] = field(default_factory=set)
    children: list[int] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)
    chars: int = 0
    linked: int = 0
    tags: int = 1
    links: int = 0
    inputs: int = 0
    first_block: int = 0


@dataclass
class Page:
    nodes: list[Node]
    blocks: list[str]


def parse(source: str) -> Page:
    """Block elements in page order, each before its descendants, and the text blocks."""
    nodes = [Node("#", -1, 0), Node("html", 0, 1), Node("body", 1, 2)]
    nodes[0].children, nodes[1].children = [1], [2]
    stack = [(k, n.tag) for k, n in enumerate(nodes)]  # of elements: the node they stand for, tag
    closings: dict[str, list[int]] = {}
    blocks: list[str] = []
    gathered: list[str] = []
    linked = at = anchors = 0

    def end_block() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(gathered)).split()) if gathered else ""
        if text:
            node = nodes[stack[-1][0]]
            node.blocks.append(len(blocks))
            node.chars += len(text)
            node.linked += min(linked, len(text))
            blocks.append(text)
        gathered.clear()
        linked = 0

    def after_closing(tag: str) -> int | None:
        """Where the first closing tag from here on ends; the page is searched once per tag."""
        if tag not in closings:
            closings[tag] = [m.end() for m in re.finditer(rf"</{re.escape(tag)}\s*>", source, re.I)]
        # a closing tag is longer than its name, so the first end beyond that begins here or later
        k = bisect.bisect_left(closings[tag], at + len(tag) + 3)
        return closings[tag][k] if k < len(closings[tag]) else None

    def pop() -> None:
        nonlocal anchors
        anchors -= stack[-1][1] == "a"
        if stack[-1][1] in BLOCKS:
            end_block()
        stack.pop()

    while True:
        match = _TAG.search(source, at)
        text = source[at : match.start() if match else len(source)]
        if text:
            gathered.append(text)
            linked += len(text) if anchors else 0
        if not match:
            break
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if tag in ("html", "body"):
            nodes[1 if tag == "html" else 2].words |= _attribute_words(match[3]) if not match[1] else set()
            continue
        if match[1]:
            depth = next((k for k in range(len(stack) - 1, 2, -1) if stack[k][1] == tag), 0)
            while depth and len(stack) > depth:
                pop()
            continue
        if tag in DROPPED and tag not in ("object", "map"):
            nodes[stack[-1][0]].inputs += tag in ("button", "select", "textarea")
            closed = after_closing(tag) if not match[3].endswith("/") else None
            at = closed if closed is not None else at if tag not in RAW or match[3].endswith("/") else len(source)
            continue
        if tag == "br":
            gathered.append(" ")
        nodes[stack[-1][0]].tags += 1
        if tag in VOID and tag != "hr":
            nodes[stack[-1][0]].inputs += tag == "input"
            continue
        if tag in BLOCKS:
            while any(t == "p" for _, t in stack[-8:]) and stack[-1][1] not in BLOCKS - {"p"}:
                pop()
            while tag in CLOSES and len(stack) > 3 and any(t in CLOSES[tag] for _, t in _until(stack, STOPS[tag])):
                pop()
            end_block()
            if tag == "hr":
                continue
            if len(stack) > MOST_DEEP:
                stack.append((stack[-1][0], tag))
                continue
            parent = stack[-1][0]
            nodes.append(Node(tag, parent, nodes[parent].depth + 1, _attribute_words(match[3]), first_block=len(blocks)))
            nodes[parent].children.append(len(nodes) - 1)
            stack.append((len(nodes) - 1, tag))
        else:
            anchors += tag == "a"
            nodes[stack[-1][0]].links += tag == "a"
            if len(stack) <= 2 * MOST_DEEP:
                stack.append((stack[-1][0], tag))
            else:
                anchors -= tag == "a"
    while len(stack) > 3:
        pop()
    end_block()
    return Page(nodes, blocks)


def _attribute_words(attributes: str) -> set[str]:
    return set(_WORD.findall(" ".join(x for m in _NAMES.findall(attributes) for x in m if x).lower())) if attributes else set()


def _until(stack: list[tuple[int, str]], stops: set[str]) -> Iterator[tuple[int, str]]:
    for item in reversed(stack):
        if item[1] in stops:
            return
        yield item


@dataclass
class Names:
    """What the elements of a page say they are by tag and attributes, one entry per node."""

    speaks_for: list[bool]
    against: list[bool]
    alone: list[bool]


def names_of(page: Page) -> Names:
    """``speaks_for``: is the article; ``against``: is something else; ``alone``: what stands above does not count.

    A listed word on an element that wraps the page says nothing about its text: that of ``html`` and ``body``, and of an element
    with most of the page's text, unless an article stands free elsewhere. An article below a named element is taken at its own word
    if no free one has more text, and ``main`` always.
    """
    nodes, count = page.nodes, range(len(page.nodes))
    chars = [n.chars for n in nodes]
    for k in reversed(count[1:]):
        chars[nodes[k].parent] += chars[k]
    strong = [n.tag in KEEP_TAGS or "articlebody" in n.words for n in nodes]
    listed = [bool(n.tag in DROP_TAGS or n.words & DROP_WORDS) and n.tag not in ("html", "body") for n in nodes]
    # articles with no named element above, and how many of them stand above or inside each element
    below, above, inside = [False] * len(nodes), [0] * len(nodes), [0] * len(nodes)
    free = [False] * len(nodes)
    for k in count[1:]:
        up = nodes[k].parent
        below[k] = below[up] or listed[up]
        free[k] = strong[k] and not below[k] and not (listed[k] and nodes[k].tag != "main") and chars[k] > 0
        above[k] = above[up] + free[k]
    for k in reversed(count):
        inside[k] += free[k]
        if k:
            inside[nodes[k].parent] += inside[k]
    longest = max((chars[k] for k in count if free[k]), default=0)
    wraps = [2 * chars[k] > chars[0] and inside[0] == inside[k] + above[k] - free[k] for k in count]
    against = [listed[k] and not wraps[k] and nodes[k].tag != "main" for k in count]
    alone = [strong[k] and not against[k] and (nodes[k].tag == "main" or chars[k] >= longest) for k in count]
    return Names(strong, against, alone)


#: The last features tell of tags and attributes; these columns among them speak for the article.
NAMED, GOOD_NAMES = 9, (-5, -3, -1)


def features(page: Page) -> np.ndarray:
    """One row per node; subtree sums go up in one pass as children follow their parents."""
    nodes = page.nodes
    chars, linked, tags, links, inputs, blocks = (
        np.array(v, float) for v in zip(*[(n.chars, n.linked, n.tags, n.links, n.inputs, len(n.blocks)) for n in nodes])
    )
    own = chars.copy()
    marks, words = np.zeros(len(nodes)), np.zeros(len(nodes))
    for k, n in enumerate(nodes):
        for b in n.blocks:
            text = page.blocks[b]
            marks[k] += text.count(".") + text.count(",")
            words[k] += text.count(" ") + 1
    for k in range(len(nodes) - 1, 0, -1):
        up = nodes[k].parent
        for sums in (chars, linked, tags, links, inputs, blocks, marks, words):
            sums[up] += sums[k]
    # wrappers that hold all text do not count as depth
    base = 0
    while not own[base] and len(only := [c for c in nodes[base].children if chars[c]]) == 1:
        base = only[0]
    rows = []
    names = names_of(page)
    state: list[tuple[int, int]] = []
    for k, n in enumerate(nodes):
        siblings = nodes[n.parent].children if n.parent >= 0 else [0]
        up = max(n.parent, 0)
        same = sum(nodes[s].tag == n.tag for s in siblings) if len(siblings) < 64 else len(siblings)
        above = state[n.parent] if n.parent >= 0 else (0, 0)
        good = int(n.tag in KEEP_TAGS or bool(n.words & KEEP_WORDS))
        bad = int(names.against[k])
        if names.alone[k]:
            above = (above[0], 0)
        state.append((max(above[0], good), max(above[1], bad)))
        size = max(chars[k], 1.0)
        rows.append(
            (
                max(n.depth - nodes[base].depth, 0),
                np.log1p(chars[k]),
                linked[k] / size,
                chars[k] / tags[k],
                blocks[k],
                own[k] / size,
                links[k] / tags[k],
                inputs[k],
                marks[k] / size,
                words[k] / size,
                chars[k] / max(chars[up], 1.0),
                chars[k] / max(chars[0], 1.0),
                len(siblings),
                same / len(siblings),
                (k - siblings[0]) / max(siblings[-1] - siblings[0], 1),
                n.first_block / max(len(page.blocks), 1),
                n.tag in HEADINGS,
                n.tag == "p",
                n.tag in LISTS,
                n.tag in CELLS,
                good,
                bad,
                above[0],
                above[1],
                n.tag == "header" and above[0],
            )
        )
    return np.array(rows, float)


def weak_labels(page: Page, mixed: bool = False) -> np.ndarray:
    """1 for nodes that say they are the article or stand in one, 0 for the opposite, -1 unknown; without ``mixed`` also -1 if both are inside.

    The nearest element that says something decides; a header inside an article does not speak, nor does a form for what it holds.
    """
    names = names_of(page)
    said = np.full(len(page.nodes), -1)
    for k, n in enumerate(page.nodes[1:], 1):
        above = said[n.parent]
        if names.against[k] and not (n.tag == "header" and above == 1):
            said[k] = 0
        elif names.speaks_for[k] and (above != 0 or names.alone[k]):
            said[k] = 1
        else:
            # a form may hold anything
            said[k] = -1 if above == 0 and page.nodes[n.parent].tag == "form" else above
    if mixed:
        return said
    out, text = said.copy(), [bool(n.blocks) for n in page.nodes]
    for k in range(len(page.nodes) - 1, 0, -1):
        up = page.nodes[k].parent
        if text[k]:
            text[up] = True
            if out[k] != said[up] or out[k] == -1:
                out[up] = -1
    return np.where(text, out, -1)


def decode(page: Page, chance: np.ndarray) -> list[int]:
    """The blocks that are kept under the likeliest consistent choice."""
    nodes = page.nodes
    yes, no = np.log(np.clip(chance, 0.01, 0.99)), np.log(1 - np.clip(chance, 0.01, 0.99))
    own = np.array([bool(n.blocks) for n in nodes])
    holds = own.copy()
    keep, drop, opened = np.zeros(len(nodes)), np.zeros(len(nodes)), np.zeros(len(nodes))
    for k in range(len(nodes) - 1, -1, -1):
        if holds[k]:
            keep[k] += yes[k]
            drop[k] += no[k]
            opened[k] += (max(yes[k], no[k]) if own[k] else 0) - OPENING
            if k:
                up = nodes[k].parent
                holds[up] = True
                keep[up] += keep[k]
                drop[up] += drop[k]
                opened[up] += max(keep[k], drop[k], opened[k])
    # the page itself is always open
    choice = {0: "open"}
    kept: list[int] = list(nodes[0].blocks) if own[0] and chance[0] >= 0.5 else []
    for k in range(1, len(nodes)):
        above = choice[nodes[k].parent]
        if above == "open" and holds[k]:
            best = max(keep[k], drop[k], opened[k])
            choice[k] = "keep" if best == keep[k] else "drop" if best == drop[k] else "open"
        else:
            choice[k] = above
        if choice[k] == "keep" or choice[k] == "open" and chance[k] >= 0.5:
            kept += nodes[k].blocks
    return sorted(kept)


def fit_nodes(sources: list[str], seed: int = 0) -> BoostedTrees | None:
    """Boosted trees from the elements of these pages that say what they are."""
    xs, ys = [], []
    for source in sources:
        page = parse(source)
        labels = weak_labels(page)
        if (labels >= 0).any():
            xs.append(features(page)[labels >= 0])
            ys.append(labels[labels >= 0])
    if not xs or len(np.unique(np.concatenate(ys))) < 2:
        return None
    x, y = np.concatenate(xs), np.concatenate(ys).astype(float)
    # the same examples without any name, and without those that speak for the article
    blank, unpraised = x.copy(), x.copy()
    blank[:, -NAMED:] = 0
    unpraised[:, GOOD_NAMES] = 0
    deeper = np.random.default_rng(seed)
    for copy in (blank, unpraised):
        copy[:, 0] += deeper.integers(0, DEEPER + 1, len(copy))
    return fit(np.concatenate((x, blank, unpraised)), np.concatenate((y, y, y)))


def main_text(model: BoostedTrees | None, source: str | None) -> str:
    return main_texts(model, [source])[0]


def main_texts(model: BoostedTrees | None, sources: list[str | None]) -> list[str]:
    pages = [parse(s) if isinstance(s, str) else None for s in sources]
    if model is None:
        return ["\n".join(p.blocks) if p else "" for p in pages]
    full = [p for p in pages if p and p.blocks]
    if not full:
        return [""] * len(pages)
    described = [features(p) for p in full]
    chances = np.split(model.probability(np.concatenate(described)), np.cumsum([len(d) for d in described])[:-1])
    texts = iter(["\n".join(_kept_blocks(p, c)) for p, c in zip(full, chances)])
    return [next(texts) if p and p.blocks else "" for p in pages]


def _kept_blocks(page: Page, chance: np.ndarray) -> list[str]:
    # an element that says it is no part of the article is taken at its word, unless it wraps the page
    against = weak_labels(page, mixed=True) == 0
    kept = decode(page, np.where(against, np.minimum(chance, AGAINST), chance))
    return [page.blocks[b] for b in kept or sorted(b for n, no in zip(page.nodes, against) if not no for b in n.blocks)]


def with_main_text(pages: DataFrame, model: BoostedTrees | None, name: str = "text", at_once: int = 64) -> DataFrame:
    """``pages`` with the main text of ``html``."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def extract(sources: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in sources:
            rows = batch.tolist()
            yield pd.Series([t for at in range(0, len(rows), at_once) for t in main_texts(shared.value, rows[at : at + at_once])], dtype="object")

    return pages.withColumn(name, extract("html"))


def extract_main_text(pages: DataFrame, sample: int = SAMPLE_PAGES) -> DataFrame:
    """``pages`` with ``text``; the model is learned from at most ``sample`` of their rows."""
    # about twice the sample by hash first, so that the choice of the exact number sees few rows of each task
    share = min(1.0, 2 * sample / max(1, pages.count()))
    draw = F.xxhash64("page_id", F.lit("pages"))
    few = pages.filter(F.col("html").isNotNull() & (F.pmod(draw, F.lit(1 << 30)) < int(share * (1 << 30))))
    drawn = few.select("html", draw.alias("draw"), F.xxhash64("html").alias("tie")).orderBy("draw", "tie").limit(sample)
    return with_main_text(pages, fit_nodes([r["html"] for r in drawn.collect()]))


@query("op2_main_text")
def main_text_of_pages(spark, sf_dir):
    pages = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
