"""Main text of web pages by a minimum cut over text blocks.

A page is read into text blocks with the elements around them.  A linear
classifier gives each block its log odds of being content; these become the
capacities to the two terminals.  Blocks that follow each other and blocks with
the same parent element are tied by smoothness edges.  The minimum cut, found by
maximum flow, labels all blocks of the page at once.

The content of script, style, title, textarea and the like is no markup: it ends
at their own closing tag, or with the page, whatever stands in between.  A page is
read in one pass with counted elements, so the time follows its length.

Defined cases: a null or empty page gives an empty text; a tag cut off at the
end of the page is dropped; a page without any content block gives an empty
text; repeated rows are read one by one; an empty table gives an empty result;
only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import small_batches

# A quote opens a value only right after an equals sign; nothing is tried twice, so reading takes one pass.
_PART = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|</(?![A-Za-z])[^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?P<end>>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.DOTALL,
)
_ATTR = re.compile(r"([A-Za-z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Elements whose content is no text of the page.
SKIPPED = set("script style template svg math iframe object canvas noscript title".split())
# Elements whose content is read without tags and comments, except inside svg and math.
RAW = set("script style title textarea xmp iframe noembed noframes".split())
FOREIGN = ("svg", "math")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}
_IN_SCRIPT = re.compile(r"<!--(?!-?>)|-->|<(?P<close>/?)script(?=[\s/>])", re.IGNORECASE)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Elements that end one block and begin another.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody textarea tfoot thead tr ul button label".split()
)
SPACED = set("br td th".split())
# An opening tag ends these open elements of its own kind.
CLOSED_BY = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"},
}

# Log odds that an element around a block adds.
AROUND = {
    "article": 4.0, "main": 3.0, "nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "header": -6.0,
    "menu": -9.0, "dialog": -9.0, "select": -9.0, "button": -9.0, "textarea": -9.0, "label": -3.0,
}
ROLES = {
    "main": 3.0, "article": 4.0, "navigation": -9.0, "banner": -6.0, "contentinfo": -9.0, "search": -9.0,
    "complementary": -9.0, "dialog": -9.0, "alert": -9.0, "alertdialog": -9.0, "menu": -9.0, "menubar": -9.0,
    "form": -9.0, "toolbar": -9.0,
}
# Words in class and id.
GOOD = set("article content entry post story main body text prose".split())
BAD = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent "
    "gdpr newsletter subscribe subscription share sharing social sidebar related recommended recommendations "
    "breadcrumb breadcrumbs menu nav navbar navigation comment comments reply replies disqus respond login signup "
    "signin register search pagination pager popup modal overlay banner notice notices alert warning disclaimer "
    "copyright skip widget hidden toolbar trending popular".split()
)
WEAK = set("header footer masthead meta tags byline caption legal top bottom".split())
CONTAINERS = ("article", "main", "section", "div", "body")

FOLLOWS, SIBLINGS = 0.5, 0.7


class Block:
    """Text of one block, its link text, and what stands around it."""

    __slots__ = ("pieces", "linked", "odds", "parent", "tag")

    def __init__(self, odds: float, parent: int, tag: str):
        self.pieces, self.linked, self.odds, self.parent, self.tag = [], 0, odds, parent, tag


def _element_odds(tag: str, attrs: str, inside_article: bool) -> float:
    """Log odds that an element adds to the blocks inside it."""
    odds = AROUND.get(tag, 0.0)
    if tag == "header" and inside_article:
        odds = -0.5
    if not attrs or attrs.isspace():
        return odds
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), a or b or c
        if name == "role":
            odds += ROLES.get(value.strip().lower(), 0.0)
        elif name in ("class", "id"):
            words = {w.lower() for w in _NAME.findall(value)}
            if words & BAD:
                odds -= 9.0
            elif words & GOOD:
                odds += 1.5
            elif words & WEAK:
                odds -= 4.0
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            odds -= 9.0
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            odds -= 9.0
        elif name == "itemprop" and value == "articleBody":
            odds += 3.0
    return odds


def _raw_end(html: str, tag: str, start: int) -> int:
    """Where the closing tag of a raw element begins, the end of the page if there is none."""
    if tag != "script":
        found = _RAW_END[tag].search(html, start)
        return found.start() if found else len(html)
    # Inside a comment of a script, a second opening tag takes the next closing tag.
    comment = nested = False
    for part in _IN_SCRIPT.finditer(html, start):
        if part["close"] is None:
            comment, nested = part[0] == "<!--", False
        elif not part["close"]:
            nested = comment
        elif nested:
            nested = False
        else:
            return part.start()
    return len(html)


class _Open(NamedTuple):
    """An open element and what its text needs to know of the elements around it."""

    tag: str
    odds: float  # of all elements so far
    in_article: bool
    container: int  # number of the innermost container
    block: int  # place in the stack of the innermost block element
    block_tag: str


class _Stack:
    """Open elements, with counts, so that no step looks through all of them."""

    def __init__(self):
        self.open, self.count, self.n = [_Open("", 0.0, False, 0, 0, "")], Counter(), 0

    def push(self, tag: str, attrs: str) -> None:
        self.n += 1
        top = self.open[-1]
        odds = max(-30.0, min(8.0, top.odds + _element_odds(tag, attrs, top.in_article)))
        container = self.n if tag in CONTAINERS else top.container
        block, block_tag = (len(self.open), tag) if tag in BLOCKS else (top.block, top.block_tag)
        self.open.append(_Open(tag, odds, top.in_article or tag in ("article", "main"), container, block, block_tag))
        self.count[tag] += 1

    def cut(self, size: int) -> None:
        while len(self.open) > size:
            self.count[self.open.pop().tag] -= 1

    def close(self, tag: str) -> None:
        """End the innermost element of this kind and all in it, if there is one."""
        if self.count[tag]:
            while self.open[-1].tag != tag:
                self.cut(len(self.open) - 1)
            self.cut(len(self.open) - 1)


def blocks_of(html: str) -> list[Block]:
    """The text blocks of a page in order, in one pass over it."""
    blocks: list[Block] = []
    stack = _Stack()
    block, skip, at, raw_end = None, "", 0, -1
    while at < len(html):
        if raw_end > at:
            tag, text, at = None, html[at:raw_end], raw_end
        else:
            part = _PART.match(html, at)
            tag, text, at = part["tag"], part["text"], part.end()
        if tag is None:
            if text and not skip:
                if block is None:
                    top = stack.open[-1]
                    block = Block(top.odds, top.container, top.block_tag)
                    blocks.append(block)
                block.pieces.append(text)
                if stack.count["a"]:
                    block.linked += len(text.strip())
            continue
        tag = tag.lower()
        if not part["end"]:
            break  # cut off
        if tag in RAW and not part["close"] and skip not in FOREIGN and not part["attrs"].endswith("/"):
            raw_end = _raw_end(html, tag, at)
        if skip:
            if part["close"] and tag == skip:
                skip = ""
            continue
        if tag in SPACED and block is not None:
            block.pieces.append(" ")
        if part["close"]:
            if tag in BLOCKS:
                block = None
            stack.close(tag)
            continue
        if tag in SKIPPED:
            skip = "" if part["attrs"].endswith("/") else tag
            continue
        if tag in BLOCKS:
            block = None
        if tag in VOID:
            continue
        top = stack.open[-1]
        if tag in CLOSED_BY and top.block_tag in CLOSED_BY[tag]:
            stack.cut(top.block)
        stack.push(tag, part["attrs"])
    return blocks


def block_odds(block: Block, text: str) -> float:
    """The classifier: log odds that a block is content."""
    linked = min(1.0, block.linked / max(1, len(text)))
    odds = block.odds - 1.5 + min(len(text), 400) / 100 - 4.0 * linked
    if block.tag in ("p", "blockquote", "pre"):
        odds += 0.7
    elif block.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        odds += 1.0
    if text[-1:] in ".!?…":
        odds += 0.5
    return odds


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source: minimises cut odds plus cut edges.

    Maximum flow by blocking flows: each phase numbers the nodes by their distance
    from the source and saturates all paths that lead one level on with each step.
    A node has either room from the source (positive odds) or to the sink
    (negative), so only paths along smoothness edges are left to search.
    """
    tiny, n = 1e-9, len(odds)
    out: list[list[int]] = [[] for _ in odds]  # numbers of the edges of a node; e ^ 1 is the way back
    to, room, left = [], [], list(odds)
    for a, b, weight in edges:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to += [b, a]
        room += [weight, weight]
    while True:
        queue = [i for i in range(n) if left[i] > tiny]
        level = [-1] * n
        for i in queue:
            level[i] = 0
        for i in queue:  # grows while it is read
            for e in out[i]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not any(level[i] >= 0 and left[i] < -tiny for i in range(n)):
            return [at >= 0 for at in level]
        arc = [0] * n
        for source in queue:
            path, i = [], source
            while left[source] > tiny and level[source] == 0:
                if left[i] < -tiny:
                    flow = min([left[source], -left[i], *[room[e] for e in path]])
                    left[source] -= flow
                    left[i] += flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    # Go on from the first edge that is full.
                    full = next((k for k, e in enumerate(path) if room[e] <= tiny), len(path))
                    if full < len(path):
                        i = to[path[full] ^ 1]
                        del path[full:]
                    continue
                while arc[i] < len(out[i]):
                    e = out[i][arc[i]]
                    if room[e] > tiny and level[to[e]] == level[i] + 1:
                        break
                    arc[i] += 1
                if arc[i] < len(out[i]):
                    path.append(out[i][arc[i]])
                    i = to[path[-1]]
                elif path:
                    i = to[path.pop() ^ 1]
                    arc[i] += 1
                else:
                    break


def label_blocks(html: str | None) -> list[tuple[str, bool]]:
    """Text of each block, with one space for white space, and whether it is content."""
    found = [(b, " ".join(unescape("".join(b.pieces)).split())) for b in blocks_of(html or "")]
    found = [(b, text) for b, text in found if text]
    odds = [block_odds(b, text) for b, text in found]
    edges = [(i, i + 1, FOLLOWS) for i in range(len(found) - 1)]
    last: dict[int, int] = {}
    for i, (b, _) in enumerate(found):
        if b.parent in last:
            edges.append((last[b.parent], i, SIBLINGS))
        last[b.parent] = i
    return [(text, kept) for (_, text), kept in zip(found, minimum_cut(odds, edges))]


def main_text(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """``keys``, text, n_chars, n_blocks, n_kept for each row."""
    small_batches(pages.sparkSession)
    rows = pages.select(*keys, F.col(f"`{html}`").cast("string").alias("_html"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[: len(keys)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_blocks, n_kept = [], [], []
            for html in batch.column(len(keys)):
                labelled = label_blocks(html.as_py())
                kept = [text for text, good in labelled if good]
                texts.append("\n".join(kept))
                n_blocks.append(len(labelled))
                n_kept.append(len(kept))
            columns = [batch.column(i) for i in range(len(keys))]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            columns += [pa.array(n_blocks, pa.int64()), pa.array(n_kept, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "text", "n_chars", "n_blocks", "n_kept"])

    return rows.mapInArrow(run, f"{kinds}, text string, n_chars bigint, n_blocks bigint, n_kept bigint")


def query(spark: SparkSession, sf: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf}/pages.parquet"))
