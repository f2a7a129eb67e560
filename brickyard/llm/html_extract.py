"""Main text of HTML pages by tag-path ratios.

A page becomes a sequence of text blocks, each with the path of block-level
tags from the root to it.  Blocks inside elements whose tag or role is never
article text (navigation, scripts, page headers and footers) are set aside.  The
words of class and id decide nothing: an element that is a form, or a class of
which says nothing but advert, notice, comments and the like, is in strong doubt
(``!`` on its path), one with such a word among others in weak doubt (``?``), and
doubt lowers the score of a path.  Strong doubt is lifted from an element that
has most of the page's text in an article, or beside which there is hardly any.
For each path the blocks give

* the text ratio: characters per block, and
* the punctuation ratio: punctuation marks per block,

both without link text.  The ratios are laid along the page, smoothed with a
Gaussian, fused as a product, lowered by doubt, and compared with the page's own
threshold; the paths that pass are content paths.  The element that holds most of their text
(an ``article`` or ``main`` where one does, told by its number and not by its
tag) is the content root, several outermost ones together where none does.  Its
blocks are the text, short ones such as headings and list items included, save
those in strong doubt on other paths, and inner articles, sections with such
articles, and sections of links, where less than half of the text is on content
paths.

Embedded content (media, drawings, choices, templates) is no text; where its end
tag is missing, what follows it is.  Formulas are text.

Defined results: null, empty or text-less pages give ""; cut-off tags,
comments and references are read as far as they go; repeated rows are handled
one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brickyard.llm import textkit as K

#: Width of the smoothing in blocks, and the threshold as a part of the page's mean fused ratio.
SIGMA, THRESHOLD = 1.0, 0.35
#: What doubt leaves of a path's score; text outside an element, as a part of the text in it, that leaves it in strong doubt.
WEAK, STRONG, OUTSIDE = 0.6, 0.02, 0.25
#: An element that holds this part of the content is a candidate for the root.
SHARE = 0.8

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？؟।]")

#: Their content is no markup: it runs to the first end tag, or to the page's end.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: Their content is markup but no text; one without an end tag inside its parent holds nothing.
EMBEDDED = frozenset("noscript template svg object select canvas audio video annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var
math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup msubsup munder mover munderover mmultiscripts
mprescripts none mtable mtr mtd maction""".split())
NEVER = frozenset("nav footer aside button menu dialog fieldset head datalist option optgroup".split()) | RAW | EMBEDDED
OPTIONS = frozenset(("option", "optgroup"))
ROOTS = frozenset(("article", "main"))
SECTIONS = frozenset(("article", "section"))
KEPT = ROOTS | {"html", "body"}
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NOISE = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner
nav navbar navigation menu breadcrumb breadcrumbs toolbar pager pagination skip masthead footer sidebar rail widget widgets
related recommended recommendations share sharing social comment comments disqus respond replies reply cookie cookies consent gdpr
notice notices notification alert popup popover modal overlay newsletter subscribe subscription signup login register paywall disclaimer copyright hidden""".split())
#: Words that leave a class as telling as the noise word beside them.
BESIDE = frozenset("""area article bar blog block bottom box button buttons container entry footer form header icon icons inner item items
left link links list main page panel post posts reader right section site slot top unit user""".split())
#: What each opening tag closes when it is still open.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",)}
#: Elements that such closing doesn't look beyond.
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",)}


def _doubt(tag: str, rest: str, inside_root: bool) -> str:
    """``x``: never text; ``!`` and ``?``: strong and weak doubt; empty: none."""
    if tag in NEVER or tag == "header" and not inside_root:
        return "x"
    doubt = "!" if tag == "form" else ""
    if not rest or tag in KEPT:
        return doubt
    for name, a, b, c in ATTRIBUTE.findall(rest):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            for one in value.split():
                words = {w.lower() for w in WORD.findall(one)}
                telling = words & NOISE or "header" in words and not inside_root and tag in ("div", "section", "table")
                if telling:
                    doubt = "!" if doubt == "!" or words <= NOISE | BESIDE else "?"
        elif name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "x"
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "x"
    return doubt


class Block:
    __slots__ = ("links", "owners", "path", "text")

    def __init__(self, path: tuple, owners: tuple, text: str, links: int):
        self.path, self.owners, self.text, self.links = path, owners, text, links


def _raw_end(page: str, tag: str, at: int) -> int:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I).search(page, at).end()


def embedded_ends(page: str) -> dict[int, int]:
    """Where each embedded element that ends inside its parent ends, by the place of its start tag."""
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    count: dict[str, int] = defaultdict(int)
    at = 0
    while m := TAG.search(page, at):
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if not count[tag]:
                continue
            if tag in INLINE:  # such an end tag closes no block
                i = len(stack) - 1
                while stack[i][0] != tag and stack[i][0] in INLINE:
                    i -= 1
                if stack[i][0] != tag:
                    continue
            while True:
                name, start = stack.pop()
                count[name] -= 1
                if name == tag:
                    break
            if tag in EMBEDDED:
                ends[start] = at
        elif tag in VOID or tag in RAW | EMBEDDED and m[3].rstrip().endswith("/"):
            continue
        elif tag in RAW:
            at = _raw_end(page, tag, at)
        else:
            stack.append((tag, m.start()))
            count[tag] += 1
    return ends


def text_blocks(page: str) -> list[Block]:
    """The page's blocks outside elements that are never article text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int, str]] = []  # tag, noise, number of the element, doubt
    kept: list[str] = []
    noise = links = linked = roots = number = 0
    ends: dict[int, int] | None = None  # found when one is met

    def flush() -> None:
        nonlocal linked
        if kept:
            text = " ".join(html.unescape("".join(kept)).split())
            if text:
                own = [x for x in stack if x[0] not in INLINE]
                out.append(Block(tuple(x[0] + x[3] for x in own), tuple(x[2] for x in own), text, linked))
            kept.clear()
        linked = 0

    def pop() -> None:
        nonlocal noise, links, roots
        tag, bad, *_ = stack.pop()
        noise -= bad
        links -= tag == "a"
        roots -= tag in ROOTS

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        # a "<" that opens nothing is text
        stop = m.start() if m else size
        if stop > at and not noise:
            piece = page[at:stop]
            kept.append(piece)
            if links:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith("<![CDATA[") and not noise:
                kept.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if m[1]:
            if tag in INLINE:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        while len(stack) > i:
                            pop()
                        break
                    if stack[i][0] not in INLINE:
                        break
            else:
                if any(x[0] == tag for x in stack):
                    flush()
                    while stack:
                        last = stack[-1][0]
                        pop()
                        if last == tag:
                            break
                elif tag == "p":
                    flush()
            continue
        if tag in VOID:
            if tag == "br" and not noise:
                kept.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in RAW:
            if m[3].rstrip().endswith("/"):
                continue
            at = _raw_end(page, tag, at)
            continue
        if tag in EMBEDDED:
            if ends is None:
                ends = embedded_ends(page)
            at = ends.get(m.start(), at)
            continue
        while tag not in INLINE and tag != "optgroup" and stack and (stack[-1][0] == "option" or stack[-1][0] in OPTIONS and tag not in OPTIONS):
            pop()
        if tag not in INLINE:
            flush()
            # an open paragraph ends where a block begins
            for closed, scope in (((("p",), ()),) if any(x[0] == "p" for x in stack) else ()) + (((CLOSES[tag], SCOPE.get(tag, ("table",))),) if tag in CLOSES else ()):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in closed:
                        while len(stack) > i:
                            pop()
                        if closed == ("p",):
                            break
                    elif stack[i][0] in scope or closed == ("p",) and stack[i][0] not in INLINE:
                        break
        doubt = _doubt(tag, m[3], roots > 0)
        # an inline element is no block: strong doubt drops it
        bad = doubt == "x" or doubt == "!" and tag in INLINE
        number += 1
        if bad and not noise and tag not in INLINE:
            flush()
        stack.append((tag, bad, number, "" if bad or tag in INLINE else doubt))
        noise += bad
        links += tag == "a"
        roots += tag in ROOTS
    flush()
    return out


def path_ratios(blocks: list[Block]) -> dict[tuple, tuple[float, float]]:
    """Text and punctuation ratio of every path, without link text."""
    sums: dict[tuple, list[float]] = defaultdict(lambda: [0, 0, 0])
    for b in blocks:
        own = sums[b.path]
        free = max(0, len(b.text) - b.links)
        own[0] += free
        own[1] += len(PUNCTUATION.findall(b.text)) * free / len(b.text)
        own[2] += 1
    return {path: (a / n, p / n) for path, (a, p, n) in sums.items()}


def smooth(values: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, math.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel, "full")[reach:-reach]
    return np.convolve(values, kernel, "full")[reach:-reach] / weight


def _trust(path: tuple) -> float:
    """What doubt leaves of a path's score; strong doubt counts for each element, weak doubt once."""
    strong = sum(t[-1] == "!" for t in path)
    return STRONG ** strong * (WEAK if any(t[-1] == "?" for t in path) else 1.0)


def lift_doubt(blocks: list[Block]) -> None:
    """Turn strong doubt into none where an element holds the page's text after all."""
    doubted = any(t[-1] == "!" for b in blocks for t in b.path)
    while doubted:
        doubted = False
        held: dict[int, list[int]] = defaultdict(lambda: [0, 0])  # free text of an element in strong doubt, and of articles in it
        free, whole = 0, 0
        for b in blocks:
            size = max(0, len(b.text) - b.links)
            marked = [i for i, t in enumerate(b.path) if t[-1] == "!"]
            inner = max((i for i, t in enumerate(b.path) if t in ROOTS), default=-1)
            whole += size
            free += 0 if marked else size
            for i in marked:
                held[b.owners[i]][0] += size
                held[b.owners[i]][1] += size * (i < inner)
        lifted = {n for n, (size, inside) in held.items() if 2 * inside >= size > 0 and 2 * size >= whole or size and free <= OUTSIDE * size and 2 * size >= whole}
        if lifted:
            # the outermost first: what is in doubt inside it is judged again
            first = min(lifted)
            for b in blocks:
                if first in b.owners:
                    i = b.owners.index(first)
                    b.path = (*b.path[:i], b.path[i][:-1], *b.path[i + 1:])
            doubted = len(held) > 1


def content_mask(blocks: list[Block]) -> list[bool]:
    """Blocks on content paths: fused smoothed ratios against the page's threshold."""
    ratios = path_ratios(blocks)
    text = smooth(np.array([ratios[b.path][0] for b in blocks]), SIGMA)
    marks = smooth(np.array([ratios[b.path][1] for b in blocks]), SIGMA)
    fused = np.sqrt(text * (marks + 0.1)) * [_trust(b.path) for b in blocks]
    sums: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0])
    for b, x in zip(blocks, fused, strict=True):
        sums[b.path][0] += x
        sums[b.path][1] += 1
    limit = THRESHOLD * float(np.average(fused, weights=[len(b.text) for b in blocks]))
    passed = {path for path, (x, n) in sums.items() if x / n >= limit}
    return [b.path in passed and 2 * b.links <= len(b.text) for b in blocks]


def content_roots(chosen: list[Block]) -> set[int]:
    """Numbers of the articles or mains that hold the chosen text: the innermost one with ``SHARE`` of it, else all outermost ones."""
    held: dict[int, int] = defaultdict(int)
    outer: set[int] = set()
    for b in chosen:
        own = [n for t, n in zip(b.path, b.owners, strict=True) if t in ROOTS]
        outer.update(own[:1])
        for n in own:
            held[n] += len(b.text)
    whole = sum(held[n] for n in outer)
    # elements that hold so much lie in each other, and are numbered as they open
    most = [n for n, x in held.items() if x >= SHARE * whole]
    return {max(most)} if most else outer


def set_aside(rooted: list[Block], chosen: set[int], roots: set[int]) -> set[int]:
    """Numbers of the articles and sections inside the roots that are teasers or link lists.

    Such a section holds an article, or links for the most part, and less than
    half of its text is on content paths.
    """
    sums: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0])
    cards: set[int] = set()
    for b in rooted:
        at = next(i for i, n in enumerate(b.owners) if n in roots) + 1
        own = [(t, n) for t, n in zip(b.path[at:], b.owners[at:], strict=True) if t in SECTIONS]
        last = max((i for i, (t, _) in enumerate(own) if t == "article"), default=-1)
        cards.update(n for _, n in own[:last + 1])
        for _, n in own:
            x = sums[n]
            x[0] += len(b.text)
            x[1] += len(b.text) * (id(b) in chosen)
            x[2] += b.links
    return {n for n, (size, good, links) in sums.items() if 2 * good < size and (n in cards or 2 * links > size)}


def _strong(block: Block) -> bool:
    return any(t[-1] == "!" for t in block.path)


def main_text(page: str) -> str:
    """Article text of a page: blocks joined by an empty line."""
    blocks = text_blocks(page)
    if not blocks:
        return ""
    lift_doubt(blocks)
    chosen = [b for b, good in zip(blocks, content_mask(blocks), strict=True) if good] or blocks
    whole, paths = sum(len(b.text) for b in chosen), {b.path for b in chosen}
    if 2 * sum(len(b.text) for b in chosen if any(t in ROOTS for t in b.path)) >= whole:
        roots = content_roots(chosen)
        rooted = [b for b in blocks if roots.intersection(b.owners)]
        aside = set_aside(rooted, set(map(id, chosen)), roots)
        return "\n\n".join(b.text for b in rooted if not aside.intersection(b.owners) and (b.path in paths or not _strong(b)))
    held: dict[int, int] = defaultdict(int)
    depth: dict[int, int] = {}
    for b in chosen:
        for i, number in enumerate(b.owners):
            held[number] += len(b.text)
            depth[number] = i
    roots = [n for n, x in held.items() if x >= SHARE * whole]
    # a single block can't be the root of a page that has others: its parent is
    roots = [n for n in roots if not any(b.owners and b.owners[-1] == n and b.path[-1] in ("p", "li", "td", "h1", "h2", "h3") for b in chosen)] or roots
    root = max(roots, key=depth.__getitem__, default=None)
    return "\n\n".join(b.text for b in blocks if (root is None or root in b.owners) and (b.path in paths or 2 * b.links <= len(b.text) and not _strong(b)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars of every row."""
    K.prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in K.blocks(batch, "html"):
                texts = [main_text((x or b"").decode("utf-8", "replace")) for x in block["html"].to_pylist()]
                yield pa.RecordBatch.from_arrays([block["id"], block["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    rows = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("binary").alias("html"))
    return rows.mapInArrow(run, "id long, url string, text string, n_chars long")
