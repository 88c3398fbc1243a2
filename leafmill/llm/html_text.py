"""Operator 6: main text of web pages by tag-path ratios.

A page is read as a sequence of text blocks, each with its tag path: the block-level tags (with
their classes) from the root.  For every path the text length outside links and the punctuation
marks are summed and divided by the number of blocks on it.  The ratios are carried back to the
blocks in page order, smoothed, fused with the raw ones by a weighted geometric mean, and
thresholded by their standard deviation: the blocks above the threshold are the content nodes.

Tags and class words that usually mark boilerplate, and those that mark an article, are factors
of the fused ratio and nothing more: whatever is far richer than the rest of its page is content,
whatever it is called.  Headings, short paragraphs, lists and captions have poor ratios of their
own; they stay if they lie in the element that holds content nodes, or between the first and
the last of these, carry no mark that the content does not carry, and are no list of links
outside an article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import prepare, table, text_chunks

# an attribute value is quoted only behind "=": other quotes are plain characters
_token = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_attribute = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_punctuation = re.compile(r"[.,;:!?…。，、；：！？]")
_digits = re.compile(r"\d+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without text of the page: code, fallbacks and form controls.
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas audio video select datalist button xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big center cite code data del dfn em font i ins kbd label legend mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: A start tag of these ends an open paragraph.
BLOCK = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul dd dt tr td th thead tbody tfoot caption summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that stand in a container; others hold their own text.
LEAVES = HEADINGS | frozenset("p li pre blockquote dd dt td th caption figcaption".split())
#: Factors of the fused ratio.
TAG_FACTORS = {"nav": 0.05, "footer": 0.05, "aside": 0.05, "menu": 0.05, "dialog": 0.05, "form": 0.1, "header": 0.3, "article": 4.0, "main": 4.0}
CLASS_FACTORS = (
    (0.03, re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|respond|replies|disqus)(?:$|[\s_-])", re.I)),
    (0.1, re.compile(
        r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|sidebar|side|widget|footer|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|"
        r"subscribe|signup|login|share|sharing|social|related|recommend\w*|pagination|pager|toolbar|search|complementary|contentinfo|copyright|legal|disclaimer|skip)(?:$|[\s_-])",
        re.I,
    )),
)
#: What marks a paragraph, quotation or item of an article itself; its other class words say what it is, as a correction or a quotation.
OWN_MARKS = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|newsletter|subscribe|signup|share|sharing|social)(?:$|[\s_-])", re.I)
#: Smallest factor of a path, however many marks it carries.
LEAST_FACTOR = 0.002
SMOOTH = np.exp(-0.5 * np.arange(-2, 3) ** 2.0)
SMOOTH /= SMOOTH.sum()
#: Exponent of the smoothed ratios in the fusion; the raw ones have the rest.
SMOOTHED = 0.4
#: The threshold is the standard deviation, within these shares of the best block.
LEAST_SHARE, MOST_SHARE = 1 / 8, 1 / 3
#: A page whose best block is below this has no article (one unmarked word and a full stop have more).
MIN_SCORE = 1.0
# which open tags an opening tag closes, and where the search for them ends
_closes = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_scopes = frozenset("table td th caption".split())


@dataclass
class Page:
    """Elements in order of their start tags (parents first) and text blocks in page order."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#page"])
    path: list[int] = field(default_factory=lambda: [0])
    factor: list[float] = field(default_factory=lambda: [1.0])
    marks: list[int] = field(default_factory=lambda: [0])
    #: outermost article of an element, else its innermost main, else -1
    story: list[int] = field(default_factory=lambda: [-1])
    text: list[str] = field(default_factory=list)
    node: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    anchors: list[int] = field(default_factory=list)


def read_page(source: str) -> Page:
    """Blocks and elements of a page, in time linear in its length, however deeply it is nested."""
    page = Page()
    paths: dict[tuple[int, str], int] = {}
    stack = [0]
    open_at: dict[str, list[int]] = {}  # places in the stack of each open tag
    parts: list[str] = []
    in_link = False
    link_chars = anchors = 0

    def end_block() -> None:
        nonlocal link_chars, anchors
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                page.text.append(text)
                page.node.append(stack[-1])
                page.linked.append(min(link_chars, len(text)))
                page.anchors.append(anchors)
            parts.clear()
        link_chars = anchors = 0

    def close_from(place: int) -> None:
        while len(stack) > place:
            open_at[page.tag[stack.pop()]].pop()

    def last(names) -> int:
        return max((open_at[n][-1] for n in names if open_at.get(n)), default=0)

    def open_element(name: str, attributes: str) -> None:
        above = stack[-1]
        named = " ".join(a or b or c for _, a, b, c in _attribute.findall(attributes)) if attributes else ""
        story = page.story[above]
        factor, marked = page.factor[above], 0
        own = TAG_FACTORS.get(name, 1.0)
        if own > 1:
            own = 1.0 if story >= 0 else own
        elif name == "header" and story >= 0:
            own = 1.0  # the header of an article holds its title
        elif own < 1:
            marked = name != "header"
        own_text = name in LEAVES and story >= 0 and page.tag[story] == "article"
        for value, pattern in CLASS_FACTORS if named else ():
            if (OWN_MARKS if own_text else pattern).search(named):
                own, marked = own * value, 1
                break
        step = f"{name}.{_digits.sub('', named)}" if named else name
        page.parent.append(above)
        page.tag.append(name)
        page.path.append(paths.setdefault((page.path[above], step), len(paths) + 1))
        page.factor.append(max(factor * own, LEAST_FACTOR))
        page.marks.append(page.marks[above] + marked)
        node = len(page.tag) - 1
        outer = story >= 0 and page.tag[story] == "article"
        page.story.append(node if name == "article" and not outer or name == "main" and not outer else story)
        open_at.setdefault(name, []).append(len(stack))
        stack.append(node)

    at, n = 0, len(source)
    for m in iter(lambda: _token.search(source, at), None):
        if m.start() > at:
            parts.append(source[at : m.start()])
            if in_link:
                link_chars += m.start() - at
        at = m.end()
        if m[2] is None:
            continue
        closing, name, attributes = m[1], m[2].lower(), m[3]
        if not m[4]:  # the page is cut off inside a tag
            at = n
            break
        if name == "br":
            parts.append(" ")
        elif name == "a":
            in_link = not closing
            anchors += not closing
        elif name in INLINE:
            continue
        elif name in RAW and not closing:
            end_block()
            stop = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(source, at) if not attributes.endswith("/") or name not in ("svg", "math", "object", "audio", "video") else None
            at = stop.end() if stop else at if attributes.endswith("/") else n
        elif closing:
            if open_at.get(name):
                end_block()
                close_from(open_at[name][-1])
                in_link = False
            elif name == "p":
                end_block()
        elif name in VOID:
            if name == "hr":
                end_block()
        else:
            end_block()
            if name in BLOCK and (p := last(("p",))) and p > last(_scopes):
                close_from(p)
            if name in _closes and (c := last(_closes[name][0])) and c > last(_closes[name][1]):
                close_from(c)
            open_element(name, attributes)
            if attributes.endswith("/") and name in ("g", "path", "rect"):
                close_from(len(stack) - 1)
    if at < n:
        parts.append(source[at:])
        link_chars += (n - at) * in_link
    end_block()
    return page


def ratios(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """(unlinked characters, punctuation marks) of each block's path, divided by the blocks on it."""
    path = np.array([page.path[k] for k in page.node])
    size = np.array([max(0, len(t) - 2 * k) for t, k in zip(page.text, page.linked)], float)
    signs = np.array([len(_punctuation.findall(t)) if 2 * k < len(t) else 0 for t, k in zip(page.text, page.linked)], float)
    blocks = np.bincount(path)[path]
    return np.bincount(path, size)[path] / blocks, np.bincount(path, signs)[path] / blocks


def scores(page: Page) -> np.ndarray:
    """Fused ratio of each block."""
    length, signs = ratios(page)
    edge = len(SMOOTH) // 2
    fused = np.ones(len(length))
    for ratio in (length, signs + 0.5):
        smooth = np.convolve(np.pad(ratio, edge, mode="edge"), SMOOTH, "valid")
        fused *= ratio ** (1 - SMOOTHED) * smooth**SMOOTHED
    return fused * np.array([page.factor[k] for k in page.node])


def content(score: np.ndarray) -> np.ndarray:
    """Which blocks are above the threshold."""
    best = score.max()
    if best < MIN_SCORE:
        return np.zeros(len(score), bool)
    return score >= np.clip(score.std(), LEAST_SHARE * best, MOST_SHARE * best)


def common_ancestor(page: Page, nodes: set[int]) -> int:
    """Lowest element that holds all of ``nodes``: the greatest is replaced by its parent until one is left."""
    import heapq

    left = set(nodes)
    heap = [-k for k in left]
    heapq.heapify(heap)
    while len(left) > 1:
        k = -heapq.heappop(heap)
        left.discard(k)
        if page.parent[k] not in left:
            left.add(page.parent[k])
            heapq.heappush(heap, -page.parent[k])
    return left.pop()


def selected(page: Page) -> np.ndarray:
    """Which blocks belong to the article."""
    score = scores(page)
    # beside an unmarked article that has text of its own, nothing marked wins
    inside = np.array([page.story[k] >= 0 and page.tag[page.story[k]] == "article" and not page.marks[page.story[k]] for k in page.node])
    marked = np.array([page.marks[k] > 0 for k in page.node])
    own = np.array([2 * k < len(t) for t, k in zip(page.text, page.linked)])
    if (inside & ~marked & own).any():
        score = np.where(marked & ~inside, 0.0, score)
    chosen = content(score)
    keep = chosen.copy()
    if not chosen.any():
        return keep
    regions, at = set(), np.flatnonzero(chosen)
    for k in at.tolist():
        node = page.node[k]
        holder = page.parent[node] if page.tag[node] in LEAVES and page.parent[node] > 0 else node
        story = page.story[node]
        regions.add(story if story >= 0 else holder)
    whole = common_ancestor(page, {page.node[k] for k in at.tolist()})
    # marks of the innermost region around each element, -1 outside of all
    allowed: list[int] = []
    for node, above in enumerate(page.parent):
        allowed.append(page.marks[node] if node in regions else allowed[above] if above >= 0 else -1)
    dense = np.array([2 * k >= len(t) for t, k in zip(page.text, page.linked)])
    lonely = ~np.append(False, dense[:-1]) & ~np.append(dense[1:], False) & (np.array(page.anchors) < 2)
    for k in np.flatnonzero(~chosen).tolist():
        node = page.node[k]
        heading = page.tag[node] in HEADINGS
        if dense[k] and not lonely[k] and not heading and not inside[k]:
            continue
        if allowed[node] >= 0:
            keep[k] = page.marks[node] <= allowed[node]
        elif at[0] < k < at[-1]:
            keep[k] = page.marks[node] <= page.marks[whole]
    k = int(at[0]) - 1  # headings right before the first content node
    while k >= 0 and not keep[k] and page.tag[page.node[k]] in HEADINGS and page.factor[page.node[k]] >= 1:
        keep[k] = True
        k -= 1
    return keep


def main_text(source: str | None) -> str:
    """The article of a page: its blocks joined by an empty line; empty if there is none."""
    page = read_page(source or "")
    if not page.text:
        return ""
    return "\n\n".join(t for t, k in zip(page.text, selected(page).tolist()) if k)


def html_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) for each page, from the whole html.

    A null or empty page has an empty text.  One pass, no shuffle; equal rows stay rows, columns
    beside the three are left out whatever their names.  A very long page is one slice of its own.
    """
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "html"):
            texts = [main_text(h) for h in chunk.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([chunk.column("page_id"), chunk.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", F.col("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(table(spark, sf_dir, "pages"))
