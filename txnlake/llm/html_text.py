"""Main text of web pages by minimum-cut labelling of text blocks.

A page is cut into blocks of text.  A linear classifier gives each block the log-odds of being
content; these are the capacities to the two terminals of a graph.  Neighbours in page order, and
blocks next to each other below one parent, are joined by smoothness edges that weaken with their
distance in the tree.  The minimum cut is the labelling of least total cost: content on one side,
boilerplate on the other.

The classifier is a logistic regression over cues (yes or no).  It starts from prior weights and is
fitted to a bounded sample of pages, whose blocks are labelled by the semantic elements around them,
where there are any; a cue that the sample does not show keeps its prior weight.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import RID, numbered, small_batches

SAMPLE_PAGES = 400  # pages that the classifier is fitted to, at most
SMOOTHNESS = 1.0
PRIOR_STRENGTH = 0.05

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style noscript template head title svg iframe object canvas".split())
FORM = set("form button select option textarea label input fieldset".split())
INLINE = set(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# What stands within a block without cutting it.
PHRASE = INLINE | UNSEEN - {"head", "title"}
CLOSED_BY_BLOCK = {"p"}
# Elements whose end tag may be missing: what ends an open one, unless an element of the last set
# lies between.
CELLS = {"td", "th"}
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": (CELLS, {"tr", "table"}),
    "th": (CELLS, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# A head without an end tag ends where one of these does not begin.
IN_HEAD = set("base basefont bgsound link meta noscript script style template title".split())
BOILERPLATE_WORDS = (
    "ad ads advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment "
    "commentlist comments complementary consent contentinfo cookie cookies copyright discussion "
    "disqus foot footer header login masthead menu menus modal nav navbar navigation newsletter "
    "notice notices pagination popup promo promotion related replies reply respond responses share "
    "sharing side sidebar signup social sponsor sponsored subscribe toolbar topbar widget widgets"
).split()
HEADER_WORDS = {"header"}  # boilerplate, but for the header of an article
STATE_WORDS = {"has", "no", "with", "without"}  # "has-sidebar" says what is elsewhere on the page
CONTENT_WORDS = "article content main post story text entry body prose".split()

# Cues and their prior weights.
PRIOR = {
    "bias": -0.5,
    "in article": 4.0,
    "in main": 2.5,
    "paragraph": 1.5,
    "heading": 0.5,
    "list item": -0.3,
    "in nav": -8.0,
    "in header": -5.0,
    "in footer": -8.0,
    "in aside": -8.0,
    "in form": -8.0,
    "boilerplate name": -8.0,
    "content name": 1.5,
    "mostly links": -2.0,
    "all links": -1.5,
    "over 10 words": 0.7,
    "over 40 words": 0.8,
    "sentence end": 0.5,
}
CUES = list(PRIOR)
BIT = {cue: 1 << i for i, cue in enumerate(CUES)}
CONTENT_SIDE = BIT["in article"] | BIT["in main"]
OTHER_SIDE = (
    BIT["in nav"] | BIT["in header"] | BIT["in footer"] | BIT["in aside"] | BIT["in form"]
    | BIT["boilerplate name"]
)
BY_ELEMENT = {
    "article": "in article",
    "main": "in main",
    "nav": "in nav",
    "menu": "in nav",
    "header": "in header",
    "footer": "in footer",
    "aside": "in aside",
    "dialog": "in aside",
}


def _name_bits(attributes: list[tuple[str, str | None]], in_article: bool) -> int:
    bits = 0
    for key, value in attributes:
        if key in ("class", "id", "role") and value:
            for name in value.split():
                spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()
                words = set(re.split(r"[^a-z0-9]+", spaced))
                if words & STATE_WORDS:
                    continue
                if in_article or words & _CONTENT:
                    words -= HEADER_WORDS
                if words & _BOILERPLATE:
                    bits |= BIT["boilerplate name"]
                elif words & _CONTENT:
                    bits |= BIT["content name"]
        elif key in ("hidden", "aria-hidden") and value != "false":
            bits |= BIT["boilerplate name"]
    return bits


_BOILERPLATE, _CONTENT = set(BOILERPLATE_WORDS), set(CONTENT_WORDS)


class _Place:
    """An element that is no phrase, by its parent and depth; the page itself has depth 0."""

    __slots__ = ("parent", "depth")

    def __init__(self, parent: _Place | None = None):
        self.parent = parent
        self.depth = parent.depth + 1 if parent else 0


def distance(a: _Place, b: _Place) -> int:
    """Steps from one element to the other through the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


class _Blocks(HTMLParser):
    """Collects (text, cues, place) of the blocks of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = _Place()
        self.stack: list[tuple[str, int, _Place]] = []  # tag, cues, innermost place
        self.open: Counter[str] = Counter()
        self.blocks: list[tuple[str, int, _Place]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.unseen = 0
        self.links = 0

    def cues(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def place(self) -> _Place:
        return self.stack[-1][2] if self.stack else self.page

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            bits, words = self.cues() | BIT["bias"], text.count(" ") + 1
            if words > 10:
                bits |= BIT["over 10 words"]
            if words > 40:
                bits |= BIT["over 40 words"]
            if text[-1] in ".!?…\"'":
                bits |= BIT["sentence end"]
            if 2 * self.linked > len(text):
                bits |= BIT["mostly links"]
            if 10 * self.linked > 9 * len(text):
                bits |= BIT["all links"]
            self.blocks.append((text, bits, self.place()))
        self.parts, self.linked = [], 0

    def end_implied(self, tag: str) -> None:
        """Leave the elements that the begin of `tag` ends."""
        if self.stack and self.stack[-1][0] == "head" and tag not in IN_HEAD:
            self.leave(len(self.stack) - 1)
        if tag not in PHRASE:  # a block ends an open paragraph
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in CLOSED_BY_BLOCK:
                    self.leave(i)
                    break
                if self.stack[i][0] not in PHRASE:
                    break
        ended, within = IMPLIED_ENDS.get(tag, ((), ()))
        if not any(self.open[t] for t in ended):
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in within:
                break
            if self.stack[i][0] in ended:
                self.leave(i)
                break

    def handle_starttag(self, tag, attrs):
        if tag not in PHRASE:
            self.flush()
        self.end_implied(tag)
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        bits = self.cues() & ~(BIT["paragraph"] | BIT["heading"] | BIT["list item"])
        if tag in INLINE:
            bits = self.cues()
        elif tag in ("p", "blockquote", "pre"):
            bits |= BIT["paragraph"]
        elif re.fullmatch("h[1-6]", tag):
            bits |= BIT["heading"]
        elif tag in ("li", "dt", "dd", "td", "th"):
            bits |= BIT["list item"]
        if tag == "main":
            bits &= ~BIT["boilerplate name"]  # the name is of something around the whole page
        if tag in BY_ELEMENT:
            bits |= BIT[BY_ELEMENT[tag]]
            if tag == "header" and bits & BIT["in article"]:
                bits &= ~BIT["in header"]  # of the article, not of the page
        if tag in FORM:
            bits |= BIT["in form"]
        if attrs and tag not in ("html", "body", "article", "main"):
            bits |= _name_bits(attrs, bool(bits & BIT["in article"]))
        self.unseen += tag in UNSEEN
        self.links += tag == "a"
        self.open[tag] += 1
        place = self.place() if tag in PHRASE else _Place(self.place())
        self.stack.append((tag, bits, place))

    def leave(self, depth: int) -> None:
        for tag, _, _ in self.stack[depth:]:
            self.unseen -= tag in UNSEEN
            self.links -= tag == "a"
            self.open[tag] -= 1
        del self.stack[depth:]

    def handle_endtag(self, tag):
        if tag not in PHRASE:
            self.flush()
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self.leave(i)
                return
            if tag in INLINE and self.stack[i][0] not in INLINE:
                return  # an inline element does not end across a block

    def handle_data(self, data):
        if not self.unseen:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def blocks_of(html: str) -> list[tuple[str, int, _Place]]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()  # gives out what is left
    parser.flush()
    return parser.blocks


def smoothness(blocks) -> list[tuple[int, int, float]]:
    """Edges between neighbours in page order and between siblings, weaker with tree distance."""
    edges, last_below = [], {}

    def weight(i, j):
        return SMOOTHNESS / (1 + distance(blocks[i][2], blocks[j][2]))

    for i, (_, _, place) in enumerate(blocks):
        parent = place.parent or place
        before = last_below.get(parent)
        if i:
            edges.append((i - 1, i, weight(i - 1, i)))
        if before is not None and before != i - 1:
            edges.append((before, i, weight(before, i)))
        last_below[parent] = i
    return edges


def content_side(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Minimum cut between content (positive odds) and boilerplate: True on the content side.

    Flow goes from blocks with odds to spare, along shortest paths, to blocks that lack them.
    """
    n = len(odds)
    spare = [max(0.0, x) for x in odds]
    lack = [max(0.0, -x) for x in odds]
    room: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        room[a][b] = room[a].get(b, 0.0) + w
        room[b][a] = room[b].get(a, 0.0) + w
    tiny = 1e-9
    while True:
        came = [-1 if s > tiny else None for s in spare]
        queue = deque(i for i in range(n) if came[i] is not None)
        goals = []
        while queue:
            i = queue.popleft()
            if lack[i] > tiny:
                goals.append(i)
                continue
            for j, w in room[i].items():
                if w > tiny and came[j] is None:
                    came[j] = i
                    queue.append(j)
        if not goals:
            return [c is not None for c in came]
        for goal in goals:
            path, i = [], goal
            while came[i] != -1:
                path.append((came[i], i))
                i = came[i]
            push = min([spare[i], lack[goal], *(room[a][b] for a, b in path)])
            if push <= tiny:
                continue
            spare[i] -= push
            lack[goal] -= push
            for a, b in path:
                room[a][b] -= push
                room[b][a] = room[b].get(a, 0.0) + push


def main_text(html: str, weights: np.ndarray) -> str:
    blocks = blocks_of(html)
    odds = [sum(w for i, w in enumerate(weights) if bits >> i & 1) for _, bits, _ in blocks]
    if all(x > 0 for x in odds):
        kept = [True] * len(odds)
    elif all(x < 0 for x in odds):
        kept = [False] * len(odds)
    else:
        kept = content_side(odds, smoothness(blocks))
    return "\n".join(text for (text, _, _), keep in zip(blocks, kept, strict=True) if keep)


def fit(pages: DataFrame, html: str = "html", page_id: str = "page_id") -> np.ndarray:
    """Weights of the cues.  The sample is the pages with the smallest hashes of their id."""
    prior = np.array(list(PRIOR.values()))
    rows = small_batches(pages).select(
        F.col(html).alias("html"), F.xxhash64(F.col(page_id), F.length(html)).alias("place")
    )
    least = rows.filter("html is not null").select("place").orderBy("place").limit(SAMPLE_PAGES)
    places = [r.place for r in least.collect()]
    if not places:
        return prior
    sample = rows.filter(F.col("place") <= max(places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [b for h in batch.column("html").to_pylist() for _, b, _ in blocks_of(h or "")]
            yield pa.RecordBatch.from_arrays([pa.array(bits, pa.int32())], names=["bits"])

    counted = sample.select("html").mapInArrow(run, "bits int").groupBy("bits").count()
    found = [(r.bits, r["count"]) for r in counted.collect()]  # distinct sets of cues
    return _fitted(prior, found)


def _fitted(prior: np.ndarray, found: list[tuple[int, int]]) -> np.ndarray:
    """Logistic regression by gradient descent, held to the prior weights."""
    clear = [(b, n) for b, n in sorted(found) if b & (CONTENT_SIDE | OTHER_SIDE)]
    if not clear:
        return prior
    x = np.array([[b >> i & 1 for i in range(len(CUES))] for b, _ in clear], float)
    # What lies in boilerplate is boilerplate, also within an article.
    y = np.array([0.0 if b & OTHER_SIDE else 1.0 for b, _ in clear])
    n = np.array([c for _, c in clear], float)
    n /= n.sum()
    weights = prior.copy()
    for _ in range(300):
        error = n * (1 / (1 + np.exp(-x @ weights)) - y)
        weights -= 0.5 * (x.T @ error + PRIOR_STRENGTH * (weights - prior))
    return weights


def extract(
    pages: DataFrame,
    weights: np.ndarray | None = None,
    html: str = "html",
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row for each row of `pages`: page_id, url, text.

    Character references are decoded, white space within a block becomes one space, blocks are
    joined by line breaks in page order.  Null and empty pages, and pages without content, have
    empty text.  Repeated rows are treated alike; an empty table gives an empty result; other
    columns are not read.
    """
    if weights is None:
        weights = fit(pages, html, page_id)
    rows = numbered(
        pages,
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        F.col(html).alias("html"),
    )
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for start in range(0, big.num_rows, 500):
                batch = big.slice(start, 500)
                texts = [main_text(h.as_py() or "", weights) for h in batch.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                    names=["page_id", "url", "text"],
                )

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string")
