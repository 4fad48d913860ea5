"""HTML main-text extraction (operator 4) by tag-path ratios.

A page is read into text blocks in page order. A block is the text between two
block-level tags, white space folded, character references decoded; its tag path
leads from the root to its innermost block-level tag. Unclosed paragraphs, list
items, cells and options end where HTML says so.

Content blocks are chosen in four steps:

1. per tag path, over the page: text length and punctuation per block;
2. both series, in page order, are smoothed with a Gaussian over neighbours;
3. they are fused into one score, length * (PLAIN + log(1 + punctuation)), so that link
   lists and titles of boxes score low;
4. paths whose blocks score above the page's threshold (a share of the score's
   deviation) are content. Headings, lists, quotations and cells that share a
   content path's container are content as well, as they belong to its article;
   of an article or main element, whatever else shares the container. A path
   most of whose text is links is a list of links and no such company.

Before that, what is never main text is left out whatever its score: elements
such as nav, footer, aside, form, script and style, page headers, and hidden
elements. Other hints weigh on the scores only: blocks in an article or main element
count ARTICLE times, and those in an element whose class, id or role names a menu,
notice, advert, or reader comments (paths of their own) count MARKED times and must
also reach a share of the page's mean score.

Edge cases: null html = empty html: empty text. A page without content blocks
gives an empty text. Repeated rows give equal texts; null ids and urls pass;
other columns are not read. No text is cut off or capped. An empty table gives no
rows. A very long or deep page, with elements or tags that never end, takes time in proportion to its length.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightmart.llm.common import map_batches, prepare

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg math".split())
SKIP = frozenset(
    "head nav footer aside form button select option dialog menu search object audio video canvas map".split()) | RAW
CLOSES = {  # an opening tag ends these open ones, up to a container
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"},
}
BARRIERS = frozenset("ul ol dl table body html article section div td th blockquote".split())
CONTENT_LEAVES = frozenset("h1 h2 h3 h4 h5 h6 li dd dt blockquote pre td th caption figcaption p summary".split())
HEADS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Words in class, id or role that mark what is not main text.
AWAY = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|adslot|banner|billboard|breadcrumbs?|byline-share|captcha|comments?|commentlist"
    r"|consent|contentinfo|cookies?|disqus|disclaimer|footer|footnav|gdpr|(?<!article[_-])(?<!entry[_-])(?<!post[_-])header|hidden|login|masthead|menu|menubar|modal|nav|navbar|navigation"
    r"|newsletter|notices?|notification|overlay|pager|pagination|paywall|popup|promo\w*|recommend\w*|related|replies|reply"
    r"|responses?|search|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|subscription|tags|teaser|toolbar"
    r"|topbar|widget|alert|complementary)(?=$|[\s_-])", re.I)
#: Of an article element only these: its class often names the page's other parts.
AWAY_ARTICLE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|comments?|promo\w*|related|replies|reply|sponsor\w*|teaser)(?=$|[\s_-])", re.I)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?、。，！？…]")
SIGMA = 1.0
THRESHOLD = 0.5
PLAIN = 0.1  # what a path without any punctuation counts for
ARTICLE = 2.0
MARKED = 0.1


class Path:
    """A tag path: its last tag and the path before it. Equal paths of a page are one object."""

    __slots__ = ("children", "parent", "tag")

    def __init__(self, parent: Path | None = None, tag: str = ""):
        self.parent, self.tag = parent, tag
        self.children: dict[str, Path] = {}

    def child(self, tag: str) -> Path:
        found = self.children.get(tag)
        if found is None:
            found = self.children[tag] = Path(self, tag)
        return found


class Block:
    __slots__ = ("key", "links", "path", "text", "within")

    def __init__(self, path: Path, text: str, links: int, within: bool, marked: bool):
        self.path, self.text, self.links, self.within = path, text, links, within
        self.key = (path, marked)


class Tags:
    """The tags of a page in order, each found in time linear in what it spans.

    A tag that never ends is text. So that many of these don't each search the page to its end, the next
    stopper and the quotes that are known to lead nowhere are remembered.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = html.rfind(">")
        self.stop = (0, -1)              # no stopper between these, the second is one
        self.lost: set[int] = set()      # opening quotes after which no tag ends

    def _stopper(self, i: int) -> int:
        lo, at = self.stop
        if not lo <= i <= at:
            found = _STOP.search(self.html, i)
            at = found.start() if found else len(self.html)
            self.stop = (i, at)
        return at

    def _end(self, i: int) -> int:
        """The place of the > that ends a tag whose attributes start at i; -1 if none does."""
        html, seen = self.html, []
        while i <= self.last:
            at = self._stopper(i)
            if at >= len(html):
                break
            if html[at] == ">":
                return at
            if at in self.lost:
                break
            seen.append(at)
            close = html.find(html[at], at + 1)
            if close < 0:
                break
            i = close + 1
        self.lost.update(seen)
        return -1

    def next(self, position: int) -> tuple[int, int, str, bool, str] | None:
        """Start and end of the next tag, its name (empty: a comment or declaration), whether it is an end
        tag, and its attributes."""
        html = self.html
        at = html.find("<", position)
        while at >= 0:
            after = html[at + 1:at + 2]
            if after in ("!", "?"):
                opened, close = ("<!--", "-->") if html.startswith("<!--", at) else ("<![CDATA[", "]]>")
                if html.startswith(opened, at):
                    end = html.find(close, at + len(opened))
                    return at, len(html) if end < 0 else end + len(close), "", False, ""
                if at < self.last:
                    return at, html.index(">", at) + 1, "", False, ""
            else:
                name = _NAME.match(html, at + 1 + (after == "/"))
                end = self._end(name.end()) if name else -1
                if end >= 0:
                    return at, end + 1, name.group().lower(), after == "/", html[name.end():end]
            at = html.find("<", at + 1)
        return None


class Open:
    """The open elements. An inline element that ends inside a block leaves an empty place, so places stay."""

    def __init__(self):
        self.places: list[tuple[str, bool, bool, Path] | None] = []
        self.at: dict[str, list[int]] = defaultdict(list)     # places of each name, ascending
        self.blocks: list[int] = []
        self.root = Path()

    def path(self) -> Path:
        return self.places[self.blocks[-1]][3] if self.blocks else self.root

    def push(self, name: str, left_out: bool, marked: bool) -> None:
        at = len(self.places)
        path = self.root
        if name in BLOCKS:
            path = self.path().child(name)
            self.blocks.append(at)
        self.places.append((name, left_out, marked, path))
        self.at[name].append(at)

    def innermost(self, name: str) -> int | None:
        found = self.at.get(name)
        return found[-1] if found else None

    def in_block_after(self, at: int) -> bool:
        return bool(self.blocks) and self.blocks[-1] > at

    def to_close(self, ends: set[str]) -> int | None:
        """The outermost element that an opening tag ends: one of ``ends`` within the innermost barrier."""
        barrier = max((self.at[b][-1] for b in BARRIERS - ends if self.at.get(b)), default=-1)
        inside = []
        for e in ends:
            places = self.at.get(e)
            if places and places[-1] > barrier:
                inside.append(places[bisect_right(places, barrier)])
        return min(inside, default=None)

    def remove(self, at: int) -> tuple[str, bool, bool, Path]:
        """Takes one element out; the last one together with the empty places before it."""
        element = self.places[at]
        self.at[element[0]].pop()
        self.places[at] = None
        if self.blocks and self.blocks[-1] == at:
            self.blocks.pop()
        while self.places and self.places[-1] is None:
            self.places.pop()
        return element


def _away(name: str, attributes: str, within: bool) -> tuple[bool, bool]:
    """Whether an element is left out, and whether its names mark it."""
    if name in SKIP:
        return True, False
    if name == "header" and not within:
        return True, False
    marked = False
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key = key.lower()
            if key in ("hidden",) or (key == "aria-hidden" and value.strip("\"'").lower() == "true"):
                return True, False
            if key in ("class", "id", "role") and name not in ("html", "body"):
                words = AWAY_ARTICLE if name in ("article", "main") else AWAY
                if words.search(value.strip("\"'")):
                    marked = True
            if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                return True, False
    return False, marked


def blocks_of(html: str) -> list[Block]:
    """The page's text blocks outside of what is never main text."""
    out: list[Block] = []
    tags, opened = Tags(html), Open()
    gone = links = depth_a = marks = articles = 0    # of the open elements: left out, links, marked, articles
    buffer: list[str] = []
    unended: set[str] = set()
    position, n = 0, len(html)

    def flush() -> None:
        nonlocal links
        if buffer:
            text = _SPACE.sub(" ", "".join(buffer)).strip()
            if text:
                out.append(Block(opened.path(), text, links, articles > 0, marks > 0))
            buffer.clear()
        links = 0

    def add(raw: str) -> None:
        nonlocal links
        if raw and not gone:
            text = unescape(raw)
            buffer.append(text)
            if depth_a:
                links += len(text.strip())

    def close(at: int) -> None:
        nonlocal gone, depth_a, marks, articles
        name, left_out, marked, _ = opened.places[at]
        if name in BLOCKS or marked:
            flush()
        opened.remove(at)
        gone -= left_out
        marks -= marked
        depth_a -= name == "a"
        articles -= name in ("article", "main")

    def close_to(at: int) -> None:
        while len(opened.places) > at:
            close(len(opened.places) - 1)

    while position < n:
        tag = tags.next(position)
        if tag is None:
            rest = html[position:]
            cut = re.search(r"<(?=[a-zA-Z/!?])", rest)  # a tag that never ends
            add(rest[:cut.start()] if cut else rest)
            break
        start, end, name, closing, attributes = tag
        add(html[position:start])
        position = end
        if not name:
            continue
        if closing:
            at = opened.innermost(name)
            if at is None:
                continue
            if name in BLOCKS or not opened.in_block_after(at):
                close_to(at)
            else:  # an inline end tag beyond a block: only the element itself goes
                close(at)
            continue
        if name in BLOCKS:
            flush()
            if name == "p" or name in CLOSES or name in HEADS or name in BARRIERS:
                at = opened.to_close(CLOSES.get(name, set()) | {"p"})
                if at is not None:
                    close_to(at)
        elif name == "br":
            add(" ")
        if name in VOID or attributes.rstrip().endswith("/"):
            continue
        left_out, marked = _away(name, attributes, articles > 0)
        if name in RAW:
            found = None if name in unended else re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, position)
            if found is None:
                if name in ("svg", "math", "noscript", "template"):
                    unended.add(name)
                    continue  # never closed: the rest is page text
                break
            after = html.find(">", found.end())
            position = n if after < 0 else after + 1
            continue
        if marked and name not in BLOCKS and not gone:
            flush()  # a marked span is a block of its own
        opened.push(name, left_out, marked)
        gone += left_out
        marks += marked
        depth_a += name == "a"
        articles += name in ("article", "main")
    close_to(0)
    flush()
    return out


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(2 * sigma))
    weights = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * sigma ** 2))
    weights /= weights.sum()
    padded = np.pad(values, reach, mode="edge")
    return np.convolve(padded, weights, mode="valid")


def content(blocks: list[Block]) -> list[Block]:
    """The blocks of the main text."""
    if not blocks:
        return []
    length, marks, count = defaultdict(float), defaultdict(float), defaultdict(int)
    total, linked = defaultdict(int), defaultdict(int)
    for b in blocks:
        length[b.key] += max(0, len(b.text) - 2 * b.links)
        marks[b.key] += len(_PUNCTUATION.findall(b.text))
        count[b.key] += 1
        total[b.key] += len(b.text)
        linked[b.key] += b.links
    ratio = smoothed(np.array([length[b.key] / count[b.key] for b in blocks]))
    punctuation = smoothed(np.array([marks[b.key] / count[b.key] for b in blocks]))
    weight = np.array([(ARTICLE if b.within else 1) * (MARKED if b.key[1] else 1) for b in blocks])
    fused = ratio * (PLAIN + np.log1p(punctuation)) * weight
    limit = THRESHOLD * fused.std()
    limits = (limit, max(limit, THRESHOLD * fused.mean()))
    best = defaultdict(float)
    for b, score in zip(blocks, fused.tolist(), strict=True):
        best[b.key] = max(best[b.key], score)
    passed = {k for k, score in best.items() if score >= limits[k[1]] and score > 0 and length[k] > 0}
    containers = {(path.parent, marked) for path, marked in passed}
    known: dict[tuple[Path | None, bool], bool] = {}

    def inside(path: Path, marked: bool) -> bool:
        """Does a container hold the path? (The page as such is none.)"""
        way = []
        while path.parent is not None and path.parent.parent is not None and (path, marked) not in known:
            way.append(path)
            if (path.parent, marked) in containers:
                known[path, marked] = True
                break
            path = path.parent
        answer = known.get((path, marked), False)
        known.update({(p, marked): answer for p in way})
        return answer

    def chosen(b: Block) -> bool:
        if b.key in passed:
            return True
        path, marked = b.key
        if path.parent is None or 2 * linked[b.key] > total[b.key] or not (b.within or path.tag in CONTENT_LEAVES):
            return False
        return inside(path, marked)

    return [b for b in blocks if chosen(b)]


def main_text(html: str | None) -> str:
    return "\n".join(b.text for b in content(blocks_of(html))) if html else ""


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row."""
    prepare(pages.sparkSession)

    def run(batch: pa.RecordBatch) -> dict:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts,
                "n_chars": [len(t) for t in texts]}

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return map_batches(rows, run, "page_id long, url string, text string, n_chars long")
