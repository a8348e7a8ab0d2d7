"""Main text of HTML pages by smoothed text-to-tag ratios.

The standard library's parser sends events; they are cut into lines, one per block of
text, each with the tags met on its way. The ratio of text outside links to tags, as a
logarithm, is smoothed along the page by a Gaussian, and two clusters of the smoothed ratios part content
lines from the rest. Content lines choose the region: the smallest element that holds all
of those outside articles, without its lists of links. Articles stay whole, each of them.
All lines of a region stay, short ones too; where the region of lines outside holds
articles, only the content lines themselves stay beside them.

Only a tag drops its lines outright (``DROPPED``: navigation, forms, asides, scripts and the
like). A class, id or role that names such a thing (``BOILERPLATE``) makes an element
suspect: its lines weigh nothing and stay out of the region, unless without them the page, or
the article around them, has no content line and little text; then the outermost suspect element that
holds the most content is cleared, until there is one. The word must be what the name is
about: ``with-sidebar``, ``no-comments`` and ``share-prices`` name none.

Elements are numbered as they open and close, so time and memory are linear in the page
however deep it nests.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from math import exp, log1p

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Standard deviation and reach of the smoothing, in lines.
SIGMA, REACH = 1.0, 2
#: Characters the parser is fed at once.
FEED = 1 << 16

#: Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre"
    " section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never part of an article.
DROPPED = frozenset(
    "aside audio button canvas datalist dialog footer form head iframe input label map math menu nav noscript object"
    " script select style svg template textarea title video".split()
)
#: Words of a class, id or role that mark text around an article.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline comment comments complementary"
    " consent contentinfo cookie cookies dialog disclaimer disqus footer form login masthead menu menubar modal nav navbar"
    " navigation newsletter notice notices notification pager pagination popup promo promotion related recommended reply"
    " rail replies respond search share sharing side sidebar signup skip social sponsor sponsored subscribe subscription toolbar"
    " widget".split()
)
#: Elements that can be a region of a page without articles; others hold single lines.
REGIONS = frozenset("body center div dl html main ol section table tbody td tr ul".split()) | {""}
ARTICLES = frozenset(("article", "main"))
#: An open element of the first kind ends where one of the second starts.
ENDED_BY = {
    "p": BLOCKS - {"html", "body", "head"}, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "option": frozenset(("option",)),
    "head": frozenset(("body", "article", "main", "div", "p", "section", "nav", "header")),
}
#: A suspect element is cleared if its content is more than so many times the text that is not suspect.
MOST = 4
#: Words that say where or how, not what: they are passed over at the end of a name.
POSITIONS = frozenset(
    "area articles bar block body bottom box btn button buttons col column container content contents field group"
    " heading holder icon icons inner item items label left link links list main module outer panel posts primary region right"
    " row secondary section slot stories text title top unit wrap wrapper zone".split()
)
#: A name that begins with one of these tells a property of the element, no part of the page.
PROPERTIES = frozenset("has have hide is no not show with without".split())
#: Whose header stands around an article.
SITE = frozenset("blog global main masthead page site top web website".split())
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Element:
    """An open or closed element; ``number`` to ``last`` are the elements inside it."""

    __slots__ = ("tag", "parent", "number", "last", "block", "inline", "dropped", "inside_dropped", "suspect", "article", "heading", "own_head")

    def __init__(self, tag: str, parent: Element | None, number: int):
        self.tag, self.parent, self.number, self.last = tag, parent, number, number
        self.block: Element = self if parent is None or tag in BLOCKS else parent.block
        self.inline: Counter[str] = Counter()  # formatting open in this block
        self.dropped = parent is not None and parent.dropped
        self.inside_dropped = parent is not None and parent.inside_dropped  # of a dropping tag, but for the page's head
        self.suspect: Element | None = parent.suspect if parent else None  # the nearest around
        self.article: Element | None = parent.article if parent else None
        self.heading = parent is not None and parent.heading  # inside h1 to h6
        self.own_head = parent is not None and parent.own_head  # inside the header of an article

    def holds(self, other: Element) -> bool:
        return self.number <= other.number <= self.last


@dataclass
class Line:
    text: str
    tags: int
    linked: int  # characters inside links
    element: Element


class Lines(HTMLParser):
    """Turns the events of a page into its lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.here = Element("", None, 0)
        self.elements = [self.root]
        self.open: Counter[str] = Counter()
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = self.links = self.linked = 0

    def _cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            if not self.here.dropped and not (self.here.own_head and not self.here.heading):
                self.lines.append(Line(text, self.tags, min(self.linked, len(text)), self.here))
            self.tags = 0
        self.parts, self.linked = [], 0

    def _leave(self, until: Element) -> None:
        """Close elements up to and with ``until``."""
        while True:
            at = self.here
            at.last = len(self.elements) - 1
            self.open[at.tag] -= 1
            if at.tag not in BLOCKS:
                at.block.inline[at.tag] -= 1
            self.here = at.parent
            if at is until:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self._cut()
            # a new paragraph ends an open one, even through formatting left open
            while self.here.block.parent and tag in ENDED_BY.get(self.here.block.tag, ()):
                self._leave(self.here.block)
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag == "a":
            self.links += 1
        up = self.here
        made = Element(tag, up, len(self.elements))
        self.elements.append(made)
        self.open[tag] += 1
        if tag not in BLOCKS:
            made.block.inline[tag] += 1
        hidden, named = _marked(attrs, up.article is not None) if tag not in ("html", "body", "main") else (False, False)
        made.dropped = up.dropped or hidden or tag in DROPPED
        made.inside_dropped = up.inside_dropped or hidden or (tag in DROPPED and tag != "head")
        if tag in ARTICLES and not named and not made.inside_dropped:
            made.dropped, made.suspect = False, None  # an advert left open does not swallow the article
            made.article = up.article or made
        elif named:
            made.suspect = made
        made.heading = up.heading or (len(tag) == 2 and tag[0] == "h" and tag[1] in "123456")
        if tag == "header":
            made.dropped = made.dropped or made.article is None
            made.own_head = made.own_head or made.article is not None
        self.here = made

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self._cut()
        if tag == "a":
            self.links = max(0, self.links - 1)
        # formatting ends in the block it was opened in, a block wherever it is open
        if not (self.open if tag in BLOCKS else self.here.block.inline)[tag]:
            return
        at = self.here
        while at.tag != tag:
            at = at.parent
        self._leave(at)

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())

    def run(self, page: str) -> list[Line]:
        for at in range(0, len(page), FEED):
            self.feed(page[at : at + FEED])
        self.close()
        self._cut()
        if self.here.parent:
            self._leave(self._outermost())
        self.root.last = len(self.elements) - 1
        return self.lines

    def _outermost(self) -> Element:
        at = self.here
        while at.parent.parent:
            at = at.parent
        return at


def names_boilerplate(name: str, in_article: bool = False) -> bool:
    """Whether one class, id or role is about a thing around an article: by its last word that is no position.

    A header is one outside articles only, and where it is the site's.
    """
    words = [w.lower() for w in _NAMES.findall(name)]
    if not words or words[0] in PROPERTIES:
        return False
    while len(words) > 1 and (words[-1] in POSITIONS or words[-1].isdigit()):
        words.pop()
    if words[-1] == "header":
        return not in_article and (len(words) == 1 or words[-2] in SITE)
    return words[-1] in BOILERPLATE


def _marked(attrs: list[tuple[str, str | None]], in_article: bool) -> tuple[bool, bool]:
    """Whether an element is hidden, and whether a name of it is about a thing around an article."""
    hidden = named = False
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            named = named or any(names_boilerplate(n, in_article) for n in value.split())
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style" and value and "display:none" in value.replace(" ", "").lower():
            hidden = True
    return hidden, named


def smoothed(ratios: list[float]) -> list[float]:
    """Gaussian smoothing; at the ends the weights that exist count."""
    weights = [exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(REACH + 1)]
    out = []
    for i in range(len(ratios)):
        near = range(max(0, i - REACH), min(len(ratios), i + REACH + 1))
        total = sum(weights[abs(i - j)] for j in near)
        out.append(sum(weights[abs(i - j)] * ratios[j] for j in near) / total)
    return out


def threshold(values: list[float]) -> float:
    """Where two clusters of the values meet; minus infinity if there is one value only."""
    low, high = min(values), max(values)
    if low == high:
        return float("-inf")
    while True:
        cut = (low + high) / 2
        below, above = [v for v in values if v < cut], [v for v in values if v >= cut]
        new = sum(below) / len(below), sum(above) / len(above)
        if new == (low, high):
            return cut
        low, high = new


def _cleared(elements: list[Element], lines: list[Line], ratios: list[float]) -> set[int]:
    """Numbers of the suspect elements that hold what would otherwise be missing.

    They are cleared from the outside in, so whatever is around a cleared one is cleared.
    """
    suspects = [e for e in elements if e.suspect is e]
    cleared: set[int] = set()
    if not suspects:
        return cleared
    values = smoothed(ratios)
    cut = threshold(values)
    scope = lambda e: e.article.number if e.article else None
    own: Counter[int] = Counter()  # content lines right inside a suspect element, by its number
    size: Counter[int] = Counter()  # and their characters, later those of all inside
    free: set[int | None] = set()  # articles, and None for the page around them, with content lines that are not suspect
    rest: Counter[int | None] = Counter()  # characters there that are not suspect
    for x, v in zip(lines, values):
        if x.element.suspect is None:
            rest[scope(x.element)] += len(x.text) - x.linked
            if v >= cut:
                free.add(scope(x.element))
        elif v >= cut:
            own[x.element.suspect.number] += 1
            size[x.element.suspect.number] += len(x.text) - x.linked
    inner: dict[tuple, list[Element]] = {}
    for e in reversed(suspects):
        up = e.parent.suspect
        if up is not None:
            size[up.number] += size[e.number]
        inner.setdefault((scope(e), up.number if up else None), []).append(e)
    # the page around articles that have text needs none of its own
    wanted = {s for s, _ in inner} - free - ({None} if any(x.element.article and x.element.suspect is None for x in lines) else set())
    for s in wanted:
        level = inner.get((s, None), [])
        while level:
            best = max(reversed(level), key=lambda e: size[e.number])
            if size[best.number] <= MOST * rest[s]:
                break
            cleared.add(best.number)
            level = [] if own[best.number] else inner.get((s, best.number), [])
    return cleared


def main_text(page: str | None) -> str:
    parser = Lines()
    lines = parser.run(page or "")
    if not lines:
        return ""
    ratios = [log1p((len(x.text) - x.linked) / max(1, x.tags)) for x in lines]
    cleared = _cleared(parser.elements, lines, ratios)
    suspect = [x.element.suspect is not None and x.element.suspect.number not in cleared for x in lines]
    weights = [0.0 if s else r for s, r in zip(suspect, ratios)]
    values = smoothed(weights)
    cut = threshold(values)
    clear = [x for x, s in zip(lines, suspect) if not s]
    articles = any(x.element.article for x in clear)
    # beside an article a line must reach the cut by itself, not by what its neighbours lend it
    content = [
        x for x, v, own, s in zip(lines, values, weights, suspect) if v >= cut and not s and not (articles and (x.element.article or own < cut))
    ]
    kept = {id(x) for x in clear if x.element.article}
    if content:
        kept |= {id(x) for x in _region(parser.elements, clear, content)}
    return "\n\n".join(x.text for x in clear if id(x) in kept)


def _region(elements: list[Element], lines: list[Line], content: list[Line]) -> list[Line]:
    """Lines of the smallest element that holds all of ``content``, but for lists of links without any."""
    first, last = (end(x.element.number for x in content) for end in (min, max))
    best = content[0].element
    while not (best.number <= first and last <= best.last and best.tag in REGIONS):
        best = best.parent
    while best.tag == "section" and best.parent:
        best = best.parent  # a section is a part of what surrounds it
    inside = [x for x in lines if best.holds(x.element)]
    if any(x.element.article for x in inside):
        return content
    children = [e for e in elements[best.number + 1 : best.last + 1] if e.parent is best]
    starts = [e.number for e in children]
    branch = {}
    for x in inside:
        at = bisect_right(starts, x.element.number) - 1
        branch[id(x)] = children[at] if at >= 0 and children[at].holds(x.element) else best
    holds = {id(branch[id(x)]) for x in content}
    size: dict[int, list[int]] = {}
    for x in inside:
        total = size.setdefault(id(branch[id(x)]), [0, 0])
        total[0] += len(x.text)
        total[1] += x.linked
    return [x for x in inside if (b := branch[id(x)]) is best or id(b) in holds or b.tag not in REGIONS or 2 * size[id(b)][1] <= size[id(b)][0]]


def with_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text in ``out``, in place of ``html``.

    Null and empty pages, and pages without text, give an empty text. Rows, repeated ones
    too, and other columns stay; a column already named ``out`` is replaced.
    """
    kept = [f for f in pages.schema.fields if f.name not in (html, out)]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(page) for page in batch.column(html).to_pylist()], arrow.field(out).type)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name).cast(f.type) for f in list(arrow)[:-1]), texts], schema=arrow)

    return pages.mapInArrow(run, schema)


def report(pages: DataFrame) -> DataFrame:
    found = with_text(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
