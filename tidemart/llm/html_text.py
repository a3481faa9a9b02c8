"""Main text of web pages from the standard library's parser events.

A page becomes lines, one per block element. Elements that by tag or role hold
no article text (menus, footers, dialogs and the like) or are hidden give no
lines. Each line has a text-to-tag ratio; the ratios are smoothed with a
Gaussian, and lines above one standard deviation form the content cluster.

Forms, and elements whose class or id names a sidebar, notice, advert, reader
comments or the like, are set aside beside an article or main element. Inside
one, and on pages without, they are set aside only if the cluster allows it: an
element with half or more of the clustered text outside links stays, and so do
all elements of a name that together have as much. An article or main element
is never set aside for its own name, nor is what holds the one with most text.

Reader comments go however long they are, if something tells them apart: an
element's class or id is one of comments (not just a state of the page, as in
``comments-open``), or it begins with a heading that says so. They stay only
where the page has no story beside them, that is not as much clustered text as
one of their usual paragraphs. ``BESIDE_WORDS`` tell only beside an article.

Article elements inside another one, which has a story of its own, are its
comments or teasers. Of articles side by side, those far smaller than the
largest story are teasers if there are several, or if their names or links say
so. What is left then makes the cluster that decides about all other names.

The cluster is then taken of the lines that are left. The text is that of the
outermost article and main elements, all that have clustered text, if together
they hold nearly all of the cluster. Otherwise it is that of the lowest element
of several lines that holds the whole cluster and, if it has no title of its
own, the last one before it; lists of links at its ends are menus. All lines
there that are not set aside are the text, short ones too.

Null or empty pages and pages without text give an empty string. Whatever the
markup, each page gives one row; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.text import column

# Names of HTML elements, roles and usual class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]), "body": frozenset(["head", "title", "style", "script"]),
}
HOLDS_LISTS = frozenset("ul ol menu dl table select article section div main body nav aside".split())
NO_TEXT = frozenset(
    "head title script style noscript template iframe object svg canvas nav footer aside button select "
    "textarea dialog menu datalist audio video map".split()
)
NO_TEXT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar status "
    "tablist tooltip".split()
)
# Tags, roles and names below are set aside only as far as the cluster allows.
FORM = "form"
NO_TEXT_WORDS = frozenset(
    "ad ads adbox adslot adsense adunit aside banner breadcrumb breadcrumbs byline-share consent cookie cookies "
    "copyright dialog disqus footer gdpr hidden legal login masthead menu menus modal nav navbar navigation notice "
    "notices notification notifications outbrain overlay pager pagination popup recommended related replies respond "
    "rail search share sharebar sharing sidebar sidebars signup skip social subscribe subscription taboola teaser "
    "toolbar topbar widget widgets".split()
)
NO_TEXT_STARTS = ("advert", "comment", "cookie", "newsletter", "promo", "sidebar", "sponsor")
#: These tell only beside an article: inside one, and on pages without, they may name a chapter.
BESIDE_WORDS = frozenset("conversation discussion discussions feedback responses thread threads".split())
#: Names of articles that lead to other pages.
TEASER_WORDS = frozenset("ad card promo promoted recommended related sponsored teaser teasers".split())
COMMENTS = re.compile(
    r"(?:(?:user|reader|readers|post|article|blog|entry|the|fb|wp)[-_]?)?comments?"
    r"(?:[-_]?(?:list|area|box|sections?|threads?|body|text|content|wrap|wrapper|container|items?|form|respond|[0-9]+))*"
)
COMMENTS_TITLE = re.compile(
    r"(?:(?:[0-9]+|no|all|add an?|join the|leave an?|post an?|readers?|reader's|user) )*(?:comments?|replies|reply|responses?)(?: ?\([0-9]+\))?\W*",
    re.IGNORECASE,
)
#: Of elements with this name headings stay.
HEADER = "header"
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
TITLES = frozenset("h1 h2 hgroup".split())
REGIONS = frozenset(["article", "main"])

#: Lines on either side over which ratios are smoothed, in standard deviations of the Gaussian and lines.
SIGMA, REACH = 1.0, 2
#: Share of the clustered text that article and main elements must hold to be the whole text.
NEARLY_ALL = 0.8
#: Share of the clustered text from which an element or a name is not set aside.
MOST = 0.5
#: Share of the largest story below which an article is a small one, and share of links from which it is a teaser.
SMALL, LINKED = 0.25, 0.1

_WORDS = re.compile(r"[^a-z0-9]+")


class _Element:
    __slots__ = ("article", "comments", "name", "named", "named_region", "parent", "set_aside", "tag", "teaser")

    def __init__(self, tag: str, parent: _Element | None, set_aside: str, name: str, named_region: bool) -> None:
        self.tag, self.parent, self.set_aside, self.name, self.named_region = tag, parent, set_aside, name, named_region
        self.article = self.comments = self.teaser = False
        #: The innermost element with a name that this one is or lies in.
        self.named: _Element | None = self if name else parent and parent.named


def _aside(tag: str, attrs: list[tuple[str, str | None]], parent: _Element, named_region: bool) -> tuple[str, str]:
    """Why an element's text is no article text: "all", "head" (headings stay) or "" if it may be; and by what name it may not be."""
    if parent.set_aside == "all" or tag in NO_TEXT:
        return "all", ""
    held = parent.set_aside
    if tag == "header":
        held = "head"
    if tag in ("html", "body"):
        return held, ""
    named = FORM if tag == "form" else ""
    for name, value in attrs:
        value = (value or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "all", ""
        if name == "role" and value in NO_TEXT_ROLES:
            return "all", ""
        if name == "role" and value == "form":
            named = FORM
        if name == "style" and "display:none" in value.replace(" ", ""):
            return "all", ""
        if name in ("class", "id") and value and not named_region:
            words = [w for w in _WORDS.split(value) if w]
            told = [w for w in words if w in NO_TEXT_WORDS or w.startswith(NO_TEXT_STARTS)] or [w for w in words if w in BESIDE_WORDS]
            if told:
                named = told[0]
            elif not named and HEADER in words and tag not in HEADINGS:
                named = HEADER
    return held, named


class _Lines(HTMLParser):
    """Collects a page's lines: text, number of tags, characters in links, enclosing element; and which are headings."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.at = self.root = _Element("", None, "", "", False)
        self.lines: list[tuple[str, int, int, _Element]] = []
        self.titles: list[bool] = []
        self.text: list[str] = []
        self.tags = self.linked = 0
        self.links = self.headings = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.linked, self.at))
            self.titles.append(self.headings > 0)
            self.tags = self.linked = 0
        self.text = []

    def _close(self, element: _Element) -> None:
        while self.at is not element:
            self._leave()
        self._leave()

    def _leave(self) -> None:
        self.links -= self.at.tag == "a"
        self.headings -= self.at.tag in HEADINGS
        self.at = self.at.parent or self.root

    def _open(self, tags: frozenset[str], stop: frozenset[str]) -> _Element | None:
        element: _Element | None = self.at
        while element is not None and element.parent is not None:
            if element.tag in tags:
                return element
            if element.tag in stop:
                return None
            element = element.parent
        return None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag not in INLINE:
            self._end_line()
            for closed, stop in ((frozenset(["p"]), HOLDS_LISTS), (CLOSES.get(tag, frozenset()), HOLDS_LISTS)):
                while closed and (element := self._open(closed, stop if tag != "body" else frozenset())):
                    self._close(element)
        if tag in VOID:
            return
        named = tag in REGIONS or any(
            n == "role" and v in ("main", "article") or n == "itemprop" and v == "articleBody" for n, v in attrs
        )
        element = _Element(tag, self.at, *_aside(tag, attrs, self.at, named), named)
        if tag not in ("html", "body", "main"):
            element.article = tag == "article" or ("role", "article") in attrs
            tokens = [t for n, v in attrs if n in ("class", "id") for t in re.split(r"\s+|__|--", (v or "").lower())]
            element.comments = any(COMMENTS.fullmatch(t) for t in tokens)
            element.teaser = element.article and any(w in TEASER_WORDS for t in tokens for w in _WORDS.split(t))
        self.at = element
        self.links += tag == "a"
        self.headings += tag in HEADINGS

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        self.tags += 1
        if tag not in INLINE:
            self._end_line()
        stop = frozenset(["article", "main", "body", "td"]) if tag in INLINE or tag == "p" else frozenset()
        if element := self._open(frozenset([tag]), stop - {tag}):
            self._close(element)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if self.at.set_aside == "all" or self.at.set_aside == "head" and not self.headings:
            return
        self.text.append(data)
        if self.links:
            self.linked += len(data)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian means of neighbouring ratios; at the ends of those there are."""
    weights = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
    centre = slice(REACH, REACH + len(ratios))
    return np.convolve(ratios, weights)[centre] / np.convolve(np.ones(len(ratios)), weights)[centre]


def _chain(element: _Element | None) -> Iterator[_Element]:
    while element is not None:
        yield element
        element = element.parent


def _cluster(page: _Lines) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Sizes and ratios of a page's lines, the threshold of the smoothed ratios, and which lines reach it."""
    sizes = np.array([len(text) for text, *_ in page.lines], float)
    ratios = sizes / np.maximum(1, [tags for _, tags, _, _ in page.lines])
    means = smoothed(ratios)
    threshold = min(means.max(), np.std(means))
    return sizes, ratios, threshold, means >= threshold


def _without(page: _Lines, aside: set[_Element]) -> None:
    """Drop the lines that lie in one of these elements."""
    stays = [aside.isdisjoint(_chain(line[3])) for line in page.lines]
    page.lines = [line for line, s in zip(page.lines, stays, strict=True) if s]
    page.titles = [title for title, s in zip(page.titles, stays, strict=True) if s]


def _drop_comments(page: _Lines) -> None:
    """Drop what is named or headed as reader comments, if the page has a story beside them."""
    first: dict[_Element, int] = {}
    for k, (*_, holder) in enumerate(page.lines):
        for element in _chain(holder):
            first.setdefault(element, k)
    for k, ((text, _, _, holder), title) in enumerate(zip(page.lines, page.titles, strict=True)):
        if title and COMMENTS_TITLE.fullmatch(text):
            heading = next(e for e in _chain(holder) if e.tag in HEADINGS)
            section = heading.parent
            if section is not None and section.parent is not None and section.tag not in ("html", "body", "main") and first[section] == k:
                section.comments = True
    of_readers = [any(e.comments for e in _chain(line[3])) for line in page.lines]
    if not any(of_readers):
        return
    sizes, _, _, content = _cluster(page)
    mass = _masses(page, sizes, content)
    most = MOST * mass[page.root]
    told, story = [], 0.0
    for (_, _, linked, holder), title, readers, size, chosen in zip(page.lines, page.titles, of_readers, sizes, content, strict=True):
        if not chosen:
            continue
        if readers:
            told.append(size)
        elif not title and linked < 0.5 * size and all(mass[e] >= most for e in _chain(holder) if e.name):
            story += size
    if story and (not told or story >= np.median(told)):
        _without(page, {e for e in first if e.comments})


def _drop_lesser_articles(page: _Lines) -> None:
    """Drop articles inside a story, and small ones beside it."""
    if not any(e.article for *_, holder in page.lines for e in _chain(holder)):
        return
    sizes, _, _, content = _cluster(page)
    mass, length, links = _masses(page, sizes, content), {}, {}
    for (_, _, linked, holder), size in zip(page.lines, sizes, strict=True):
        for element in _chain(holder):
            length[element] = length.get(element, 0.0) + size
            links[element] = links.get(element, 0.0) + linked
    inside: dict[_Element | None, list[_Element]] = {}
    for element in mass:
        if element.article:
            inside.setdefault(next((e for e in _chain(element.parent) if e.article), None), []).append(element)
    aside: set[_Element] = set()
    for story, held in inside.items():
        own = mass[story or page.root] - sum(mass[e] for e in held)
        if story is not None:
            if own and own >= np.median([mass[e] for e in held]):
                aside.update(held)
            continue
        largest = max(own, *(mass[e] for e in held))
        small = [e for e in held if mass[e] < SMALL * largest]
        if largest >= sum(mass[e] for e in small):
            aside.update(e for e in small if len(small) > 1 or e.teaser or links[e] >= LINKED * length[e])
    _without(page, aside)


def _masses(page: _Lines, sizes: np.ndarray, content: np.ndarray) -> dict[_Element, float]:
    """Clustered text outside links by element."""
    mass: dict[_Element, float] = {}
    for (_, _, linked, holder), size, chosen in zip(page.lines, sizes, content, strict=True):
        for element in _chain(holder):
            mass[element] = mass.get(element, 0.0) + max(0.0, size - linked) * chosen
    return mass


def _set_aside(page: _Lines) -> None:
    """Drop the lines of elements that are named like no article text, as far as the cluster allows."""
    if not any(holder.named for *_, holder in page.lines):
        return
    sizes, _, _, content = _cluster(page)
    mass = _masses(page, sizes, content)
    most = MOST * mass[page.root]
    regions = [e for e in mass if e.named_region]
    stay = set(_chain(max(regions, key=mass.__getitem__))) if regions else set()
    # Beside an article that lies in no named element, names hold.
    told = {e for e in regions if e.named is None}
    beside = {e for e in mass if told and e.name and e not in stay and told.isdisjoint(_chain(e))}
    aside = {e for e in mass if e.name and e.name not in BESIDE_WORDS and e not in stay and (not mass[e] or mass[e] < most)} | beside

    def outermost(element: _Element) -> _Element | None:
        """The outermost element set aside around this one."""
        found, element = None, element.named
        while element is not None:
            found = element if element in aside else found
            element = element.parent and element.parent.named
        return found

    # A name that most of the text has, in many elements, says nothing on this page.
    of_name: dict[str, float] = {}
    for element in aside - beside:
        if outermost(element) is element:
            of_name[element.name] = of_name.get(element.name, 0.0) + mass[element]
    aside = beside | {e for e in aside if not of_name.get(e.name) or of_name[e.name] < most}

    def kept(holder: _Element, title: bool) -> bool:
        element = holder.named
        while element is not None:
            if element in aside and not (title and element.name == HEADER):
                return False
            element = element.parent and element.parent.named
        return True

    stays = [kept(line[3], title) for line, title in zip(page.lines, page.titles, strict=True)]
    page.lines = [line for line, s in zip(page.lines, stays, strict=True) if s]
    page.titles = [title for title, s in zip(page.titles, stays, strict=True) if s]


def main_text(html: str | None) -> str:
    """The text of a page's article, blocks separated by an empty line."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    page._end_line()
    if not page.lines:
        return ""
    _drop_comments(page)
    _drop_lesser_articles(page)
    _set_aside(page)
    if not page.lines:
        return ""
    sizes, ratios, threshold, content = _cluster(page)
    mass: dict[_Element, float] = {}
    lines: dict[_Element, int] = {}
    for (_, _, _, holder), size, chosen in zip(page.lines, sizes, content, strict=True):
        for element in _chain(holder):
            mass[element] = mass.get(element, 0.0) + size * chosen
            lines[element] = lines.get(element, 0) + 1
    inner = {e for e in mass if e.named_region}
    named = {e for e in inner if mass[e] and inner.isdisjoint(_chain(e.parent))}
    if sum(mass[e] for e in named) < NEARLY_ALL * mass[page.root]:
        named = set()

    def around(element: _Element | None, least: float) -> _Element:
        """The lowest element around this one that holds so much of the cluster and several lines, or the root."""
        for outer in _chain(element):
            if mass[outer] >= least and lines[outer] > 1:
                return outer
        return page.root

    regions = named
    if not named:
        # Sizes are whole numbers, so their sums are exact.
        region = around(page.lines[int(np.argmax(content))][3], mass[page.root])
        inside = [k for k, line in enumerate(page.lines) if region in _chain(line[3])]
        titles = [k for k, line in enumerate(page.lines) if any(e.tag in TITLES for e in _chain(line[3]))]
        before = [k for k in titles if k < inside[0]]
        if before and not any(inside[0] <= k <= inside[-1] for k in titles):
            holders = set(_chain(page.lines[before[-1]][3]))
            region = next(e for e in _chain(region) if e in holders)
        regions = {region}
    chosen = [k for k, line in enumerate(page.lines) if not regions.isdisjoint(_chain(line[3]))]
    if not named:
        # Without an article element, lists of links before and after the text are menus.
        def menu(k: int) -> bool:
            return ratios[k] < threshold and page.lines[k][2] > 0.5 * sizes[k]

        while chosen and menu(chosen[0]):
            chosen.pop(0)
        while chosen and menu(chosen[-1]):
            chosen.pop()
    return "\n\n".join(page.lines[k][0] for k in chosen)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``page_id`` and ``url`` of every page with its main text and that text's length."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page.as_py()) for page in column(batch, "html")]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "page_id"), column(batch, "url"), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", F.col(f"`{html}`").alias("html"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long"
    return rows.mapInArrow(texts, schema)
