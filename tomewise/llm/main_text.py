"""Main text of HTML pages by the distribution of text over lines.

A page is cut into tags and text.  Markup, scripts, styles, forms and other
elements without prose are dropped with all they hold, and so is what its tag,
role, class or id names as menu, header, footer, sidebar, notice, advert or
comments.  What is left is laid out as lines, one per block element, and a
dropped element leaves a blank line.  Text lengths (link text does not count)
are summed over a sliding window of lines; a surge point is where the sum
first reaches ``rise``, a dive point where it falls to nothing.  The lines
between a surge and its dive show where the article is: if one container holds
nearly all of their text, it is kept whole, with its short lines, else the
lines themselves without the rests of menus at their ends.  In a page that marks
its article the ranges are found over all its lines in the same way; a mark that
holds most of their text (of the page's, if there are none) trims them to its own lines and extends them to its first
and last line.

Blocks are joined by one newline in page order; white space in a block becomes
one space; character references are decoded.  Defined results: a null page is
empty, a page without a surge gives all lines that are not mere links, a page
that would lose an article's length and most of its text by the names of its
elements keeps what these elements hold (comments longer than an article are
no such case), one that would lose all its text by names is cut by tags alone, a page
without text gives the empty text; an element left open ends with its parent;
repeated rows give repeated results; added columns replace columns of the same
name, all others are kept.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tomewise.llm.batches import clashes, numbered, quoted, schema_of

WINDOW_LINES = 3
RISE_CHARS = 80
# Share of a line's characters inside links from which on it counts as links.
LINK_SHARE = 0.5
# In a page without an article mark, shorter lines that do not end like a
# sentence are cut off a kept range's ends.
EDGE_CHARS = 40
MISNAMED_CHARS = 250  # text that fell to names, from which on the names are not believed if it is most of the page's
CONTAINER_SHARE = 0.9  # of the kept ranges' text, for a container to be the article
SENTENCE_ENDS = tuple(".!?…:;\"'”’»)。！？")

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>?""", re.S)
ATTRIBUTE = re.compile(r"""([A-Za-z_:@][^\s=/>"']*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")

VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("script style noscript template svg math iframe object embed canvas audio video map form button "
                    "select textarea input head title nav footer aside dialog menu noembed noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search "
                  "section summary table caption tbody td tfoot th thead tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
SECTION = frozenset("article aside body div footer header html main nav section table td th tr ul ol dl blockquote "
                    "form figure".split())
# A start tag ends an open element of these kinds up to the next section.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar "
                  "toolbar".split())
# Words of a class or id that name something beside the article.
NAMED = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored
    sponsors promo promos promotion banner banners cookie cookies consent gdpr notice notices notification
    notifications disclaimer alert newsletter subscribe subscription signup signin login register paywall sidebar
    sidebars sidenav aside rail menu menus navbar nav navigation topnav topbar toolbar breadcrumb breadcrumbs footer
    footnav colophon copyright legal masthead comment comments commentlist commentary disqus replies reply responses
    respond feedback discussion share sharing shares social follow related recommended recommendations
    popular trending more-stories popup modal overlay lightbox pagination pager widget widgets search searchbar
    promoted outbrain taboola adsbygoogle adbox adslot adunit adbanner skip skiplink""".split())
# Words of comments, which may well be longer than their article.
COMMENTS = frozenset("comment comments commentlist commentary disqus replies reply responses respond".split())
HEADERS = frozenset(("header", "masthead"))
OF_ARTICLE = frozenset(("article", "post", "entry", "content", "story", "title"))
CONTAINERS = frozenset(("div", "section", "td", "center"))
ARTICLES = frozenset(("article", "articlebody", "maincontent", "postcontent", "entrycontent", "storybody"))


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)} if raw else {}


def _words(names: str) -> set[str]:
    """The words of class names or ids: ``sideBar-left ads`` -> side, bar,
    sidebar, left, ads."""
    out = set()
    for name in names.split():
        if re.match(r"(?:has|with|no|without|layout)[-_]", name, re.I):
            continue  # tells of a page that it has a sidebar, say
        parts = re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+", name)
        out.update(p.lower() for p in re.split(r"[-_:.\d]+", name))
        out.update(p.lower() for p in parts)
        out.add(re.sub(r"[-_]", "", name).lower())
    return out


def _beside(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is something beside the article by its tag, role or style."""
    if tag in DROPPED:
        return True
    if tag in ("html", "body", "main"):
        return False
    if tag == "header" and not in_article:
        return True
    if not attributes:
        return False
    if ("hidden" in attributes or attributes.get("aria-hidden") == "true"
            or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""))):
        return True
    role = attributes.get("role", "").lower()
    return bool(role) and role in ROLES and not (role == "banner" and in_article)


def _beside_by_name(tag: str, attributes: dict[str, str], in_article: bool) -> set[str]:
    """The words of an element's class and id if they name something beside
    the article, else nothing."""
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    if tag in ("html", "body", "main") or not names.strip():
        return set()
    words = _words(names)
    if words & NAMED and not (tag == "article" and not words & {"comment", "comments", "related", "ad", "promo"}):
        return words
    named = not in_article and words & HEADERS and not words & OF_ARTICLE and tag not in HEADING
    return words if named else set()


def _marks_article(tag: str, attributes: dict[str, str]) -> bool:
    if tag in ("article", "main") or attributes.get("role", "").lower() in ("main", "article"):
        return True
    if "articlebody" in attributes.get("itemprop", "").lower():
        return True
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    return any(re.sub(r"[-_]", "", n).lower() in ARTICLES for n in names.split())


class _Element:
    __slots__ = ("tag", "dropped", "depth", "link", "path", "beside", "name")

    def __init__(self, tag: str, dropped: bool, depth: int, link: bool, path: tuple, beside: bool = False, name=None):
        self.tag, self.dropped, self.depth, self.link, self.path = tag, dropped, depth, link, path
        self.beside, self.name = beside, name


class _Named:
    """An element that its names put beside the article, with its unlinked text."""

    __slots__ = ("number", "comments", "outermost", "chars")

    def __init__(self, number: int, comments: bool, outermost: bool, chars: int):
        self.number, self.comments, self.outermost, self.chars = number, comments, outermost, chars


class Lines:
    """The lines of a page: text, characters outside links, the rank of the
    article mark they stand under (0: none, 1: main, 2: article), the level of
    a heading (0: none) and the innermost container, as a chain (number,
    chain of the outer ones).  Classes and ids count only ``by_name`` and not
    for the elements with the numbers ``believed_not``."""

    def __init__(self, page: str, by_name: bool = True, believed_not: frozenset[int] = frozenset()):
        self.text: list[str] = []
        self.plain: list[int] = []
        self.rank: list[int] = []
        self.heading: list[int] = []
        self.path: list[tuple] = []
        self._containers = 0
        self._by_name = by_name
        self._believed_not = believed_not
        self._elements = 0
        self.chars = 0  # unlinked text, with that of the named elements
        self.named: list[_Named] = []
        self._buffer: list[str] = []
        self._linked = 0
        self._stack: list[_Element] = [_Element("", False, 0, False, ())]
        self._scan(page)
        self._count(self._stack)
        self._flush()

    def _flush(self, blank: bool = False) -> None:
        text = " ".join("".join(self._buffer).split())
        self._buffer.clear()
        if text or blank:
            self.text.append(text)
            linked = min(self._linked, len(text))
            self.plain.append(len(text) - linked if linked < LINK_SHARE * len(text) else 0)
            self.rank.append(self._stack[-1].depth)
            self.path.append(self._stack[-1].path)
            self.heading.append(next((int(e.tag[1]) for e in self._stack[-3:] if e.tag in HEADING), 0))
        self._linked = 0

    def _text(self, raw: str) -> None:
        top = self._stack[-1]
        if not (top.beside or top.link):
            self.chars += len(raw.strip())
        if raw and not top.dropped:
            text = html.unescape(raw) if "&" in raw else raw
            self._buffer.append(text)
            if top.link:
                self._linked += len(text)

    def _count(self, gone: list[_Element]) -> None:
        """The text of named elements that end."""
        for e in gone:
            if e.name is not None:
                e.name.chars += self.chars

    def _close(self, index: int) -> None:
        """Ends the element at ``index`` and all that stand in it."""
        gone = self._stack[index:]
        self._count(gone)
        if any(e.tag in BLOCK for e in gone):
            self._flush()
        del self._stack[index:]
        if gone[0].dropped and not self._stack[-1].dropped and gone[0].tag in BLOCK:
            self._flush(blank=True)

    def _end(self, tag: str) -> None:
        for index in range(len(self._stack) - 1, 0, -1):
            own = self._stack[index].tag
            if own == tag:
                if tag in BLOCK:
                    self._close(index)
                elif self._stack[index].dropped or not any(e.tag in BLOCK for e in self._stack[index:]):
                    self._close(index)
                else:  # a formatting element ends, blocks opened in it go on
                    self._count(self._stack[index:index + 1])
                    del self._stack[index]
                return
            if own in SECTION and tag not in SECTION:
                return

    def _start(self, tag: str, raw: str) -> None:
        if tag in BLOCK:
            for index in range(len(self._stack) - 1, 0, -1):  # a block ends an open paragraph
                if self._stack[index].tag == "p":
                    self._close(index)
                    break
                if self._stack[index].tag in SECTION:
                    break
        if tag in ENDS:
            for index in range(len(self._stack) - 1, 0, -1):
                own = self._stack[index].tag
                if own in ENDS[tag]:
                    self._close(index)
                    if tag != "tr" or own == "tr":
                        break
                elif own in SECTION:
                    break
        if tag == "br":
            self._text(" ")
        if tag in BLOCK:
            self._flush()
        if tag in VOID:
            return
        top = self._stack[-1]
        attributes = _attributes(raw)
        self._elements += 1
        beside, name = top.beside or _beside(tag, attributes, top.depth > 0), None
        if self._by_name and attributes and not beside and self._elements not in self._believed_not:
            words = _beside_by_name(tag, attributes, top.depth > 0)
            if words:
                name = _Named(self._elements, bool(words & COMMENTS), not top.dropped, -self.chars)
                self.named.append(name)
        dropped = top.dropped or beside or name is not None
        depth = top.depth
        if not beside and name is None and _marks_article(tag, attributes):
            depth = max(depth, 1 if tag == "main" or attributes.get("role") == "main" else 2)
        path = top.path
        if tag in CONTAINERS:
            self._containers += 1
            path = (self._containers, path)
        self._stack.append(_Element(tag, dropped, depth, top.link or tag == "a", path, beside, name))

    def _scan(self, page: str) -> None:
        at = 0
        while True:
            m = TOKEN.search(page, at)
            if m is None:
                self._text(page[at:])
                return
            self._text(page[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
                continue
            if tag == "plaintext":
                self._text(page[at:])
                return
            closed = m[3].endswith("/")
            self._start(tag, m[3])
            if tag in RAW and not closed:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                self._end(tag)
                if end is None:
                    return
                at = end.end()
            elif closed and tag not in VOID and tag in ("svg", "math"):
                self._end(tag)


def spans(lengths: list[int], window: int, rise: int) -> list[tuple[int, int]]:
    """The line ranges between surge and dive points."""
    n = len(lengths)
    if not n:
        return []
    sums = np.convolve(np.array(lengths, np.int64), np.ones(window, np.int64))[window - 1:]  # sum from each line on
    out, at = [], 0
    while at < n:
        if sums[at] < rise:
            at += 1
            continue
        surge = at
        while at < n and sums[at] > 0:
            at += 1
        lines = [i for i in range(surge, at) if lengths[i]]
        out.append((lines[0], lines[-1] + 1))
    return out


def _edge(lines: Lines, i: int) -> bool:
    """Whether a line at a surge or dive is no sentence: a menu's or footer's rest."""
    text = lines.text[i]
    return not lines.heading[i] and len(text) < EDGE_CHARS and not text.endswith(SENTENCE_ENDS)


def _kept(lines: Lines, window: int, rise: int) -> list[int]:
    ranges = spans(lines.plain, window, rise)
    found = [i for a, b in ranges for i in range(a, b)] or range(len(lines.plain))
    total = sum(lines.plain[i] for i in found)
    for rank in (2, 1):
        inside = [i for i, r in enumerate(lines.rank) if r >= rank and lines.text[i]]
        if 2 * sum(lines.plain[i] for i in found if lines.rank[i] >= rank) > total:
            # the title may stand before the mark
            return [i for i in range(inside[0]) if lines.heading[i] == 1 and lines.plain[i]] + inside
    container = _container(lines, [i for a, b in ranges for i in range(a, b)])
    if container is not None:
        return [i for i, path in enumerate(lines.path) if container in _chain(path)]
    keep: list[int] = []
    for a, b in ranges:
        while a < b - 1 and _edge(lines, a):
            a += 1
        while a < b - 1 and _edge(lines, b - 1):
            b -= 1
        keep += range(a, b)
    return keep or [i for i, n in enumerate(lines.plain) if n]


def _chain(path: tuple) -> list[int]:
    out = []
    while path:
        out.append(path[0])
        path = path[1]
    return out


def _container(lines: Lines, kept: list[int]) -> int | None:
    """The innermost container of several lines that holds nearly all the text
    of the kept lines, if there is one."""
    size: dict[int, int] = {}
    count: dict[int, int] = {}
    depth: dict[int, int] = {}
    for i in kept:
        chain = _chain(lines.path[i])
        for k, c in enumerate(reversed(chain)):
            size[c] = size.get(c, 0) + lines.plain[i]
            count[c] = count.get(c, 0) + bool(lines.text[i])
            depth[c] = k
    total = sum(lines.plain[i] for i in kept)
    fit = [c for c, n in size.items() if n >= CONTAINER_SHARE * total and count[c] > 1]
    return max(fit, key=depth.__getitem__, default=None)


def _misnamed(lines: Lines, window: int, rise: int) -> frozenset[int]:
    """The numbers of the elements whose names are not believed: one that holds
    an article's length and most of the page's text, comments only if no surge
    is left without them; or else all but comments, if together they do and
    less than an article's length is left."""
    def most(chars: int) -> bool:
        return chars >= MISNAMED_CHARS and 2 * chars > lines.chars

    if not most(sum(e.chars for e in lines.named if e.outermost)):
        return frozenset()
    left = bool(spans(lines.plain, window, rise))
    one = frozenset(e.number for e in lines.named if most(e.chars) and not (e.comments and left))
    if one or sum(lines.plain) >= MISNAMED_CHARS:
        return one
    if most(sum(e.chars for e in lines.named if e.outermost and not e.comments)):
        return frozenset(e.number for e in lines.named if not e.comments)
    return frozenset()


def main_text(page: str | None, window: int = WINDOW_LINES, rise: int = RISE_CHARS) -> str:
    """The article of a page, a line per block."""
    for by_name in (True, False) if page else ():
        lines = Lines(page, by_name)
        misnamed = _misnamed(lines, window, rise)
        if misnamed:
            lines = Lines(page, by_name, misnamed)
        text = "\n".join(lines.text[i] for i in _kept(lines, window, rise) if lines.text[i])
        if text and (by_name or len(text) >= MISNAMED_CHARS):
            return text
    return ""


def extract(df: DataFrame, html_col: str = "html", text_col: str = "text", window: int = WINDOW_LINES,
            rise: int = RISE_CHARS, keep: list[str] | None = None) -> DataFrame:
    """``df`` with the main text of its pages and ``n_chars``, its code
    points; ``keep`` names the columns to carry along (default: all)."""
    added = [text_col, "n_chars"]
    keep = clashes(df.select(*map(quoted, keep)) if keep is not None else df, added)
    schema = schema_of(df, keep, [T.StructField(text_col, T.StringType(), False),
                                  T.StructField("n_chars", T.LongType(), False)])
    needed = list(dict.fromkeys([*keep, html_col]))
    at, kept = needed.index(html_col), [needed.index(c) for c in keep]

    def run(batches):
        for batch in batches:
            texts = [main_text(p, window, rise) for p in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in kept]
                + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*keep, *added])

    return numbered(df, needed).mapInArrow(run, schema)
