"""Main text of web pages by tag-path ratios.

Every piece of text hangs on the path of block elements from the root to it. Over all pieces of a path,
text length, punctuation for each piece, and the share of linked text tell prose from menus. These
ratios are fused with what the names along the path say, smoothed over neighbouring pieces in page
order, and averaged by path again. The scores choose the container, the part of the page that holds most
of what scores: the whole article or main part, if it lies in one. In it the paths whose score reaches a
share of the best one are content. A path scores by its text as a whole, so that long lists and tables stand; a
name that speaks of clutter shifts the score by a factor, so that its path falls below the threshold unless nothing
better is there; and a path of links stands only where a heading introduces it. Paths decide, so a linked
paragraph stands or falls with its siblings.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_arrow, slices

#: Share of a content path's text that is no links, at least; share of the score that leads to its container.
LEAST_FREE, MOST_OF = 0.5, 0.6
#: Share of the best path's score that content has, at least.
LEAST_SCORE = 0.04
#: Factors of names that speak of clutter, and of those that may mean something else on a paragraph of prose.
CLUTTER, DOUBT = 0.03, 0.5
#: Characters of a piece of such prose, on average.
PROSE = 80
#: Weights of a piece and its neighbours in page order.
KERNEL = (0.1, 0.2, 0.4, 0.2, 0.1)

_RAW = "script|style|noscript|template|iframe|svg|textarea|select|object|canvas|title|math|xmp|noembed|noframes"
_TAG = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)
    |<(?:{_RAW})(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>
    |</?([a-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |</?([a-z][^\s/>]*+)([^>]*+)(?:>|\Z)|</[^>]*+(?:>|\Z)""",
    re.I | re.S | re.X,
)
_RAW_NAME = re.compile(rf"<({_RAW})(?=[\s/>])", re.I)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _set(text: str) -> frozenset[str]:
    return frozenset(text.split())


_VOID = _set("area base basefont bgsound br col embed frame hr img input link meta param source track wbr")
_INLINE = _set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var"
)
#: Elements that a start tag of the same group ends, up to the nearest of the second set.
_CLOSES = {
    **dict.fromkeys(("li",), (_set("li"), _set("ul ol menu"))),
    **dict.fromkeys(("dt", "dd"), (_set("dt dd"), _set("dl"))),
    **dict.fromkeys(("td", "th"), (_set("td th"), _set("tr table"))),
    **dict.fromkeys(("tr",), (_set("tr td th"), _set("table tbody thead tfoot"))),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (_set("tbody thead tfoot tr td th"), _set("table"))),
    **dict.fromkeys(("option", "optgroup"), (_set("option"), _set("select"))),
}
#: What text is never content in, by element, and by word in class, id or role.
_NEVER = _set("nav aside footer form button label head menu dialog fieldset input select option legend audio video")
_HEADER = _set("header banner masthead")
_WORDS = _set(
    "ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo promos promotion promoted "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc "
    "sidebar side sidecol topbar bottombar foot banner aside complementary rail related recommended recommendations teaser teasers widget widgets "
    "footer contentinfo copyright legal disclaimer imprint "
    "cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay dialog toast "
    "comment comments commentlist respond reply replies disqus discussion "
    "share sharing social subscribe subscription newsletter signup login search form toolbar skip hidden"
)
#: Beginnings of such words, for names written in one, and words that turn their sense.
_STARTS = ("advert", "cookie", "sidebar", "sidenav", "footer", "navig", "newsletter", "sponsor", "subscri", "breadcrumb", "commentl", "commentb")
_TURNS = _set("has with no without")
#: Those of the words that are common in names of paragraphs and posts, too.
_DOUBTFUL = _set(
    "notice notices alert alerts reply replies respond discussion legal disclaimer side rail social search share related recommended "
    "foot banner form login signup toolbar widget toc comment legal skip modal toast"
)
#: Elements of text rather than of layout.
_TEXTUAL = _set("p blockquote pre li dd dt td th figure figcaption details summary address h1 h2 h3 h4 h5 h6")
#: What a heading over links to other pages of the site says.
_ELSEWHERE = _set("related more recommended popular latest trending next stories read")
_HEADINGS = _set("h1 h2 h3 h4 h5 h6")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")
#: Elements that hold blocks rather than text of their own; only these can be the container of the content.
_CONTAINERS = _set("html body main article section div center form table tbody tr td")
_WHOLE, _CELLS = ("article", "main"), _set("table tbody tr td")
_HIDDEN_INPUT = re.compile(r"""(?:^|\s)type\s*=\s*["']?hidden""", re.I)
_SENTENCE_END = re.compile(r"[.!?…](?=\s|$)|[。！？]")


class Element(NamedTuple):
    name: str
    #: Number of the path from the root to it.
    path: int
    #: Factor of text in it: 0 if it is never content, less than 1 if names speak of clutter.
    prior: float
    #: Whether it lies in an article or the main part.
    inside: bool
    #: Number of the outermost element that rules text in it out by its name, or 0.
    ruled: int


class Piece(NamedTuple):
    """A run of text without a block border in it, and the path it hangs on."""

    path: int
    prior: float
    text: str
    linked: int
    ruled: int


class Page(NamedTuple):
    """The pieces of a page in order. Paths by number: the path above (path 0 is the root) and the last element."""

    pieces: list[Piece]
    above: list[int]
    names: list[str]
    #: The name of each element that rules text out by its name, from 1, and the visible controls in each outermost one.
    ruling: list[str]
    controls: dict[int, int]


class _Paths:
    def __init__(self, by_words: bool, lifted: frozenset[int]):
        self.above, self.names, self.ruling = [0], [""], [""]
        self._numbers: dict[tuple[int, str], int] = {}
        self._by_words, self._lifted = by_words, lifted

    def element(self, name: str, rest: str, parent: Element) -> Element:
        words: set[str] = set()
        prior, label, ruled = parent.prior, name, parent.ruled
        if "=" in rest or "hidden" in rest:
            for found in _NAMES.findall(rest):
                words.update(w.lower() for w in _WORD.findall("".join(found)))
            if _HIDDEN.search(rest):
                prior = 0.0
            if words:
                label = f"{name}.{'.'.join(sorted(words))}"
        if name not in ("html", "body"):
            told = words if self._by_words and not words & _TURNS else set()
            if name == "form":
                told = told - {"form"}  # told by the element
            if name not in _WHOLE:
                prior *= self._shift(name, told, parent)
                if prior < DOUBT <= parent.prior and told & _DOUBTFUL and self._doubtful(told):
                    self.ruling.append("?")
                    if len(self.ruling) - 1 in self._lifted:
                        prior = parent.prior
                    else:
                        ruled = ruled or len(self.ruling) - 1
            if name in _NEVER or name in _HEADER and not parent.inside:
                self.ruling.append(name)
                if len(self.ruling) - 1 not in self._lifted:
                    prior, ruled = 0.0, ruled or len(self.ruling) - 1
        number = self._numbers.setdefault((parent.path, label), len(self.names))
        if number == len(self.names):
            self.above.append(parent.path)
            self.names.append(name)
        return Element(name, number, prior, parent.inside or name in _WHOLE, ruled)


    def _shift(self, name: str, told: set[str], parent: Element) -> float:
        """The factor for the words in an element's names."""
        if told & _HEADER and not parent.inside:
            return CLUTTER
        if not (told & _WORDS or any(w.startswith(_STARTS) for w in told)):
            return 1.0
        return DOUBT if name in _TEXTUAL and self._doubtful(told) else CLUTTER

    @staticmethod
    def _doubtful(told: set[str]) -> bool:
        return not told & (_WORDS - _DOUBTFUL) and not any(w.startswith(_STARTS) for w in told)


def parse(page: str, by_words: bool = True, lifted: frozenset[int] = frozenset()) -> Page:
    """The texts of a page with their paths. Markup may be broken anywhere.

    ``by_words``: whether classes, ids and roles count, besides elements, in what is never content.
    ``lifted``: numbers of elements that do not rule text out although others of their name do.
    """
    out: list[Piece] = []
    paths = _Paths(by_words, lifted)
    stack = [Element("", 0, 1.0, False, 0)]
    controls: dict[int, int] = {}
    held: list[str] = []
    linked, in_link, at = 0, False, 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(html_lib.unescape("".join(held)).split())
            if text:
                out.append(Piece(stack[-1].path, stack[-1].prior, text, min(linked, len(text)), stack[-1].ruled))
            held.clear()
        linked = 0

    n = len(page)
    while at < n:
        tag = _TAG.search(page, at)
        if tag is None:
            held.append(page[at:])
            break
        start, end = tag.span()
        if start > at:
            held.append(page[at:start])
            if in_link:
                linked += start - at
        at = end
        raw = _RAW_NAME.match(page, start)
        if raw:
            if raw[1].lower() in ("select", "textarea"):
                controls[stack[-1].ruled] = controls.get(stack[-1].ruled, 0) + 1
            close = re.compile(rf"</{raw[1]}(?=[\s/>])[^>]*>?", re.I).search(page, end)
            at = close.end() if close else n
            continue
        name = (tag[1] or tag[3] or "").lower()
        if not name:
            continue
        rest = tag[2] or tag[4] or ""
        if page[start + 1] != "/" and (name == "button" or name == "input" and not _HIDDEN_INPUT.search(rest)):
            controls[stack[-1].ruled] = controls.get(stack[-1].ruled, 0) + 1
        if page[start + 1] == "/":
            if name == "a":
                in_link = False
            if name in _INLINE and stack[-1].name != name:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    flush()
                    del stack[k:]
                    break
            else:
                if name == "p":
                    flush()
        elif name == "br":
            held.append(" ")
        elif name in _VOID:
            if name == "hr":
                flush()
        elif name in _INLINE:
            in_link = in_link or name == "a"
            if "=" in rest or "hidden" in rest:
                own = paths.element(name, rest, stack[-1])
                if own.prior < stack[-1].prior:  # an advert or notice in a line of text
                    flush()
                    stack.append(own)
        else:
            flush()
            in_link = False
            while len(stack) > 1 and (stack[-1].name in _INLINE or stack[-1].name == "p"):
                stack.pop()  # a block ends the paragraph before it
            if name in _CLOSES:
                ends, within = _CLOSES[name]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name in within:
                        break
                    if stack[k].name in ends:
                        del stack[k:]
                        break
            if name in _HEADINGS and stack[-1].name in _HEADINGS:
                stack.pop()
            stack.append(paths.element(name, rest, stack[-1]))
    flush()
    return Page(out, paths.above, paths.names, paths.ruling, controls)


def _introduced(found: list[Piece], heading: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which pieces of runs of links follow a heading that does not speak of other pages."""
    out, open_ = np.zeros(len(found), bool), False
    for i, piece in enumerate(found):
        if heading[i]:
            open_ = not {w.lower() for w in _WORD.findall(piece.text)} & _ELSEWHERE
        elif not listed[i]:
            open_ = False
        else:
            out[i] = open_
    return out


def _forlorn(heading: np.ndarray, gone: np.ndarray, stays: np.ndarray) -> np.ndarray:
    """Headings over nothing but links that go."""
    out = np.zeros(len(heading), bool)
    for i in np.flatnonzero(heading & stays).tolist():
        k = i + 1
        while k < len(gone) and gone[k]:
            k += 1
        rest = np.flatnonzero(stays[k:])
        out[i] = k > i + 1 and (not len(rest) or heading[k + rest[0]])
    return out


def _content(page: Page) -> list[str]:
    found, n = page.pieces, len(page.names)
    which = np.array([p.path for p in found])
    prior = np.array([p.prior for p in found])
    length = np.array([len(p.text) for p in found], float)
    count = np.maximum(np.bincount(which, minlength=n), 1).astype(float)
    total = np.bincount(which, length, n)
    marks = np.bincount(which, [len(_PUNCTUATION.findall(p.text)) for p in found], n)
    free = 1 - np.bincount(which, [p.linked for p in found], n) / np.maximum(total, 1)
    # A doubtful name counts as one of clutter where there is no prose.
    prose = (total >= PROSE * count) & (marks >= count)
    prior = np.where((prior < 1) & (prior >= CLUTTER) & ~prose[which], np.minimum(prior, CLUTTER), prior)
    # The text of a path as a whole and the punctuation of its pieces, fused; linked text does not count.
    fused = np.log1p(total) * (1 + np.log1p(marks / count)) * free**2
    smooth = np.convolve(np.pad(fused[which] * prior, len(KERNEL) // 2, mode="edge"), KERNEL, "valid")
    score = np.bincount(which, smooth * prior, n) / count * free
    # The container: from the root down as long as one child holds most of what scores.
    mass = score * total
    for i in range(n - 1, 0, -1):
        mass[page.above[i]] += mass[i]
    children: dict[int, list[int]] = {}
    for i in range(1, n):
        children.setdefault(page.above[i], []).append(i)
    box = 0
    while box in children:
        best = max(children[box], key=mass.__getitem__)
        if page.names[best] not in _CONTAINERS or mass[best] < MOST_OF * mass[box]:
            break
        box = best
    if page.names[box] in _CELLS and 2 * score[box] * total[box] > mass[box]:
        while page.names[box] in _CELLS:  # a table of data, not of the page's layout: what stands around it counts
            box = page.above[box]
    # An article or main part counts as a whole.
    up = [box]
    while up[-1]:
        up.append(page.above[up[-1]])
    for name in _WHOLE:
        if name in (here := [page.names[i] for i in up]):
            box = up[len(here) - 1 - here[::-1].index(name)]
            break
    within = np.zeros(n, bool)
    within[box] = True
    for i in range(box + 1, n):
        within[i] = within[page.above[i]]
    heading = np.array([page.names[i] in _HEADINGS for i in which])
    listed = within[which] & (free[which] < LEAST_FREE) & (prior == 1)
    named = _introduced(found, heading, listed)
    whole = np.bincount(which[named], minlength=n) == count
    reached = score >= LEAST_SCORE * score[within].max(initial=0)
    chosen = within & (((free >= LEAST_FREE) & reached) | whole)
    stays = chosen[which] & (prior > 0)
    taken = np.flatnonzero(stays & ~_forlorn(heading, listed & ~stays, stays))
    if not len(taken):
        return []
    # A heading right before the container belongs to it, if it hangs on the way to it.
    way, first = {box}, int(taken[0])
    while box:
        box = page.above[box]
        way.add(box)
    while first and prior[first - 1] > 0 and page.names[which[first - 1]] in _HEADINGS and page.above[which[first - 1]] in way:
        first -= 1
    return [found[i].text for i in [*range(first, int(taken[0])), *taken.tolist()]]


def _wrapper(page: Page, forms_only: bool) -> int:
    """The number of the element that rules out most of the page's text by its name, or 0.

    A form of more controls than sentences is one to fill in, not a wrapper.
    """
    sizes = np.bincount([p.ruled for p in page.pieces], [len(p.text) for p in page.pieces], len(page.ruling))
    if not sizes[1:].size or sizes[1:].max() < MOST_OF * sizes.sum():
        return 0
    k = int(sizes[1:].argmax()) + 1
    sentences = sum(len(_SENTENCE_END.findall(p.text)) for p in page.pieces if p.ruled == k)
    if page.ruling[k] == "?":  # a name that may be that of a post
        return k if sentences > 2 else 0
    if page.ruling[k] != "form":
        return 0 if forms_only else k
    return k if sentences > page.controls.get(k, 0) else 0


def main_text(page: str) -> str:
    """The content pieces joined by a space.

    A form around the page does not rule it out. A page on which words in classes rule out everything is read
    again by its elements alone, and one that is still empty without the elements that hold most of its text.
    """
    lifted: frozenset[int] = frozenset()
    for forms_only in (True, False):
        parsed = parse(page, lifted=lifted)
        while parsed.pieces and (k := _wrapper(parsed, forms_only)):
            lifted |= {k}
            parsed = parse(page, lifted=lifted)
        content = _content(parsed) if parsed.pieces else []
        if not content and parsed.pieces:
            content = _content(parse(page, False, lifted))
        if content or not parsed.pieces:
            break
    return " ".join(content)


def extract_text(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` and ``text``, the main text of every whole page; empty if there is none.

    NULL and empty pages give an empty text. Character references are decoded, white space within a block
    is one space, blocks are joined by one. Other columns are left out, also one called ``text``; equal rows
    give equal rows, an empty table an empty one. No shuffle.
    """
    source = df.select(*keep, F.col(html).alias("_html"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("text", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_html"):
            found = [main_text(page) if page else "" for page in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string())], schema.names)

    return map_arrow(source, run, schema)
