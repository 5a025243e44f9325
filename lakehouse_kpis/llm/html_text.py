"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text blocks, each with the path of block elements from the root to
it. Text length and punctuation are summed by path: content paths have long, punctuated blocks, menus
and notices short ones without. The two ratios are fused, smoothed along the page, averaged by path,
and the paths above the spread of the scores are content. The element that holds the chosen paths
then gives whole blocks, so that a short paragraph or a heading of an article is not lost. What its
own markup declares to be something else (navigation, adverts, scripts, comments) takes no part; a
form does if it wraps the content of its page.

Paths are numbers of a tree whose parents have smaller numbers than their children, so a page costs
time and memory by its length, however deep it nests.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.llm.tables import text_batches

# Element names of the HTML standard, by what they mean here.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav noscript ol optgroup option p pre search section select summary table tbody td "
    "template textarea tfoot th thead title tr ul".split()
)
NOT_TEXT = frozenset(
    "aside audio button canvas datalist dialog footer head header iframe math menu nav "
    "noscript object search script select style svg template textarea title video".split()
)
RAW = frozenset("script style textarea title iframe noframes xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(["article", "main"])
# An opening tag ends an open element of the second set that no element of the third lies above.
_ENDS = {
    **{t: (frozenset(["p"]), BLOCK - {"p"}) for t in BLOCK},
    "li": (frozenset(["li", "p"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd p".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd p".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th p".split()), frozenset(["table"])),
    "td": (frozenset("td th p".split()), frozenset("table tr".split())),
    "th": (frozenset("td th p".split()), frozenset("table tr".split())),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
}
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search"
    .split()
)
# Words in class names and ids by which pages mark what is not their article.
ASIDE_WORDS = frozenset(
    "ad ads adsense advert advertisement advertisements advertising adverts banner breadcrumb "
    "breadcrumbs comment commentlist comments consent cookie cookies copyright disclaimer disqus "
    "footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice "
    "notices notification notifications pager pagination popup promo promoted promotion promotions "
    "recommended related replies reply respond share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription teaser toolbar topbar widget widgets".split()
)
# Such a word marks an element when it ends the name, or when all words after it are of these, which
# say how a thing is laid out: share-buttons and related-posts, but not share-prices, related-work.
LAYOUT_WORDS = frozenset(
    "area articles author avatar bar block body bottom box button buttons card cards col column "
    "container content count feed field fields footer form group header heading icon icons inner "
    "item items label left line link links list main media meta module outer overlay panel "
    "placeholder post posts region right row section sections slot stories strip tab tabs text "
    "thread tile title top unit wrap wrapper zone".split()
)
# Words before "header" that make it the head of the article, not of the page.
ARTICLE_WORDS = frozenset("article chapter content entry post section story".split())
_PARAGRAPH = frozenset(["p"])
_NEVER_ASIDE = frozenset(["html", "body"])
_NEGATED = frozenset("with without has no".split())
PUNCTUATION = re.compile("[.,;:!?…、。，．！？¿¡]")

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S
)
_WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

SIGMA = 1.0         # of the smoothing, in blocks
HOLDS = 0.85        # share of the chosen text that the content's element must hold
LINKED = 0.8        # share of link text from which a list item is navigation


@dataclass
class Block:
    path: int      # node of the page's tree of paths
    text: str
    linked: int    # characters of it, without white space, in links
    heading: bool
    item: bool     # of a list
    main: int      # path of the outermost main or article element, or 0
    article: bool  # in an article element
    form: int      # path of the outermost form, or 0


@dataclass
class _Open:
    name: str
    path: int
    aside: bool
    main: int
    article: bool
    form: int
    heading: bool
    item: bool


_NOTHING = _Open("", 0, False, 0, False, 0, False, False)


@dataclass
class Page:
    """The open elements, the tree of paths and the blocks so far while a page is read."""

    blocks: list[Block] = field(default_factory=list)
    parents: list[int] = field(default_factory=lambda: [0])  # of each path; 0 is the page
    _paths: dict[tuple[int, str], int] = field(default_factory=dict)
    _stack: list[_Open] = field(default_factory=list)
    _at: dict[str, list[int]] = field(default_factory=dict)  # where elements of a name are open
    _block_at: list[int] = field(default_factory=list)       # where block elements are open
    _parts: list[str] = field(default_factory=list)
    _linked: int = 0

    def text(self, raw: str) -> None:
        if raw and not (self._stack and self._stack[-1].aside):
            shown = html.unescape(raw)
            self._parts.append(shown)
            if self._at.get("a"):
                self._linked += len("".join(shown.split()))

    def flush(self) -> None:
        """End the block that is being gathered."""
        text = " ".join("".join(self._parts).split())
        if text:
            top = self._stack[self._block_at[-1]] if self._block_at else _NOTHING
            self.blocks.append(Block(
                top.path, text, self._linked, top.heading, top.item, top.main, top.article, top.form
            ))
        self._parts, self._linked = [], 0

    def _last(self, names: frozenset[str]) -> int:
        return max((self._at[n][-1] for n in names if self._at.get(n)), default=-1)

    def _end_before(self, name: str) -> None:
        """Leave the elements that an opening tag of this name ends."""
        ends, stop = _ENDS[name]
        if ends == _PARAGRAPH:
            while self._block_at and self._stack[self._block_at[-1]].name == "p":
                self.cut(self._block_at[-1])
            return
        above = self._last(stop)
        at = [bisect_right(self._at[n], above) for n in ends if self._at.get(n)]
        names = [n for n in ends if self._at.get(n)]
        found = [self._at[n][i] for n, i in zip(names, at) if i < len(self._at[n])]
        if found:
            self.cut(min(found))

    def open(self, name: str, rest: str) -> None:
        if name in BLOCK:
            self.flush()
            self._end_before(name)
        if name == "br":
            self._parts.append("\n")
        if name in VOID:
            return
        above = self._stack[-1] if self._stack else _NOTHING
        attributes = _attributes(rest) if rest.strip(" /\n\t\r") else {}
        path, main, form = above.path, above.main, above.form
        # the outermost main or article is the page's content, whatever its class; one inside may be
        # a comment or a teaser
        named = name not in _NEVER_ASIDE and not (name in MAIN and not main)
        aside = above.aside or name in NOT_TEXT or named and _is_aside(name, attributes)
        if name in BLOCK:
            step = (path, ".".join([name, *attributes.get("class", "").split()]))
            path = self._paths.get(step, 0)
            if not path:
                path = self._paths[step] = len(self.parents)
                self.parents.append(step[0])
            if name in MAIN and not main:
                main = path
            if name == "form" and not form:
                form = path
        if aside and not above.aside:
            self.flush()
        for at in [self._at.setdefault(name, []), *([self._block_at] if name in BLOCK else [])]:
            at.append(len(self._stack))
        self._stack.append(_Open(
            name, path, aside, main, above.article or name == "article", form,
            above.heading or name in HEADINGS, above.item or name == "li",
        ))

    def close(self, name: str) -> None:
        if name in BLOCK:
            self.flush()
        if self._at.get(name):
            k = self._at[name][-1]
            # an inline end tag does not reach out of its block
            if name in BLOCK or not self._block_at or k > self._block_at[-1]:
                self.cut(k)

    def cut(self, k: int) -> None:
        """Leave the open elements from the k-th on."""
        if any(o.aside for o in self._stack[k:]):
            # what was gathered inside is not text; what follows is a block of its own
            self.flush()
        for o in self._stack[k:]:
            self._at[o.name].pop()
            if o.name in BLOCK:
                self._block_at.pop()
        del self._stack[k:]


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        value = next((g for g in m.groups()[1:] if g is not None), "")
        found.setdefault(m[1].lower(), html.unescape(value))
    return found


def _is_aside(name: str, attributes: dict[str, str]) -> bool:
    """Whether attributes say that an element is no part of an article's text, or not shown."""
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if _HIDDEN.search(attributes.get("style", "")):
        return True
    if set(attributes.get("role", "").lower().split()) & ROLES:
        return True
    return any(
        _marks([w.lower() for w in _WORD.findall(label)])
        for label in (*attributes.get("class", "").split(), attributes.get("id", ""))
    )


def _marks(words: list[str]) -> bool:
    """Whether the words of a name mark an element that is not article text."""
    for i, word in enumerate(words):
        if word not in ASIDE_WORDS or i and words[i - 1] in _NEGATED:
            continue
        if word == "header" and i and words[i - 1] in ARTICLE_WORDS:
            continue
        if all(w in LAYOUT_WORDS or w in ASIDE_WORDS or w.isdigit() for w in words[i + 1:]):
            return True
    return False


def read_page(page: str) -> Page:
    """Text blocks of a page in order, without those that their markup sets aside."""
    read, at, size = Page(), 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            read.text(page[at:])
            break
        read.text(page[at:m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["end"] or m["end2"]:
            read.close(name)
            continue
        read.open(name, m["rest"] or m["rest2"] or "")
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else size
    read.flush()
    return read


def path_scores(found: list[Block]) -> dict[int, float]:
    """Fused and smoothed ratio of every path: mean text length without links times mean
    punctuation of its blocks, spread over neighbouring blocks, averaged over the path's blocks."""
    sums: dict[int, list[float]] = {}
    for b in found:
        held = sums.setdefault(b.path, [0.0, 0.0, 0])
        held[0] += max(len(b.text) - b.linked, 0)
        held[1] += len(PUNCTUATION.findall(b.text)) + 0.5
        held[2] += 1
    ratio = {p: math.sqrt(length / n * (marks / n)) for p, (length, marks, n) in sums.items()}
    kernel = [math.exp(-0.5 * (d / SIGMA) ** 2) for d in range(-2, 3)]
    scores: dict[int, float] = dict.fromkeys(sums, 0.0)
    for i, b in enumerate(found):
        lo, hi = max(i - 2, 0), min(i + 3, len(found))
        weights = kernel[lo - i + 2:hi - i + 2]
        near = sum(w * ratio[found[j].path] for w, j in zip(weights, range(lo, hi)))
        scores[b.path] += near / sum(weights) / sums[b.path][2]
    return scores


def content(page: Page) -> list[Block]:
    """The blocks of the main text."""
    found = [
        b for b in _outside_forms(page.blocks)
        if b.article or not (b.item and b.linked > LINKED * len("".join(b.text.split())))
    ]
    if not found:
        return []
    scores = path_scores(found)
    each = [scores[b.path] for b in found]
    mean = sum(each) / len(each)
    spread = math.sqrt(sum((v - mean) ** 2 for v in each) / len(each))
    limit = min(spread, max(each))
    chosen = [b for b in found if scores[b.path] >= limit]
    weight = sum(len(b.text) for b in chosen)
    in_main = [b for b in chosen if b.main]
    if sum(len(b.text) for b in in_main) >= 0.5 * weight:
        mains = {b.main for b in in_main}
        return [b for b in found if b.main in mains]
    place, depth = _holder(chosen, weight, page.parents)
    if depth > 2:
        inside = [False] * len(page.parents)
        inside[place] = True
        for path in range(place + 1, len(inside)):
            inside[path] = inside[page.parents[path]]
        return [b for b in found if inside[b.path]]
    at = [i for i, b in enumerate(found) if scores[b.path] >= limit]
    taken = set(at)
    return [
        b for i, b in enumerate(found)
        if i in taken or (b.heading and at[0] - 1 <= i <= at[-1])
    ]


def _outside_forms(found: list[Block]) -> list[Block]:
    """The blocks without those of forms, but with those of a form that wraps the page's content:
    one that holds its main or article element, or more than half of its punctuation."""
    marks: dict[int, int] = {}
    wraps = set()
    for b in found:
        marks[b.form] = marks.get(b.form, 0) + len(PUNCTUATION.findall(b.text))
        if b.form and b.main > b.form:
            wraps.add(b.form)
    every = sum(marks.values())
    wraps |= {form for form, n in marks.items() if 2 * n > every}
    return [b for b in found if not b.form or b.form in wraps]


def _holder(chosen: list[Block], weight: int, parents: list[int]) -> tuple[int, int]:
    """The deepest path under which most of the chosen text lies, and its depth."""
    under = [0] * len(parents)
    for b in chosen:
        under[b.path] += len(b.text)
    depth = [0] * len(parents)
    for path in range(len(parents) - 1, 0, -1):
        under[parents[path]] += under[path]
    for path in range(1, len(parents)):
        depth[path] = depth[parents[path]] + 1
    place = max((p for p, n in enumerate(under) if n >= HOLDS * weight), key=depth.__getitem__)
    return place, depth[place]


def main_text(page: str | None) -> str:
    """Main text of one page: white space inside a block is one space, blocks are joined by one."""
    return " ".join(b.text for b in content(read_page(page or "")))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of `pages`, from its whole html.

    Null html is empty; it and a page without an article give an empty text. A page that breaks off
    is read as far as it goes. Repeated rows and null ids are rows like any other; other columns are
    not looked at; an empty table gives an empty result.
    """
    text_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series(
                [main_text((h or b"").decode("utf-8", "replace")) for h in series], dtype=object
            )

    return pages.select("page_id", "url", text(F.col("html").cast("binary")).alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )
