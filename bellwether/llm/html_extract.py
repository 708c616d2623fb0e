"""Operator 3, HTML extraction: two-pass block rules.

A page is cut into blocks at block-level tags.  Pass 1 decides the clear
blocks: good by length and density of stop words, bad by link density or by
their place: inside an element that is never main text (navigation, aside,
form, hidden parts and the like), or one whose name says so.  Pass 2 gives
every other block the label of the nearest decided neighbour in its region;
inside an article, where nothing was decided, it is content.

A name (class, id, role, itemprop, aria-label) says so only as a whole value
or by its head: its last word, or a first word that is nearly always a part
of the page and not of the text (``ad-slot``, ``sidebar-left``).  Names that
begin with a word like ``has`` or ``no`` say nothing, and a name never
decides for an article, a main element, a heading, or anything that holds
the page's main article; all that is left to the density rules.

Defined cases: null and empty html give empty text; unclosed tags are closed
by what encloses them; comments, scripts and styles never reach the text;
character references are decoded; white space in a block becomes one space;
blocks are joined by an empty line; very long pages are read whole; ties
between articles go to the first, ties in distance to main text; repeated
rows are extracted each; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from bellwether.llm.common import map_rows

MIN_LENGTH = 70               # characters of a block that its words alone can decide
MIN_STOP = 0.12               # share of stop words of a good block
MAX_LINKS = 0.5               # share of linked characters of a block outside an article
MAX_LINKS_INSIDE = 0.8        # the same inside an article

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to in a is that it for on with as was are by this be at from or an not but have he you we they "
    "der die das und in zu den mit von ist im nicht ein eine auf für als auch sich des dem er sie es "
    "le la les de des et en un une du que qui est dans pour par sur pas au plus ne avec ce il "
    "el los las y del que se por con una para su al lo como más pero sus".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav "
    "noscript ol optgroup option p pre section select summary svg table tbody td template textarea tfoot th thead "
    "title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BAD_TAGS = frozenset(
    "aside button datalist dialog fieldset footer form head iframe legend menu nav noscript object optgroup option "
    "select svg template canvas audio video".split())
RAW_TAGS = frozenset("script style textarea title xmp noembed noframes".split())
CLOSED_BY = {"p": BLOCK_TAGS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
             "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}}
#: Names that say what an element is wherever they stand first or last, and those that do so only last.
STRONG_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr masthead menu nav navbar navigation newsletter pagination pager popup sidebar sponsored "
    "toolbar".split())
BAD_NAMES = STRONG_NAMES | frozenset(
    "banner disclaimer header login modal notice notices overlay promo promotion promoted recommended related replies "
    "reply respond search share sharing signup skip social sponsor subscribe subscription teaser widget "
    "widgets".split())
SAY_NOTHING = frozenset("has have with is no not non without hide show toggle".split())
MAIN_NAMES = frozenset("article articlebody".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)|([^\s=/>\"']+)")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@dataclass
class Block:
    text: str
    linked: int               # characters inside links
    bad: bool                 # by its place
    inside: bool              # of an article or main element


@dataclass(eq=False)
class Element:
    """An open element: what its tag, its name and the elements around it say."""

    parent: "Element | None"
    tag: str
    bad: bool                 # it or one around it is never main text
    named: bool               # its name says it is not main text
    main: bool                # an article or main element
    inside: bool              # it is, or is inside, such an element
    size: int = 0             # characters of text inside a main element
    holds_main: bool = False  # the page's main article is inside


def bad_name(value: str) -> bool:
    """Does one name say that its element is not main text?"""
    words = [w.lower() for w in _NAME.findall(value)]
    if not words or words[0] in SAY_NOTHING:
        return False
    return "".join(words) in BAD_NAMES or words[-1] in BAD_NAMES or words[0] in STRONG_NAMES


def _place(tag: str, attrs: str, inside: bool) -> tuple[bool, bool, bool]:
    """Is an element bad by its tag and attributes; by its name; does it open the article?"""
    bad = tag in BAD_TAGS or (tag == "header" and not inside)
    named = False
    main = tag in ("article", "main")
    if attrs and not attrs.isspace() and tag not in ("html", "body"):
        values = {}
        for m in _ATTR.finditer(attrs):
            values[(m[1] or m[3]).lower()] = html.unescape((m[2] or "").strip("\"'"))
        if not main and tag not in HEADINGS:
            named = any(bad_name(name) for k in ("class", "id", "role", "itemprop") for name in values.get(k, "").split())
            named = named or bad_name(values.get("aria-label", ""))
        if values.get("role", "").lower() in ("navigation", "banner", "contentinfo", "complementary", "search",
                                              "alert", "dialog"):
            bad = True
        if "hidden" in values or values.get("aria-hidden", "").lower() == "true" \
                or _HIDDEN.search(values.get("style", "").lower()):
            bad = True
        main = main or values.get("role", "").lower() == "main" or "articlebody" in values.get("itemprop", "").lower() \
            or bool({v.lower() for v in values.get("class", "").split()} & MAIN_NAMES)
    return bad, named and not main, main


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, with their place."""
    root = Element(None, "", False, False, False, False)
    found: list[tuple[str, int, Element]] = []     # text, linked characters, element
    mains: list[Element] = []
    stack: list[Element] = []
    parts: list[str] = []
    linked = 0
    links = 0                                      # open links

    def here() -> Element:
        return stack[-1] if stack else root

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                at = here()
                found.append((text, linked, at))
                if at.inside and not at.bad:
                    while not at.main:
                        at = at.parent
                    at.size += len(text)
            parts.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal links
        for e in stack[to:]:
            links -= e.tag == "a"
        del stack[to:]

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        end = m.start() if m else n
        if end > at:
            text = html.unescape(page[at:end])
            parts.append(text)
            if links:
                linked += len("".join(text.split()))
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    pop(k)
                    break
            continue
        if stack and tag in CLOSED_BY.get(stack[-1].tag, ()):
            pop(len(stack) - 1)
        elif tag in BLOCK_TAGS:                    # an open paragraph ends at a block, whatever is open in it
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == "p":
                    pop(k)
                    break
                if stack[k].tag in BLOCK_TAGS:
                    break
        if tag in VOID_TAGS:
            continue
        if tag in RAW_TAGS:
            close = re.compile(f"</{tag}[\\s/>]", re.I).search(page, at)
            at = close.start() if close else n
            if close:
                at = page.find(">", at) + 1 or n
            continue
        around = here()
        bad, named, main = _place(tag, m[3] or "", around.inside)
        if tag == "a":
            if links:
                for e in reversed(stack):
                    if e.tag == "a":
                        links -= 1
                        e.tag = ""
                        break
            links += 1
        if not (m[3] or "").rstrip().endswith("/") or tag in BLOCK_TAGS:
            element = Element(around, tag, around.bad or bad, named, main, around.inside or main)
            stack.append(element)
            if main:
                mains.append(element)
        elif tag == "a":
            links -= 1
    flush()
    return _settle(found, mains)


def _settle(found: list[tuple[str, int, Element]], mains: list[Element]) -> list[Block]:
    """The blocks, once it is known which article is the page's main one (that with the most text)."""
    for e in reversed(mains):                      # what is in an inner article is in the outer one too
        up = e.parent
        while up is not None and not up.main:
            up = up.parent
        if up is not None and not e.bad:
            up.size += e.size
    best = max((e for e in mains if not e.bad), key=lambda e: e.size, default=None)
    while best is not None:
        best.holds_main = True
        best = best.parent
    bad: dict[int, bool] = {}

    def is_bad(e: Element | None) -> bool:
        chain = []
        while e is not None and id(e) not in bad:
            chain.append(e)
            e = e.parent
        held = bad[id(e)] if e is not None else False
        for e in reversed(chain):
            held = bad[id(e)] = held or e.bad or (e.named and not e.holds_main)
        return held

    return [Block(text, linked, is_bad(e), e.inside) for text, linked, e in found]


def label(found: list[Block]) -> list[bool]:
    """Is each block main text?  Pass 1 decides the clear ones, pass 2 the others."""
    first: list[bool | None] = []
    for b in found:
        size = len(b.text)
        density = b.linked / max(len(b.text.replace(" ", "")), 1)
        notice = b.text.startswith("©") and not b.inside and size < MIN_LENGTH      # a copyright line outside an article
        if b.bad or notice or density > (MAX_LINKS_INSIDE if b.inside else MAX_LINKS):
            first.append(False)
        elif size >= MIN_LENGTH:
            words = b.text.lower().split()
            stop = sum(w.strip(".,;:!?()") in STOP_WORDS for w in words) / len(words)
            first.append(True if stop >= MIN_STOP else None)
        else:
            first.append(None)
    has_main = any(b.inside and not b.bad for b in found)
    any_good = any(first)
    before, after = _nearest(found, first, 1), _nearest(found, first, -1)
    out: list[bool] = []
    for i, (b, x) in enumerate(zip(found, first)):
        if x is None:
            near = [(abs(k - i), not first[k]) for k in (before[i], after[i]) if k is not None]
            if near:
                x = not min(near)[1]                       # at equal distance good wins
            else:
                x = b.inside or not (has_main or any_good)
        out.append(bool(x) and (b.inside or not has_main))
    return out


def _nearest(found: list[Block], first: list[bool | None], step: int) -> list[int | None]:
    """For each block the last block before it (step 1) or after it (-1) that its text decided, in its region."""
    out: list[int | None] = [None] * len(found)
    last: dict[bool, int] = {}
    for i in range(len(found))[::step]:
        out[i] = last.get(found[i].inside)
        if first[i] is not None and not found[i].bad:
            last[found[i].inside] = i
    return out


def main_text(page: str | None) -> str:
    """Main text of a page."""
    if not page:
        return ""
    found = blocks(page)
    return "\n\n".join(b.text for b, keep in zip(found, label(found)) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    slim = pages.select("page_id", "url", "html")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(x.as_py()) for x in batch.column(2)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = slim.schema["page_id"].dataType.simpleString()
    return map_rows(slim, run, f"page_id {kind}, url string, text string, n_chars long")


def query(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The result of the contract."""
    return extract(pages)
