"""Main text of web pages by two-pass block rules.

A page is cut into blocks at its block tags. The first pass decides each block alone: text inside menus, headers,
footers, sidebars, notices, adverts, forms, comments and hidden elements is out, as is text with many links
and, on pages that mark their article, text outside of it; long text with stop words is in, and so is long text that
is not in Latin letters, whose words no list knows. What is short, or long without stop words, is ambiguous. On a page
without any text that is in (one in a language without a list), long text is. In the second pass ambiguous
blocks take the label of the nearest decided blocks, those of the same article before others; an article without
any decided block is kept.

A word in a class or id, unlike a tag, a role or hiding, is a vote that text can outweigh: it does not put out an
element that holds the page's main element, or its articles (of these the ones inside the fewest such elements, so that
comments and teasers that are marked as articles stay out beside them), nor one that holds more than ``OUTWEIGHS``
times the text decided to be in that the rest of the page holds. One that names reader comments stays only where
the rest of the page holds none, and does so on an article too. The headings in an article's own header belong to the
article; what else is in it goes. What cannot stand in a head ends it.

Defined results: NULL or empty html gives an empty text; unclosed tags, comments and scripts end with the page; pages
of any length are read whole, in one pass over their tags; repeated rows get equal results; an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import named

SHORT = 60
MIN_STOP_WORDS = 0.08
MAX_LINKS = 0.33
#: By how much the text of an element outweighs a word of its class or id.
OUTWEIGHS = 2

STOP_WORDS = frozenset(
    """the of and to in is that for it as was with be by on are this from at not or an which you have had but they
    der die das und in zu den von mit ist des dem nicht ein eine auf für sich auch als im es an werden aus
    le la les de et des un une est en que qui dans du pour par sur au pas avec ce il elle ne se plus
    el los las y que del se por con una su para es al lo como más o pero sus no""".split()
)
BLOCK_TAGS = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol option p pre
    section select summary table tbody td tfoot th thead tr ul""".split()
)
OUT_TAGS = frozenset("nav header footer aside form menu button select dialog noscript iframe object svg canvas template head".split())
#: All that a head holds; anything else ends it.
HEAD_TAGS = frozenset("base basefont bgsound link meta title noscript noframes style script template head html".split())
RAW_TAGS = frozenset("script style textarea title xmp noembed noframes".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
MAIN_TAGS = frozenset(("article", "main"))
#: Elements that end an open one of the same kind.
ALIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
OUT_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent
    cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter
    notice notification pager pagination popup promo promoted recommended related reply respond search share sharing
    sidebar signup skip social sponsor sponsored subscribe toolbar widget""".split()
)
#: Those of them that name reader comments.
COMMENT_WORDS = frozenset("comment comments disqus reply respond".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
OWN_WORDS = frozenset("article entry post story content".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_OTHER = re.compile(r"[^\W\d_\u0000-\u024f\u1e00-\u1eff]")
_NAME_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    text: str
    links: int
    out: bool
    article: int


@dataclass
class _State:
    parts: list[str] = field(default_factory=list)
    links: int = 0


@dataclass
class _Open:
    """An open element: tag, whether it or one around it is out in any case, the nearest one that is out by its words,
    article, whether it is the header of an article that is not out."""

    tag: str
    out: bool
    worded: int
    article: int
    title: bool = False


@dataclass
class _Worded:
    """Elements that are out by a word of their class or id, unless excused; 0 stands for none."""

    outer: list[int] = field(default_factory=lambda: [0])
    excused: list[bool] = field(default_factory=lambda: [True])
    comments: list[bool] = field(default_factory=lambda: [False])

    def add(self, outer: int, comments: bool) -> int:
        self.outer.append(outer)
        self.excused.append(False)
        self.comments.append(comments)
        return len(self.outer) - 1

    def weigh(self, found: list[Block], within: list[int]) -> None:
        """Excuses elements whose text outweighs their word, from the outside in."""
        if len(self.outer) == 1:
            return
        own = [0] * len(self.outer)  # text that is in but for words, by the nearest element
        for block, label, element in zip(found, first_pass(found), within):
            if label:
                own[element] += len(block.text)
        inside = list(own)
        for element in range(len(own) - 1, 0, -1):
            inside[self.outer[element]] += inside[element]
        left = inside[0]  # what is in, as far as it is known
        gone = [False] * len(own)
        for element in range(1, len(own)):
            gone[element] = gone[self.outer[element]]
            if gone[element] or self.excused[element]:
                continue
            rest = left - inside[element]
            if rest == 0 and inside[element] or not self.comments[element] and inside[element] > OUTWEIGHS * rest:
                self.excused[element] = True
            else:
                gone[element] = True
                left = rest

    def left(self) -> list[int]:
        """How many each stands in, itself among them, that are not excused."""
        out = [0]
        for outer, excused in zip(self.outer[1:], self.excused[1:]):
            out.append(out[outer] + (not excused))
        return out

    def excuse(self, element: int) -> None:
        """It and those around it."""
        while not self.excused[element]:
            self.excused[element] = True
            element = self.outer[element]


def _is_out(tag: str, attributes: str) -> str:
    """``always``, by its ``words``, by words of ``comments`` or not at all."""
    if tag in OUT_TAGS:
        return "always"
    if not attributes or tag in ("html", "body"):
        return ""
    worded = ""
    for match in _ATTRIBUTE.finditer(attributes):
        name, value = match[1].lower(), (match[2] or "").strip("\"'")
        if name in ("class", "id"):
            words = set(_NAME_WORD.findall(_CAMEL.sub(" ", value).lower()))
            found = words & OUT_WORDS
            if found & COMMENT_WORDS and tag != "main":
                worded = "comments"
            elif found and not (found == {"header"} and words & OWN_WORDS) and tag not in MAIN_TAGS:
                worded = worded or "words"
        elif name == "role" and value.lower() in OUT_ROLES:
            return "always"
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return "always"
        elif name == "style" and "display:none" in value.lower().replace(" ", ""):
            return "always"
    return worded


def blocks(html: str) -> list[Block]:
    """The blocks of a page that hold text, in page order."""
    found: list[Block] = []
    stack: list[_Open] = []
    worded, within = _Worded(), []  # the latter: of each block, the nearest element that is out by its words
    held: list[tuple[int, int, int]] = []  # of each article element: that element, article, blocks before it
    top = _Open("", False, 0, 0)
    opened: dict[str, int] = {}
    state, link_depth, articles, at = _State(), -1, 0, 0

    def close() -> None:
        text = " ".join(unescape("".join(state.parts)).split())
        if text:
            around = stack[-1] if stack else top
            found.append(Block(text, min(state.links, len(text)), around.out, around.article))
            within.append(around.worded)
        state.parts.clear()
        state.links = 0

    def pop_to(tag: str) -> None:
        nonlocal link_depth
        while stack:
            name = stack.pop().tag
            opened[name] -= 1
            if name == tag:
                break
        if len(stack) < link_depth:
            link_depth = -1

    def end_head() -> None:
        if stack and stack[-1].tag == "head":
            close()
            pop_to("head")

    def add(text: str) -> None:
        if text:
            if not text.isspace():
                end_head()
            state.parts.append(text)
            if link_depth >= 0:
                state.links += len(text.strip())

    last = html.rfind(">")
    while True:
        match = _TAG.search(html, at) if at <= last or "<!" in html[at:] else None
        if match is None:
            add(html[at:])
            break
        add(html[at : match.start()])
        at = match.end()
        if match[2] is None:
            continue
        tag, ending = match[2].lower(), bool(match[1])
        if not ending and tag not in HEAD_TAGS:
            if tag == "body" and opened.get("head"):
                close()
                pop_to("head")
            end_head()
        if tag in RAW_TAGS and not ending:
            end = re.compile(f"</{tag}[\\s/>]", re.I).search(html, at)
            if end is None:
                break
            at = html.find(">", end.start()) + 1 or len(html)
        elif tag in ("br", "hr"):
            state.parts.append(" ")
        elif tag == "a":
            link_depth = -1 if ending else len(stack)
        elif tag in VOID_TAGS:
            continue
        elif ending:
            if opened.get(tag):
                close()
                pop_to(tag)
            elif tag in BLOCK_TAGS:
                close()
        elif tag in BLOCK_TAGS or tag in OUT_TAGS or (match[3] and _is_out(tag, match[3])):
            close()
            for alike in ALIKE.get(tag, ()):
                if stack and stack[-1].tag == alike or opened.get(alike) and any(s.tag == alike for s in stack[-3:]):
                    pop_to(alike)
            if tag in BLOCK_TAGS and opened.get("p") and any(s.tag == "p" for s in stack[-8:]):
                pop_to("p")
            around = stack[-1] if stack else top
            why, own = _is_out(tag, match[3]), _Open(tag, around.out, around.worded, around.article)
            if tag in MAIN_TAGS:
                if not own.article:
                    articles += 1
                    own.article = articles
                if tag == "main" and not own.out and why != "always":
                    worded.excuse(own.worded)
                elif not own.out and not why:
                    held.append((own.worded, own.article, len(found)))
            if why == "always":
                own.title = tag == "header" and bool(around.article) and not around.out
                own.out = True
            elif why:
                own.worded = worded.add(own.worded, why == "comments")
            elif around.title:
                own.title, own.out = True, tag not in HEADINGS
            stack.append(own)
            opened[tag] = opened.get(tag, 0) + 1
    close()
    # Articles with a block of their own, inside the fewest elements that are not excused.
    left = worded.left()
    held = [(left[element], element) for element, article, at in held if at < len(found) and found[at].article == article]
    fewest = min(held, default=(0, 0))[0]
    for count, element in held:
        if count == fewest:
            worded.excuse(element)
    worded.weigh(found, within)
    left = worded.left()
    for block, element in zip(found, within):
        block.out = block.out or left[element] > 0
    return found


def _decided(block: Block, marked: bool) -> bool | None:
    """Whether a block belongs to the article, if it alone tells."""
    if block.out or (marked and not block.article):
        return False
    size = len(block.text)
    if block.links > MAX_LINKS * size:
        return False
    other = _OTHER.findall(block.text)
    if 2 * len(other) > size:  # letters beyond Latin; ideographs say more each
        size += sum(c >= "\u2e80" for c in other)
        return True if size >= SHORT else None
    if size < SHORT:
        return False if block.text[0] == "©" else None
    words = [w.strip(".,;:!?()[]\"'#*$%&|<>«»").lower() for w in block.text.split()]
    return True if sum(w in STOP_WORDS for w in words) >= MIN_STOP_WORDS * len(words) else None


def first_pass(found: list[Block]) -> list[bool | None]:
    """For each block whether it belongs to the main text, if it alone, or its length, tells."""
    marked = any(b.article and not b.out for b in found)
    decided = [_decided(b, marked) for b in found]
    if True not in decided:
        return [True if own is None and len(b.text) >= SHORT else own for own, b in zip(decided, found)]
    return decided


def labels(found: list[Block]) -> list[bool]:
    """For each block whether it belongs to the main text."""
    decided = first_pass(found)
    size = len(found)
    # Nearest decided block on either side, in the same article and anywhere: (distance, label).
    near: list[list[tuple[int, bool] | None]] = [[None] * 4 for _ in found]
    for side, order in ((0, range(size)), (2, range(size - 1, -1, -1))):
        last, inside = None, {}
        for i in order:
            if decided[i] is None:
                near[i][side] = inside.get(found[i].article) and (abs(i - inside[found[i].article][0]), inside[found[i].article][1])
                near[i][side + 1] = last and (abs(i - last[0]), last[1])
            else:
                last = (i, decided[i])
                if not found[i].out:
                    inside[found[i].article] = last
    out = []
    for block, own, (before, any_before, after, any_after) in zip(found, decided, near):
        if own is None:
            beside = [x for x in (before, after) if x]
            if not beside and block.article:
                own = True
            else:
                beside = beside or [x for x in (any_before, any_after) if x]
                # The nearer side; of two as near, the one in the text.
                own = min(beside, key=lambda x: (x[0], not x[1]))[1] if beside else True
        out.append(own)
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    found = blocks(html)
    return " ".join(b.text for b, keep in zip(found, labels(found)) if keep)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(*(named(pages, c).alias(c) for c in ("page_id", "url")), named(pages, html).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
