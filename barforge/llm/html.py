"""Main text of web pages by two passes of rules over their blocks.

A page is cut into blocks at block-level tags. Parts of the page that are no text of
the article (navigation, forms, side columns, notices, comments and the like, by tag,
role, class or id) are left out whole, and so is what stands outside the element that
holds the article, if there is one. A part left out does not take the article with it:
names of the article's own element count little, a wrapper of the only article is none
of these parts, and a form that holds most of the page's prose is a wrapper.

The first pass decides all other blocks by their density of links, their length and their
density of function words; a paragraph of an article needs fewer of these. The second
pass gives short and undecided blocks the label of their nearest decided neighbours within
the same part of the page; where those differ, the nearer one's, and on a tie the block
stays. Within an article, bad neighbours count as further away, and speak only where it
has good blocks.

Character references are decoded, white space within a block becomes one space, and
blocks are joined by a line feed. Nothing else is dropped or cut. A null or empty
page has no text; repeated rows are read each for itself. Tags that are not closed,
or closed without having been opened, are tolerated.
"""

import html as entities
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from barforge.llm.words import FUNCTION_WORDS

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*+)[^>]*+(?:>|\Z)"""
    r"""|<[!?/][^>]*+(?:>|\Z)""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([A-Za-z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

# Tags of HTML by their role here.
RAW = frozenset("script style noscript template iframe object svg head title audio video canvas annotation annotation-xml".split())
UNSEEN = frozenset("script style template annotation annotation-xml".split())  # does not end a block
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr img br
math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt
mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics""".split())
CLOSED_BY_NEXT = frozenset("li dd dt td th tr option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
AWAY = frozenset("nav aside footer form button select textarea fieldset menu dialog datalist".split())
ARTICLE = frozenset("article main".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# Of a class or id, words that name what is no part of an article; the other lists by their beginning and end.
AWAY_WORDS = frozenset("""menu nav navbar navigation header masthead form search share shares sharing social related
recommended recommendations login signup signin register subscribe subscription popup modal overlay notice notices alert
alerts consent gdpr pager pagination toolbar copyright rail tags widget widgets""".split())
AWAY_BEGINNINGS = ("cookie", "breadcrumb", "newsletter", "sidebar", "footer", "promo", "banner")
# Adverts and comments, which are left out also where they are articles or hold one.
FOREIGN_WORDS = frozenset("ad ads adv respond reply replies".split())
FOREIGN_BEGINNINGS = ("advert", "sponsor", "comment", "disqus", "adsense", "adsby", "adslot", "adunit", "adbox")
AWAY_ENDINGS = ("nav", "menu", "sidebar", "footer", "banner", "breadcrumbs")
ARTICLE_NAMES = frozenset("""article post entry story content main article-body article-content articlebody post-body post-content
entry-content main-content story-body""".split())
KEEP_BEFORE = frozenset("has with no without".split())
KEEP_AFTER = frozenset(["free"])

MUCH_LINKED = 0.5  # share of a block's characters within links
SHORT, LONG = 70, 200  # characters
FEW_WORDS, MANY_WORDS = 0.12, 0.25  # share of function words
BAD_FURTHER = 5  # within an article, a bad neighbour counts as so many times as far

KEPT, WRAPS, OUT = 0, 1, 2  # no part to leave out; one, unless it wraps the article; one in any case


@dataclass
class Block:
    """A run of text without block-level tags in between."""

    text: str
    linked: float
    heading: bool
    root: int  # number of the innermost part to leave out that it stands in; 0: none
    part: int  # number of the article element it stands in; 0: outside
    paragraph: bool = False
    away: bool = False  # stands in a part that is left out whole
    good: bool | None = None


@dataclass
class _Part:
    """An element that is left out whole, unless it turns out to wrap the article."""

    around: int  # number of the next such element around it
    kind: int  # WRAPS or OUT
    form: bool
    article: bool = False  # holds an article, by tag or role
    prose: int = 0  # characters of prose


@dataclass
class _Open:
    name: str
    root: int
    part: int
    skip: bool = False  # an inline element whose text is left out of its block


@dataclass
class _Reader:
    """Blocks of a page, read tag by tag."""

    blocks: list[Block] = field(default_factory=list)
    roots: list[_Part] = field(default_factory=lambda: [_Part(0, KEPT, False)])
    open: list[_Open] = field(default_factory=list)
    names: Counter[str] = field(default_factory=Counter)  # of the open elements
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    in_link: int = 0
    heading: bool = False
    parts: int = 0
    starts: list[int] = field(default_factory=lambda: [0])  # per article: the part it stands in

    @property
    def root(self) -> int:
        return self.open[-1].root if self.open else 0

    @property
    def part(self) -> int:
        return self.open[-1].part if self.open else 0

    def text(self, raw: str) -> None:
        if self.open and self.open[-1].skip:
            return
        decoded = entities.unescape(raw) if "&" in raw else raw
        self.pieces.append(decoded)
        if self.in_link:
            self.linked += len("".join(decoded.split()))

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            size = len(text.replace(" ", ""))
            paragraph = bool(self.open) and self.open[-1].name == "p"
            self.blocks.append(Block(text, self.linked / size, self.heading, self.root, self.part, paragraph))
        self.pieces, self.linked = [], 0

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.pieces.append("\n")
        elif name in INLINE:
            if name == "a":
                self.in_link = 1  # links do not nest
            elif name not in VOID and _standing(name, _attributes(attributes), True):
                self.add(_Open(name, self.root, self.part, skip=True))
        else:
            self.flush()
            self.in_link = 0
            if self.open and self.open[-1].name in ("p", name) and (
                    self.open[-1].name == "p" or name in CLOSED_BY_NEXT):
                self.close(len(self.open) - 1)
            self.heading = name in HEADINGS
            if name not in VOID:
                self.push(name, _attributes(attributes))

    def push(self, name: str, told: dict[str, str]) -> None:
        part, root = self.part, self.root
        sure = _is_article(name, told)
        article = sure or _is_named_article(name, told)
        if article and (not part or self.open[-1].root != self.starts[part]):
            self.parts += 1
            part = self.parts
        kind = _standing(name, told, bool(part), article, sure)
        if kind:
            self.roots.append(_Part(root, kind, name == "form"))
            root = len(self.roots) - 1
        elif sure:
            self.roots[root].article = True
        if part == len(self.starts):
            self.starts.append(root)
        self.add(_Open(name, root, part))

    def add(self, element: _Open) -> None:
        self.open.append(element)
        self.names[element.name] += 1

    def close(self, first: int) -> None:
        """Close the open elements from ``first`` on."""
        self.names.subtract(o.name for o in self.open[first:])
        del self.open[first:]

    def end(self, name: str) -> None:
        if name == "a":
            self.in_link = 0
        if name not in INLINE:
            self.flush()
            self.heading = False
        if self.names[name] > 0:  # else nothing so named is open
            self.close(next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i].name == name))


def _attributes(raw: str) -> dict[str, str]:
    if not raw.strip(" /\n\t\r"):
        return {}
    return {k.lower(): entities.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(raw)}


def _names(told: dict[str, str]) -> list[str]:
    return [n.lower() for n in f"{told.get('class', '')} {told.get('id', '')}".split()]


def _is_article(name: str, told: dict[str, str]) -> bool:
    return (name in ARTICLE or told.get("role", "") in ("main", "article")
            or told.get("itemprop", "").lower() == "articlebody")


def _is_named_article(name: str, told: dict[str, str]) -> bool:
    return name in ("div", "section") and any(n in ARTICLE_NAMES for n in _names(told))


def _standing(name: str, told: dict[str, str], in_article: bool, article: bool = False, sure: bool = False) -> int:
    """Whether an element is a part to leave out. Of an article's own names the first words
    count only (the others are its subjects), and if its tag says so, too, those of adverts and comments only."""
    if name in AWAY or name == "header" and not in_article:
        return WRAPS if name in ("form", "header") else OUT
    if not told or name in ("html", "body", "main"):
        return KEPT
    if "hidden" in told or "display:none" in told.get("style", "").replace(" ", "").lower():
        return OUT
    found = WRAPS if told.get("role") in AWAY_ROLES else KEPT
    for full in _names(told):
        words = [w for w in re.split(r"[-_:]+|\d+", full) if w]
        if not words or words[0] in KEEP_BEFORE or words[-1] in KEEP_AFTER or full in ARTICLE_NAMES:
            continue
        for w in words[:1] if article else words:
            if w in FOREIGN_WORDS or w.startswith(FOREIGN_BEGINNINGS):
                return OUT
            if sure or w == "header" and in_article:
                continue
            if w in AWAY_WORDS or w.startswith(AWAY_BEGINNINGS) or w.endswith(AWAY_ENDINGS):
                found = WRAPS
    return found


def _is_prose(block: Block) -> bool:
    return (len(block.text) >= SHORT and block.linked <= MUCH_LINKED and not block.heading
            and function_word_share(block.text) >= FEW_WORDS)


def _leave_out(blocks: list[Block], roots: list[_Part]) -> None:
    """Settle which blocks are left out with the part they stand in.

    If no article stands free of such parts, one that holds an article by tag or role, or a
    form that holds most of the page's prose, is a wrapper and stays.
    """
    if len(roots) > 1 and not any(b.part and not b.root for b in blocks):
        prose = 0
        if any(r.form for r in roots):
            for b in blocks:
                if _is_prose(b):
                    prose += len(b.text)
                    roots[b.root].prose += len(b.text)
        for r in reversed(roots[1:]):  # those within others have greater numbers
            around = roots[r.around]
            around.prose += r.prose
            if r.kind == WRAPS and (r.article or r.form and r.prose * 2 > prose):
                around.article |= r.article
                r.kind = KEPT
    out = [False]
    for r in roots[1:]:
        out.append(r.kind != KEPT or out[r.around])
    for b in blocks:
        b.away = out[b.root]


def page_blocks(page: str | None) -> list[Block]:
    """Blocks of a page in order, undecided."""
    if not page:
        return []
    reader = _Reader()
    at = 0
    while True:
        tag = MARKUP.search(page, at)
        reader.text(page[at:tag.start() if tag else len(page)])
        if not tag:
            break
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        if tag["end"] or tag["end2"]:
            reader.end(name)
        elif name in RAW:
            if name not in UNSEEN:
                reader.flush()
            at = _after(page, name, at)
        else:
            reader.start(name, tag["attributes"] or "")
    reader.flush()
    _leave_out(reader.blocks, reader.roots)
    return reader.blocks


def _after(page: str, name: str, at: int) -> int:
    """Where reading goes on after an element whose content is no text."""
    if name == "head" and (body := re.compile(r"<body\b", re.IGNORECASE).search(page, at)):
        return body.start()
    if close := re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at):
        return close.end()
    return len(page) if name in ("script", "style") else at


_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def function_word_share(text: str) -> float:
    """Share of function words, marks at the edges of words stripped."""
    words = [w if w.isalpha() else _EDGE.sub("", w) for w in text.lower().split()]
    words = [w for w in words if w]
    return sum(w in FUNCTION_WORDS for w in words) / len(words) if words else 0.0


def _decide(block: Block, has_article: bool) -> bool | None:
    """First pass: good, bad, or None for a block too short to tell."""
    if block.away or block.linked > MUCH_LINKED:
        return False
    if has_article and not block.part:
        return False
    size = len(block.text)
    if block.heading or size < SHORT:
        return None
    share = function_word_share(block.text)
    inside = block.part and block.paragraph
    if share >= MANY_WORDS or share >= FEW_WORDS and (size >= LONG or inside):
        return True
    return True if block.part and size >= LONG else None


def classify(blocks: list[Block]) -> list[Block]:
    """Both passes; every block of the result is decided."""
    has_article = any(b.part and not b.away for b in blocks)
    first = [_decide(b, has_article) for b in blocks]
    # Neighbours speak only within their part of the page; parts left out do not speak.
    lines: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        if not b.away and (b.part or not has_article):
            lines.setdefault(b.part, []).append(i)
    for b, label in zip(blocks, first):
        b.good = bool(label)
    for part, line in lines.items():
        if part and not any(first[i] for i in line):  # nothing tells text from links here
            for i in line:
                blocks[i].good = first[i] is None
            continue
        near = {True: [math.inf] * len(line), False: [math.inf] * len(line)}  # blocks to the next good, bad one
        for places in (range(len(line)), reversed(range(len(line)))):
            last: dict[bool, int] = {}
            for k in places:
                if (told := first[line[k]]) is not None:
                    last[told] = k
                for label, at in last.items():
                    near[label][k] = min(near[label][k], abs(k - at))
        further = BAD_FURTHER if part else 1
        for k, i in enumerate(line):
            if first[i] is None:
                blocks[i].good = near[True][k] <= near[False][k] * further
    return blocks


def main_text(page: str | None) -> str:
    """Good blocks joined by line feeds."""
    return "\n".join(b.text for b in classify(page_blocks(page)) if b.good)


def main_text_of(page: Column) -> Column:
    """Main text of a column of pages; empty for null."""
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return F.arrow_udf(run, "string")(page)


def extract_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each in ``out``, which replaces a column so named."""
    return pages.withColumn(out, main_text_of(F.col(html)))


def extract_blocks(pages: DataFrame, html: str = "html", out: str = "blocks") -> DataFrame:
    """``pages`` with array<struct<text, good>> of all blocks in ``out``."""
    def run(column: pa.Array) -> pa.Array:
        return pa.array([[{"text": b.text, "good": b.good} for b in classify(page_blocks(p.as_py()))] for p in column],
                        pa.list_(pa.struct([("text", pa.string()), ("good", pa.bool_())])))

    return pages.withColumn(out, F.arrow_udf(run, "array<struct<text:string,good:boolean>>")(F.col(html)))
