"""Main text of web pages by two passes of block rules.

Markup is read once, left to right, into blocks: runs of text between block-level tags, each with
its length, link characters and stop words, and the zone it stands in: ``out`` (menus, headers,
footers, sidebars, notices, adverts, forms, comments, by tag, role, class or id), ``main``
(inside ``article``, ``main`` or such a role) or ``open``. A form, or an element put outside by a word of its
class or id, is not outside if all articles of the page or most of its text are in it; a name that
denies such a word (``no-sidebar``, ``ad-free``) puts nothing outside.

Pass one decides blocks by themselves: ``out`` is boilerplate, and so is a block made of links;
long text with many stop words is content, long text without them boilerplate. Inside ``main``
only links count against a block. Short blocks stay open. Pass two lets open blocks inherit from
their nearest decided neighbours of the same zone: both sides agree, or the nearer one rules (content, if
both are as near); without any they count as content. Stop words say nothing on a page that has none of those listed,
nor of a block that is marked as of another language or written in other letters. Open blocks of a page
that has a main zone do not count.

Null and empty pages give the empty text; broken markup (unclosed tags, cut files, stray quotes)
ends at the end of the page. Each row is judged alone, so ties, repeated rows and equal ids do not
matter, and pages of any length are read whole. Other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hiretide.llm.common import arrow_map, type_of

SHORT, LONG = 70, 200
MOST_LINKS, ALL_LINKS = 0.5, 0.9
FEW_STOPS, MANY_STOPS = 0.1, 0.25
FOREIGN = 0.01  # share of other letters from which a block is in another language

#: Frequent function words of the languages judged.
STOP_WORDS = frozenset((
    "a an and are as at be been but by for from had has have he her his i in is it its not of on or "
    "she that the their they this to was we were which will with you "
    "aber als am an auch auf aus bei bin das dass dem den der des die du ein eine einen er es für "
    "hat ich im in ist ja mit nach nicht noch nur oder sich sie sind so und von war was wie wir zu "
    "al con de del el en es esta este la las lo los más no para pero por que se ser sin sobre su sus "
    "un una y "
    "au aux avec ce cette dans des du elle est et il ils je le les leur mais ne nous ou par pas plus "
    "pour qu que qui sa ses son sont sur une vous").split())

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)"
    r"(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?P<end>>|\Z)", re.S)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s\"'>]+))?")
_ATTRS = frozenset(("class", "id", "role", "aria-hidden", "hidden", "style", "lang"))
_WORD = re.compile(r"[^\W\d_]+")
_NAME = re.compile(r"[a-z]+")

#: Their content is not text of the page.
_RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg",
                  "math", "object", "select", "button", "canvas", "audio", "video", "datalist"))
_OUT_TAGS = frozenset(("nav", "footer", "aside", "form", "head", "menu", "dialog", "fieldset"))
_MAIN_TAGS = frozenset(("article", "main"))
_REGIONS = _MAIN_TAGS | _OUT_TAGS
_ENDS_REGIONS = _REGIONS | {"body", "html"}
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                   "source", "track", "wbr"))
_BLOCK = frozenset((
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
    "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1",
    "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main",
    "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul"))
_OUT_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form",
                        "menu", "menubar", "dialog", "alert", "alertdialog"))
#: Words of class and id values that mark what is not the article.
_OUT_NAMES = frozenset((
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "adsense",
    "banner", "breadcrumb", "breadcrumbs", "comment", "commentlist", "comments", "consent", "cookie", "cookies",
    "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notices", "notification", "pager", "pagination", "popup", "promo",
    "promotion", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "signup",
    "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "topbar", "widget"))
#: Of these, what readers or other pages wrote: it may be most of a page and is still not its text.
_OTHERS = frozenset(("comment", "commentlist", "comments", "disqus", "related", "replies", "reply", "respond"))
#: Beside such a word in one name, these say that the element is not the thing but has it, or lacks it.
_DENIALS = frozenset(("no", "not", "non", "has", "with", "without", "free", "hide", "hides", "off"))
#: Languages of ``STOP_WORDS``, and the letters they are written in besides a to z.
_LANGUAGES = frozenset(("en", "de", "es", "fr"))
_OTHER_LETTERS = re.compile(r"[^\W\d_a-zA-ZäöüßéèêëàâçîïôùûñáíóúæœÿÄÖÜÉÈÊËÀÂÇÎÏÔÙÛÑÁÍÓÚÆŒŸ]")
#: End tags that may be left out: a start tag closes the nearest open element of those it names, with
#: what is open inside it, unless one of the elements between them that hold their own stands there.
_ROWS, _CELLS = frozenset(("thead", "tbody", "tfoot")), frozenset(("td", "th"))
_CLOSES = {"li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
           "td": _CELLS, "th": _CELLS, "tr": _CELLS | {"tr"}, "caption": frozenset(),
           **dict.fromkeys(_ROWS, _ROWS | _CELLS | {"tr", "caption"})}
_HOLDS = {"li": frozenset(("ul", "ol", "menu", "dir")), **dict.fromkeys(("dt", "dd"), frozenset(("dl",))),
          **dict.fromkeys((*_ROWS, *_CELLS, "tr", "caption"), frozenset(("table",)))}
#: Elements whose start leaves an open paragraph as it is.
_IN_P = frozenset(("body", "caption", "head", "html", "legend", "tbody", "td", "tfoot", "th", "thead", "tr"))


@dataclass
class Block:
    zone: str
    text: str
    linked: int = 0
    listed: bool = False
    verdict: bool | None = None
    doubts: tuple[int, ...] = ()
    lang: str = ""


@dataclass
class _Doubt:
    """An element that its name, or a form, puts outside; whether it stays so shows at the page's end."""

    others: bool
    mains: int = 0
    main_tags: int = 0
    chars: int = 0


@dataclass(frozen=True)
class _Around:
    """What holds inside an element: its zone, the doubtful elements it is in, its language."""

    zone: str = "open"
    doubts: tuple[int, ...] = ()
    lang: str = ""


@dataclass
class _Reader:
    """Open elements as (tag, what holds inside), and by tag their places; the block being read as pieces."""

    open: list[tuple[str, _Around]] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)
    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    links: int = 0
    blocks: list[Block] = field(default_factory=list)
    doubts: list[_Doubt] = field(default_factory=list)
    mains: int = 0

    @property
    def around(self) -> _Around:
        return self.open[-1][1] if self.open else _Around()

    def end_block(self) -> None:
        text = " ".join(html.unescape("".join(self.pieces)).split())
        if text:
            linked = len(" ".join(html.unescape("".join(self.linked)).split()))
            listed = any(tag in ("li", "dd", "td") for tag, _ in self.open[-4:])
            around = self.around
            self.blocks.append(Block(around.zone, text, linked, listed, None, around.doubts, around.lang))
            if around.zone != "out":
                for k in around.doubts:
                    self.doubts[k].chars += len(text)
        self.pieces, self.linked = [], []

    def text(self, raw: str) -> None:
        if raw:
            self.pieces.append(raw)
            if self.links:
                self.linked.append(raw)

    def start(self, tag: str, attrs: str) -> None:
        if tag in _BLOCK:
            self.end_block()
            self.end_omitted(tag)
        if tag in _VOID:
            if tag == "br":
                self.text(" ")
            return
        if tag == "a":
            self.links += 1
            return
        around = self.around
        inside = self.inside(tag, attrs, around)
        if tag in _BLOCK or inside is not around:
            if tag not in _BLOCK:
                self.end_block()
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append((tag, inside))

    def last(self, tags) -> int:
        """The place of the innermost open element of ``tags``, or -1."""
        return max((at[-1] for t in tags if (at := self.places.get(t))), default=-1)

    def cut(self, at: int) -> None:
        """Close the elements from ``at`` on; each is closed once, however deep the page."""
        while len(self.open) > at:
            self.places[self.open.pop()[0]].pop()

    def end_omitted(self, tag: str) -> None:
        """Close what the start of ``tag`` closes by the rules for omitted end tags."""
        if tag not in _IN_P and self.open and self.open[-1][0] == "p":
            self.cut(len(self.open) - 1)
        if closed := _CLOSES.get(tag):
            holder = self.last((*_HOLDS[tag], *_REGIONS))
            if found := [at for t in closed for at in self.places.get(t, ())[-1:] if at > holder]:
                self.cut(min(found))

    def close(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
            return
        if tag in _BLOCK:
            self.end_block()
        at = self.last((tag,))
        # The end tag of a small element does not close the region around it.
        if at < 0 or (tag not in _ENDS_REGIONS and at < self.last(_REGIONS)):
            return
        if tag not in _BLOCK:
            self.end_block()
        self.cut(at)


    def inside(self, tag: str, attrs: str, around: _Around) -> _Around:
        """What holds inside an element that starts here."""
        given: dict[str, str] = {}
        if attrs:
            for m in _ATTR.finditer(attrs):
                if (name := m.group(1).lower()) in _ATTRS and name not in given:
                    given[name] = (m.group(2) or "").strip("\"'").lower()
        lang = given.get("lang", around.lang)[:2]
        zone, doubts = around.zone, around.doubts
        if zone != "out":
            words = _names(given)
            if self._outside(tag, given, words, zone):
                zone = "out"
            else:
                if tag in _MAIN_TAGS or given.get("role") in ("main", "article"):
                    zone = "main"
                if tag not in ("html", "body") and (tag == "form" or words & _OUT_NAMES):
                    doubts = (*doubts, len(self.doubts))
                    self.doubts.append(_Doubt(bool(words & _OTHERS)))
                if zone == "main" and (tag in _MAIN_TAGS or given.get("role") in ("main", "article")):
                    self.mains += 1
                    for k in doubts:
                        self.doubts[k].mains += 1
                        self.doubts[k].main_tags += tag == "main"
        if zone == around.zone and doubts is around.doubts and lang == around.lang:
            return around
        return _Around(zone, doubts, lang)

    def _outside(self, tag: str, given: dict[str, str], words: set[str], zone: str) -> bool:
        if tag in _OUT_TAGS and tag != "form" or given.get("role", "") in _OUT_ROLES:
            return True
        if "hidden" in given or given.get("aria-hidden") == "true" or (
                "display:none" in given.get("style", "").replace(" ", "")):
            return True
        return zone != "main" and (tag == "header" or "header" in words)

    def settle(self) -> None:
        """Blocks in an element that is outside after all are outside. It is not if the page's articles are all in
        it, or most of the text; comments and links to other pages are so whatever they hold, but for the
        page's own main element."""
        total = sum(len(b.text) for b in self.blocks if b.zone != "out")
        outside = [d.main_tags == 0 and (d.others or (not (self.mains and d.mains == self.mains)
                                                      and 2 * d.chars <= total)) for d in self.doubts]
        for block in self.blocks:
            if any(outside[k] for k in block.doubts):
                block.zone = "out"


def _names(given: dict[str, str]) -> set[str]:
    """The words of class and id values; without those of names that deny them (``no-sidebar``, ``ad-free``)."""
    out: set[str] = set()
    for name in f"{given.get('class', '')} {given.get('id', '')}".split():
        words = _NAME.findall(name)
        if _DENIALS.isdisjoint(words):
            out.update(words)
    return out


def blocks(page: str) -> list[Block]:
    """The blocks of a page, in order, white space and character references resolved."""
    reader, at, end = _Reader(), 0, len(page)
    lowered = None
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            reader.text(page[at:])
            break
        reader.text(page[at:m.start()])
        at = m.end()
        tag = m.group("tag")
        if tag is None or not m.group("end"):
            continue
        tag = tag.lower()
        if m.group("close"):
            reader.close(tag)
        elif tag in _RAW:
            if not m.group("attrs").endswith("/"):
                lowered = page.lower() if lowered is None else lowered
                source = lowered if len(lowered) == end else page
                stop = source.find(f"</{tag}", at)
                at = end if stop < 0 else stop
        else:
            reader.start(tag, m.group("attrs"))
    reader.end_block()
    reader.settle()
    return reader.blocks


def told_by_stop_words(block: Block) -> bool:
    """Whether stop words say anything of a block: it is not marked as of another language, and not written
    in other letters than the known languages are."""
    if block.lang and block.lang not in _LANGUAGES:
        return False
    return len(_OTHER_LETTERS.findall(block.text)) <= FOREIGN * len(block.text)


def stop_share(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def first_pass(block: Block, known: bool = True) -> bool | None:
    """Content, boilerplate, or not to be told from the block itself."""
    if block.zone == "out":
        return False
    size = len(block.text)
    links = block.linked / size
    if block.zone == "main":
        if links >= ALL_LINKS and block.listed:
            return False
        return None if links > MOST_LINKS or size < SHORT else True
    if links > MOST_LINKS:
        return False
    if size < SHORT:
        return None
    if not known or not told_by_stop_words(block):
        return True
    stops = stop_share(block.text)
    if stops >= MANY_STOPS or (size > LONG and stops >= FEW_STOPS):
        return True
    return False if stops < FEW_STOPS else None


def second_pass(found: list[Block]) -> None:
    """Open blocks take the verdict of their nearest decided neighbours of the same zone."""
    for zone in ("main", "open"):
        own = [b for b in found if b.zone == zone]
        decided = [b.verdict for b in own]
        before: list[tuple[int, bool] | None] = []
        last = None
        for i, verdict in enumerate(decided):
            before.append(last)
            last = (i, verdict) if verdict is not None else last
        last = None
        for i in range(len(own) - 1, -1, -1):
            if decided[i] is not None:
                last = (i, decided[i])
            elif last is None or before[i] is None:
                near = last or before[i]
                own[i].verdict = near[1] if near else True
            elif last[1] == before[i][1]:
                own[i].verdict = last[1]
            else:
                after, behind = last[0] - i, i - before[i][0]
                own[i].verdict = after == behind or (last[1] if after < behind else before[i][1])
            if zone == "main" and decided[i] is None and own[i].linked <= MOST_LINKS * len(
                    own[i].text):
                own[i].verdict = True  # a menu in an article says nothing of the text around it


def main_text(page: str | None) -> str:
    """The content blocks of a page, one a line."""
    found = blocks(page) if page else []
    known = any(b.zone == "open" and stop_share(b.text) >= FEW_STOPS for b in found)
    for block in found:
        block.verdict = first_pass(block, known)
    second_pass(found)
    zone = "main" if any(b.zone == "main" and b.verdict for b in found) else "open"
    return "\n".join(b.text for b in found if b.verdict and b.zone == zone)


def extract_text(df: DataFrame, id_cols: tuple[str, ...] = ("page_id", "url"),
                 html_col: str = "html") -> DataFrame:
    """Per row: the id columns, ``text`` and ``n_chars``."""

    def run(batch: pa.RecordBatch) -> Iterator[list]:
        texts = [main_text(p) for p in batch.column(len(id_cols)).to_pylist()]
        yield [*(batch.column(i) for i in range(len(id_cols))), texts, [len(t) for t in texts]]

    return arrow_map(df.select(*id_cols, html_col), run, [
        *((c, type_of(df, c)) for c in id_cols), ("text", T.StringType()),
        ("n_chars", T.LongType())])
