"""Main text of web pages by two-pass block rules.

Pass one labels each block alone, by length, link density and stop-word density: good, bad, or undecided
(links, near, short). Pass two lets undecided blocks inherit from their nearest decided neighbours; where
these differ, the one nearer in the element tree counts. Marks of elements (navigation, adverts, forms,
comments, hidden parts) make blocks bad; an element marked as the article bounds where its blocks look
for neighbours, if the densities say that the page's prose is in it.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent function words of each language.
STOP_WORDS = {
    "en": "the of and to in a is that for it was on are as with be by at this from or an have not they but which you were there his her their we has will all can if".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec on aux son ses mais comme ou leur elle été cette".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta".split(),
}
#: Elements, roles and words of class, id and label that mark what is not the article. A name
#: counts as a whole: each of its words is one of these or of LAYOUT_WORDS, and one at least is of these.
BOILER_TAGS = frozenset("nav aside footer form dialog menu".split())
BOILER_INLINE = frozenset("button select label datalist optgroup option".split())
BOILER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status tablist toolbar tooltip".split())
BOILER_WORDS = frozenset(
    "ad ads adsbygoogle advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer discussion disqus footer gdpr login menu menus modal nav navbar navigation newsletter notice notices pager pagination paywall popup promo promotion promotions recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar trending widget widgets".split()
)
HEADER_WORDS = frozenset("header masthead topbar".split())
LAYOUT_WORDS = frozenset(
    "a area article bar block blocks bottom box button buttons col column container content desktop footer form global google group header icon icons inner inline item items left link links list main message mobile module outer overlay page panel policy post posts primary right row secondary section site slot the this to text title top unit website wrap wrapper".split()
)
DROPPED = "script|style|noscript|template|textarea|svg|iframe|object|title|math|canvas|audio|video"
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = BLOCK_TAGS - {"hr", "head"} | {"span"}
PARAGRAPHS = frozenset("p blockquote pre dd figcaption h1 h2 h3 h4 h5 h6".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Marks that end a sentence, and those that part it too, in many scripts.
SENTENCE_ENDS = frozenset(".!?…。！？｡।॥؟۔።")
SENTENCE_MARKS = SENTENCE_ENDS | frozenset(";:,、，；：،؛፣")
#: Scripts in which a code point says about twice as much as a letter.
_DENSE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<drop>{DROPPED})\b(?=[\s/>])|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<end2>/?)(?P<tag2>[a-z][a-z0-9:-]*)(?P<attrs2>[^>]*)>",
    re.I | re.S,
)
_PAIRS = re.compile(rf"<(?P<end>/?)(?P<tag>{DROPPED})\b(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?P<close>>)", re.I)
_START = re.compile(r"<[a-z]+(?:(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)", re.I)
#: Tags that cannot stand in a drawing or formula, unless in an element of it that holds HTML.
_BREAKS = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK_TAGS))}|b|big|br|button|code|em|embed|i|img|label|meta|nobr|ruby|s|small|span|strong|strike|sub|sup|tt|u|var)\b(?=[\s/>])", re.I)
_HOLDS_HTML = re.compile(r"<(?:foreignobject|desc|title|annotation-xml|mtext|m[inos])\b", re.I)
_MARK = re.compile(r"""\b(class|id|role|aria-label|aria-hidden|hidden|style)\b\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_PART = re.compile(r"[a-z]+|[^\W\d_]+")


@dataclass
class Rules:
    """Thresholds of both passes; lengths are in code points (twice for dense scripts), densities are
    shares. `density` and `marks` turn off the two kinds of evidence, to see what each does."""

    short: int = 70
    long: int = 200
    stop_low: float = 0.15
    stop_high: float = 0.30
    some_links: float = 0.2
    max_links: float = 0.5
    marks_per_hundred: float = 0.7
    density: bool = True
    marks: bool = True


@dataclass
class Block:
    text: str
    links: int  # code points inside links
    boiler: bool  # marked as not the article
    region: int  # outermost element marked as the article, counted from 1; 0 outside
    heading: bool
    paragraph: bool
    path: tuple[int, ...]  # the open elements, outermost first
    label: str = ""


class _Dropped:
    """Where the dropped elements of a page end."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.ends: dict[int, int] | None = None
        self.breaks = (0, -1)

    def _paired(self, start: int) -> int | None:
        """The end of the end tag that belongs to a start tag: that of the last one of its name still open."""
        if self.ends is None:
            self.ends = {}
            waiting: dict[str, list[int]] = {}
            for m in _PAIRS.finditer(self.page):
                tag = m["tag"].lower()
                if not m["end"]:
                    if tag not in ("svg", "math") or self.page[m.end() - 2] != "/":
                        waiting.setdefault(tag, []).append(m.start())
                elif waiting.get(tag):
                    self.ends[waiting[tag].pop()] = m.end()
        return self.ends.get(start)

    def _break(self, start: int) -> int:
        """The next tag that cannot stand in a drawing, or the page's length."""
        asked, found = self.breaks
        if not asked <= start <= found:
            m = _BREAKS.search(self.page, start)
            self.breaks = start, m.start() if m else len(self.page)
        return self.breaks[1]

    def end(self, start: int, name: str) -> int:
        """Scripts and styles end with their own end tag or the page. Of others without one only the start
        tag is dropped, with a title's or text field's text up to the next tag and a drawing up to the
        first tag that cannot stand in it."""
        page, name = self.page, name.lower()
        if name in ("script", "style"):
            found = re.compile(rf"</{name}(?:[\s/][^>]*)?>", re.I).search(page, start)
            return found.end() if found else len(page)
        opened = _START.match(page, start)
        after = opened.end() if opened else len(page)
        if name not in ("svg", "math"):
            paired = self._paired(start)
            if paired is None and name in ("title", "textarea"):
                after = at if (at := page.find("<", after)) >= 0 else len(page)
            return paired or after
        if page[after - 2 : after] == "/>":
            return after
        paired, breaks = self._paired(start), self._break(after)
        if paired and (paired <= breaks or _HOLDS_HTML.search(page, after, breaks)):
            return paired
        return breaks if breaks < len(page) else after


def _is_boiler(name: str, in_article: bool) -> bool:
    """Whether all words of a name say that the element is not the article; a header may be an article's."""
    parts = [x for x in _PART.findall(name) if x]
    kinds = BOILER_WORDS if in_article else BOILER_WORDS | HEADER_WORDS
    return bool(parts) and not kinds.isdisjoint(parts) and all(x in kinds or x in LAYOUT_WORDS for x in parts)


def _marks(tag: str, attrs: str, in_article: bool) -> int:
    """1: not the article, 2: opens the article, 0: neither."""
    if tag in BOILER_TAGS or tag in BOILER_INLINE or tag == "header" and not in_article:
        return 1
    opens = tag in ("article", "main")
    if attrs and tag not in ("html", "body"):
        for m in _MARK.finditer(attrs):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            low = value.lower()
            if key == "hidden" or key == "aria-hidden" and low == "true" or key == "style" and ("display:none" in (bare := low.replace(" ", "")) or "visibility:hidden" in bare):
                return 1
            if key == "role":
                if low in BOILER_ROLES:
                    return 1
                opens |= low in ("article", "main")
            elif key == "aria-label":
                if _is_boiler(low, in_article):
                    return 1
            elif key in ("class", "id") and tag != "main" and any(_is_boiler(_CAMEL.sub(r"\1-\2", x).lower(), in_article) for x in value.split()):
                return 1
    return 2 if opens else 0


_CAMEL = re.compile(r"([a-z])([A-Z])")


def _implied(tag: str, stack: list[tuple[str, int, int]]) -> int:
    """How many open elements a start tag ends: a block ends an open paragraph with the inline elements in
    it, an item or a cell the one before it."""
    ended = "p" if tag in BLOCK_TAGS and tag not in ("li", "td", "tr") else tag if tag in ("li", "td", "tr") else None
    n = 0
    while ended and n < len(stack) and (stack[-1 - n][0] not in BLOCK_TAGS or ended != "p" and stack[-1 - n][0] == "p"):
        n += 1
    return n + 1 if ended and n < len(stack) and stack[-1 - n][0] == ended else 0


def blocks(page: str, marks: bool = True) -> list[Block]:
    """Blocks with text, in page order; references are decoded and white space is one space.

    Text in marked elements within a line is left out of the block it stands in; that of marked blocks is
    a block of its own, as neighbours ask for it.
    """
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # tag, mark, number
    numbers = boiler = article = regions = inline = 0
    pieces: list[str] = []
    anchors, links, heading, paragraph, breaks = 0, 0, False, False, 0
    at, end, dropped = 0, len(page), _Dropped(page)

    def close() -> None:
        nonlocal pieces, links, heading, breaks
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, links, boiler > 0, regions if article else 0, heading, paragraph, tuple([x[2] for x in stack])))
        pieces, links, breaks = [], 0, 0

    def add(raw: str) -> None:
        nonlocal links, breaks
        if raw and not inline:
            pieces.append(raw)
            if not raw.isspace():
                breaks = 0
                if anchors:
                    links += len(raw.strip())

    def pop() -> str:
        nonlocal boiler, article, inline
        t, kind, _ = stack.pop()
        boiler -= kind == 1
        article -= kind == 2
        inline -= kind == 3
        return t

    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        name = m["tag"] or m["tag2"]
        if name is None:
            if m["drop"]:
                at = dropped.end(m.start(), m["drop"])
            continue
        tag, closing, attrs = name.lower(), bool(m["end"] or m["end2"]), m["attrs"] or m["attrs2"] or ""
        if tag == "br":
            breaks += 1
            pieces.append(" ")
            if breaks > 1:
                close()
            continue
        if tag == "a":
            anchors = 0 if closing else 1
        if tag in BLOCK_TAGS:
            close()
            anchors = 0
            heading = not closing and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
            paragraph = not closing and tag in PARAGRAPHS
        if tag in VOID_TAGS:
            continue
        if closing:
            if any(x[0] == tag for x in stack):
                while pop() != tag:
                    pass
        elif not attrs.endswith("/"):
            for _ in range(_implied(tag, stack)):
                pop()
            kind = _marks(tag, attrs, article > 0) if marks and (attrs or tag in CONTAINERS or tag in BOILER_INLINE) else 0
            block = tag in BLOCK_TAGS
            if kind == 1 and not block:
                kind = 3
            if block or kind or inline or tag == "span":
                numbers += 1
                stack.append((tag, kind, numbers if block else 0))
                boiler += kind == 1
                inline += kind == 3
                regions += kind == 2 and not article
                article += kind == 2
    close()
    return out


def weight(text: str) -> int:
    """Code points, those of dense scripts counted twice."""
    return len(text) if text.isascii() else len(text) + len(_DENSE.findall(text))


def stop_density(text: str) -> float:
    words = _WORD.findall(text.lower())
    return max(sum(w in s for w in words) for s in _STOP) / len(words) if words else 0.0


_STOP = [frozenset(v) for v in STOP_WORDS.values()]


def mark_density(text: str) -> float:
    """Sentence marks in a hundred code points."""
    return 100 * sum(c in SENTENCE_MARKS for c in text) / weight(text) if text else 0.0


class _Page:
    """What pass one has to know of the whole page: whether a stop list fits its language."""

    def __init__(self, found: list[Block], rules: Rules) -> None:
        self.rules, self.known = rules, {}
        self.fits = True
        told = [(weight(b.text), self.stops(b)) for b in found if not b.boiler and weight(b.text) >= rules.short and b.links <= len(b.text) * rules.some_links]
        if total := sum(n for n, _ in told):
            self.fits = sum(n * d for n, d in told) >= rules.stop_low * total

    def stops(self, b: Block) -> float:
        if id(b) not in self.known:
            self.known[id(b)] = stop_density(b.text)
        return self.known[id(b)]

    def density(self, b: Block) -> int:
        """2: prose, 1: perhaps, 0: not, by stop words, or by sentence marks where no stop list fits the page."""
        low, high = self.rules.stop_low, self.rules.stop_high
        d = self.stops(b)
        if not self.fits:
            d = max(d, high if mark_density(b.text) >= self.rules.marks_per_hundred else 0.0)
        return 2 if d >= high else 1 if d >= low else 0


def decide(b: Block, page: _Page) -> str:
    """Pass one: good, bad, or what kind of undecided a block is."""
    rules, n = page.rules, weight(b.text)
    if b.boiler:
        return "bad"
    if not rules.density:
        return "short"
    share = b.links / len(b.text)
    if share > rules.max_links:
        return "links" if b.region else "bad"
    if not b.region and "©" in b.text and n < rules.long:
        return "bad"
    if n < rules.short or share > rules.some_links:
        return "short"
    d = page.density(b)
    if d == 2:
        return "good" if n >= rules.long else "near"
    if d or b.region:
        return "near" if d else "short"
    # few stop words, but sentences: of another language than the page's, or full of names
    return "short" if b.text[-1] in SENTENCE_ENDS and mark_density(b.text) >= rules.marks_per_hundred else "bad"


def confine(found: list[Block], page: _Page) -> None:
    """Whether the elements marked as the article hold the page's prose, by density: if half or more of it,
    blocks outside are boilerplate, and so are such elements with little of it, as teasers are; if not,
    the marks of those with little of it are taken off."""
    if not any(b.region and not b.boiler for b in found) or all(b.region or b.boiler for b in found):
        return
    for least in (2, 1, 0):  # the densest kind of text that the page has
        prose: Counter[int] = Counter()
        for b in found:
            n = weight(b.text)
            if not b.boiler and (n >= page.rules.short or not least) and b.links <= len(b.text) * page.rules.some_links and page.density(b) >= least:
                prose[b.region] += n
        if total := prose.total():
            break
    if least:
        told = {b.region for b in found if b.region and (prose[b.region] >= page.rules.long or 2 * prose[b.region] >= total)}
        most = 2 * sum(prose[r] for r in told) >= total
    else:  # nothing but the marks to go by
        told = {r for r in prose if r}
        most = bool(told)
    for b in found:
        if most:
            b.boiler |= b.region not in told
        elif b.region not in told:
            b.region = 0


def _shared(a: Block, b: Block) -> int:
    n = 0
    for x, y in zip(a.path, b.path):
        if x != y:
            break
        n += 1
    return n


def _around(found: list[Block]) -> list[tuple[Block | None, Block | None]]:
    """The nearest decided neighbours of each block on both sides."""
    before: list[Block | None] = []
    after: list[Block | None] = []
    for seen, order in ((before, found), (after, reversed(found))):
        last = None
        for b in order:
            seen.append(last)
            last = b if b.label in ("good", "bad") else last
    return list(zip(before, reversed(after), strict=True))


def inherit(found: list[Block], article: bool) -> None:
    """Pass two over the blocks of one article or of what is outside: links first, headings last, as
    they follow what comes after them.

    An article's edges are good neighbours, but for links outside paragraphs; the page's edges say nothing.
    Where neighbours differ, the one nearer in the tree counts, else an article's and a near-prose block
    is good. Where no block is good, what is undecided is.
    """
    edge = "good" if article else None
    for turn in ("links", "rest", "heading"):
        if not article and turn == "rest" and not any(b.label == "good" for b in found):
            near = [b for b in found if b.label == "near"]
            for b in near or [b for b in found if b.label == "short"]:
                b.label = "good"
        made = []
        for b, (left, right) in zip(found, _around(found), strict=True):
            if b.label in ("good", "bad") or turn != ("links" if b.label == "links" else "heading" if b.heading else "rest"):
                continue
            ends = edge if b.label != "links" or b.paragraph else "bad"
            x, y = left.label if left else ends, right.label if right else ends
            if turn == "heading" and right:
                made.append((b, y))
            elif x == y or x is None or y is None:
                made.append((b, x or y or ("good" if b.label == "near" else "bad")))
            elif left and right and _shared(b, left) != _shared(b, right):
                made.append((b, x if _shared(b, left) > _shared(b, right) else y))
            else:
                made.append((b, "good" if b.label == "near" or article and b.label != "links" else "bad"))
        for b, label in made:
            b.label = label


def classify(found: list[Block], rules: Rules) -> None:
    """Labels every block good or bad."""
    page = _Page(found, rules)
    if rules.density:
        confine(found, page)
    else:
        for b in found:
            b.boiler |= not b.region and any(x.region for x in found)
    for b in found:
        b.label = decide(b, page)
    for region in sorted({b.region for b in found if b.region}):
        inherit([b for b in found if b.region == region and not b.boiler], True)
    inherit([b for b in found if not b.region], False)


def main_text(page: str | None, rules: Rules | None = None) -> str:
    """The article's blocks joined by line ends; null and empty pages, and those of boilerplate alone, give an empty text."""
    rules = rules or Rules()
    found = blocks(page or "", rules.marks)
    classify(found, rules)
    return "\n".join(b.text for b in found if b.label == "good")


def extract(pages: DataFrame, html: str = "html", out: str = "text", rules: Rules | None = None) -> DataFrame:
    """Adds the main text of each page; a column of that name is replaced, others stay.

    Rows are independent: no shuffle, repeated rows give repeated results, null pages an empty text.
    """
    rules = rules or Rules()

    @F.pandas_udf("string")
    def texts(page: pd.Series) -> pd.Series:
        return page.map(lambda x: main_text(x, rules), na_action=None)

    return pages.withColumn(out, texts(F.col(html).cast("string")))
