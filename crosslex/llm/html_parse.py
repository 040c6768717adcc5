"""Pages as nested elements: blocks of text, digests of subtrees, what is no article.

One pass over a page's tags with a stack of open elements; a closed element hands its
pieces and its digest to the one around it. Nothing recurses, so depth is no limit.
"""

import re
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([A-Za-z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

# Element names of the markup standard, by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
GONE = frozenset(
    "head nav footer header aside form button select menu dialog svg object audio video "
    "canvas script style noscript iframe template title textarea map datalist".split())
HEAD_ONLY = frozenset("title meta link script style base noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr "
    "q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr".split())
# What an opening tag of the first closes, up to the nearest of the last.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset(["html"])),
}
#: Words that mark what is no article, where a class or id is one of them or ends in it; roles.
MARKS = frozenset(
    "ad ads advert adverts advertisement adbox adsense sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer "
    "foot sidebar aside widget widgets rail comment comments commentlist disqus reply replies "
    "respond discussion notice notices cookie cookies consent gdpr popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended pagination pager "
    "toolbar copyright skip".split())
#: Words that may stand behind a mark, and such that turn it into its contrary before it.
BEHIND = frozenset(
    "box block bar container wrapper wrap list link links item items area slot unit form panel "
    "inner outer group top bottom left right".split())
CONTRARY = frozenset("no not non without has have with hide hides hidden show".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar "
    "toolbar form".split())
#: Elements that hold the article, and the whole page, whatever their class says.
HOLDERS = frozenset(["article", "main", "body", "html"])
#: Elements whose text is prose; a marked element that has so much of a page's text in them stays.
PARAGRAPHS, MOST = frozenset("p pre blockquote li dd td".split()), 0.8
#: Elements that a class or id does not mark inside an article: its own headings and parts.
UNMARKED = frozenset("h1 h2 h3 h4 h5 h6 li dt dd blockquote pre table td th caption".split())
#: Marks that inside an article are its own.
OUTSIDE = frozenset(["header"])
#: Elements of running text: inside an article these are never a site's template.
PROSE = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th caption "
    "article main body html".split()) | INLINE


@dataclass
class Open:
    """An element not closed yet."""

    tag: str
    gone: bool = False  # with all that is in it, but for an article where only marked so
    marked: bool = False
    plain: bool = True  # without class and id
    parts: list[str] = field(default_factory=list)  # of its digest
    start: int = 0  # pieces of the page before it
    articles: int = 0  # that were found before it
    number: int = 0  # of its opening tag
    prose: int = 0  # characters of it before it


@dataclass
class Page:
    """Text of a page, and the digests of the subtrees that could be a template's."""

    text: str
    digests: set[int]


def _attributes(source: str) -> dict[str, str]:
    return {name.lower(): (value or "").strip("\"'") for name, value in _ATTRIBUTE.findall(source)}


def _blocks(pieces: list[str | None]) -> str:
    """Blocks joined by a space, white space in them made single."""
    blocks, words = [], []
    for piece in [*pieces, None]:
        if piece is not None:
            words.append(piece)
        elif words:
            if block := " ".join("".join(words).split()):
                blocks.append(block)
            words = []
    return " ".join(blocks)


def _marked(names: str, inside: bool = False) -> bool:
    """Whether one of the classes or ids marks what is no article; ``inside`` one or not."""
    for name in names.split():
        words = [w for w in re.split(r"[^a-z]+", name) if len(w) > 1]
        while len(words) > 1 and words[-1] in BEHIND:
            words.pop()
        if words and words[-1] in MARKS and not CONTRARY.intersection(words) and not (
                inside and words[-1] in OUTSIDE):
            return True
    return False


def parse(html: str, template: frozenset[int] | set[int] = frozenset(),
          spared: frozenset[int] = frozenset()) -> Page:
    """Read a page; subtrees whose digest is in ``template`` are left out.

    The text is that of the outermost articles and of what stands between them, with the main
    element that holds them where there is one; else of the main element, else of the body.
    The time is that of the page's length: a piece of text is stored once, in one list that
    elements are parts of, and what an element leaves out is cut off its end.
    Marked elements that turn out to hold most of the text as prose are ``spared``, by the
    number of their opening tag, when the page is read again.
    """
    root = Open("")
    stack, digests = [root], set()
    out: list[str | None] = []  # texts; None between blocks
    is_open: dict[str, int] = {}
    articles: list[tuple[str, int, int]] = []  # kind, first and last piece
    inside = 0  # open articles
    opened = lost = paragraphs = 0  # elements so far; open ones that are gone, of prose
    shown_chars = prose = 0  # characters outside of what is gone, of them in prose
    dropped: list[tuple[int, int]] = []  # marked elements left out, and their prose

    def close() -> None:
        nonlocal inside, lost, paragraphs
        own = stack.pop()
        is_open[own.tag] -= 1
        lost -= own.gone
        paragraphs -= own.tag in PARAGRAPHS
        above = stack[-1]
        content = "\0".join(own.parts)
        digest = int.from_bytes(blake2b(
            f"{own.tag}\0{content}".encode("utf-8", "surrogatepass"), digest_size=8).digest(),
            "big", signed=True)
        above.parts.append(format(digest, "x"))
        if own.tag in ("article", "main"):
            inside -= 1
        holds = len(articles) > own.articles or own.tag in HOLDERS
        if own.gone and not (own.tag == "form" and holds) or own.marked and (
                not holds or own.articles):
            # A marked element may be around the article, but not around a later one.
            if own.marked and not own.gone and not holds:
                dropped.append((own.number, prose - own.prose))
            del articles[own.articles:]
            del out[own.start:]
            return
        if not holds and own.parts and (
                not inside and own.tag not in INLINE or own.tag not in PROSE or not own.plain):
            digests.add(digest)
            if digest in template:
                del out[own.start:]
                return
        if own.tag in ("article", "main"):
            kind = "article" if own.tag == "article" or len(articles) > own.articles else "main"
            del articles[own.articles:]
            articles.append((kind, own.start, len(out)))
        if own.tag not in INLINE:
            out.append(None)

    def close_to(place: int) -> None:
        while len(stack) > place:
            close()

    def find(tags: frozenset[str], stops: frozenset[str]) -> int | None:
        for tag in tags:
            if is_open.get(tag):
                break
        else:
            return None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in stops:
                return None
        return None

    def text(raw: str) -> None:
        nonlocal shown_chars, prose
        if raw:
            shown = unescape(raw)
            out.append(shown)
            if word := " ".join(shown.split()):
                stack[-1].parts.append(word)
                if not lost:
                    shown_chars += len(word)
                    prose += len(word) * (paragraphs > 0)

    at, size = 0, len(html)
    last = html.rfind(">")
    while at < size:
        sign = html.find("<", at)
        if sign < 0 or sign > last:
            # No tag ends any more: only a comment or a section may begin.
            begun = html.find("<!", at) if sign >= 0 else -1
            while begun >= 0 and not html.startswith(("<!--", "<![CDATA["), begun):
                begun = html.find("<!", begun + 2)
            text(html[at:] if begun < 0 else html[at:begun])
            if begun >= 0 and html.startswith("<![CDATA[", begun):
                text(html[begun + 9:])
            break
        match = _TAG.match(html, sign)
        if match is None:
            text(html[at:sign + 1])
            at = sign + 1
            continue
        text(html[at:sign])
        at = match.end()
        name = match[2] or match[5]
        if name is None:
            if match[0].startswith("<![CDATA["):
                text(match[0][9:].removesuffix("]]>"))
            continue
        tag = name.lower()
        if match[1] or match[4]:
            if tag == "br":
                out.append(" ")
            elif (place := find(frozenset([tag]), frozenset())) is not None:
                close_to(place)
            continue
        source = match[3] or match[6] or ""
        if len(stack) > 1 and tag not in HEAD_ONLY and tag != "head" and (
                place := find(frozenset(["head"]), frozenset())) is not None:
            close_to(place)
        if tag in VOID:
            # A line break is white space inside its block.
            out.append(" " if tag == "br" else None if tag == "hr" else "")
            continue
        if tag in CLOSES:
            tags, stops = CLOSES[tag]
            while (place := find(tags, stops)) is not None:
                close_to(place)
        elif tag not in INLINE and (place := find(
                frozenset(["p"]), frozenset(["article", "main", "div", "section", "td", "th",
                                             "li", "blockquote", "button", "body"]))) is not None:
            close_to(place)
        opened += 1
        new = Open(tag, articles=len(articles), number=opened, prose=prose, start=len(out))
        if tag not in INLINE:
            out.append(None)
        if "=" in source or source.strip(" /\n\t\r"):
            given = _attributes(source)
            marks = f"{given.get('class', '')} {given.get('id', '')}".lower()
            new.plain = not marks.strip()
            new.marked = bool(
                opened not in spared and not (inside and tag in UNMARKED) and _marked(
                    marks, inside > 0)
                or given.get("role", "").lower() in ROLES or "hidden" in given
                or given.get("aria-hidden") == "true"
                or re.search(r"display\s*:\s*none", given.get("style", ""))) and tag not in ("main", "body", "html")
            new.parts.append(marks.strip())
            if tag == "a":
                new.parts.append(given.get("href", ""))
        new.parts = [p for p in new.parts if p]
        new.gone = tag in GONE
        lost += new.gone
        paragraphs += tag in PARAGRAPHS
        if tag in ("article", "main"):
            inside += 1
        stack.append(new)
        is_open[tag] = is_open.get(tag, 0) + 1
        if tag in RAW:
            ends = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(html, at)
            body = html[at:ends.start() if ends else size]
            new.parts.append(body)
            if tag == "xmp":  # shown as it stands
                out.append(body)
            at = ends.end() if ends else size
            close()
        elif source.endswith("/") and tag in ("svg", "path", "use", "g"):
            close()
    close_to(1)
    if not spared and (again := frozenset(
            number for number, chars in dropped if chars > MOST * shown_chars)):
        return parse(html, template, again)
    shown = [a for a in articles if _blocks(out[a[1]:a[2]])]
    chosen = [a for a in shown if a[0] == "article"] or shown
    # From the first to the last, with what stands between them.
    pieces = out[chosen[0][1]:chosen[-1][2]] if chosen else out
    return Page(_blocks(pieces), digests)
