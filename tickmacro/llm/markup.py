"""Markup of pages as tokens: tags and runs of text, each at its place in the page."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

from xxhash import xxh64_intdigest


def _names(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Names of elements and attributes of pages.
_VOID = _names("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr")
#: Their content is no markup and no text.
_RAW = _names("iframe noembed noframes script style textarea title xmp")
_BLOCK = _names(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td template tfoot th thead title tr ul"
)
_ENDS_PARAGRAPH = _BLOCK - _names("body caption head html legend option optgroup select tbody td template tfoot th thead title tr")
#: An open element of the second group ends where one of the first begins, unless one of the third stands between.
_IMPLIED = [
    (_names("li"), _names("li"), _names("ul ol menu dir")),
    (_names("dt dd"), _names("dt dd"), _names("dl")),
    (_names("td th"), _names("td th"), _names("tr table")),
    (_names("tr"), _names("tr"), _names("table")),
    (_names("tbody thead tfoot"), _names("tbody thead tfoot"), _names("table")),
    (_names("option optgroup"), _names("option"), _names("select")),
    (_ENDS_PARAGRAPH, _names("p"), _names("button caption object table td th template")),
]
_CLOSES: dict[str, list[tuple[frozenset, frozenset]]] = {}
for _begins, _ended, _between in _IMPLIED:
    for _name in _begins:
        _CLOSES.setdefault(_name, []).append((_ended, _between))
#: Never part of an article.
_DROPPED = _names(
    "aside audio button canvas datalist dialog embed footer form frame frameset head iframe input menu nav noembed noframes "
    "noscript object optgroup option script search select style svg template textarea title video"
)
_DROPPED_ROLES = _names(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar"
)
#: What first or last words of class names and ids say about an element.
_SIDE_WORDS = _names(
    "ad adbox ads adsense advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs "
    "comment comments consent cookie cookies copyright discussion disqus foot footer gdpr login masthead menu menubar modal nav "
    "navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion promotions "
    "reactions recommendations recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored sponsors subscribe subscription toolbar topbar"
)
_HEADER_WORDS = _names("header head top")
_ARTICLE_SIDE_WORDS = _names("ad ads advert advertisement comment comments promo promoted related reply sponsored teaser")
_NEGATING = _names("has hide is no not show with without")
_MAIN_NAMES = _names("article articlebody content entry main maincontent post story")
_BODY_WORDS = _names("article body content entry post story text")

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(
    r"(?:^|[\s\"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|(?=[\s/]|$))", re.I
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|$)|\Z", re.I) for name in _RAW}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"[0-9]+")

ROOT = 0


@lru_cache(1 << 16)
def _key(parent: int, text: str) -> int:
    """The signed 64-bit number of a token below a path."""
    h = xxh64_intdigest(f"{parent}\n{text}".encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


@dataclass(frozen=True)
class Kind:
    """What the name and attributes of a tag say."""

    label: str
    #: Left out anywhere; left out unless in an article.
    dropped: bool
    header: bool
    #: 3 for an article, 2 for the main element, 1 for a name that says so.
    main: int


@lru_cache(1 << 14)
def kind_of(name: str, attributes: str) -> Kind:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), unescape((m[2] or "").strip("\"'")))
    names = [*found.get("class", "").split(), *found.get("id", "").split()]
    role = found.get("role", "").strip().lower()
    label = " ".join([name, *sorted(found.get("class", "").split()), "#" + found.get("id", ""), role])
    hidden = (
        "hidden" in found
        or found.get("aria-hidden", "").lower() == "true"
        or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I) is not None
    )
    dropped, header, main = name in _DROPPED or role in _DROPPED_ROLES or hidden, name == "header", 0
    side = _ARTICLE_SIDE_WORDS if name in ("article", "main") else _SIDE_WORDS
    if name not in ("html", "body"):
        for each in names:
            words = [w.lower() for w in _WORDS.findall(each)]
            if not words or words[0] in _NEGATING:
                continue
            dropped |= words[0] in side or words[-1] in side
            header |= words[-1] in _HEADER_WORDS and not _BODY_WORDS & set(words)
            if "".join(words) in _MAIN_NAMES or (words[-1] in _BODY_WORDS and words[0] in _MAIN_NAMES):
                main = 1
    if name == "article":
        main = 3
    elif name == "main" or role == "main":
        main = 2
    return Kind(label, dropped, header and name not in ("article", "main"), main)


@dataclass
class Run:
    """A run of text between two tags."""

    block: int
    element: int
    token: int
    text: str


@dataclass
class Page:
    """Tokens in page order, runs of text, and the elements as parallel lists."""

    tokens: list[int] = field(default_factory=list)
    runs: list[Run] = field(default_factory=list)
    parent: list[int] = field(default_factory=lambda: [-1])
    name: list[str] = field(default_factory=lambda: [""])
    path: list[int] = field(default_factory=lambda: [0])
    dropped: list[bool] = field(default_factory=lambda: [False])
    #: For each rank of main elements the outermost one around an element, or -1.
    main: list[tuple[int, int, int]] = field(default_factory=lambda: [(-1, -1, -1)])


def parse(html: str) -> Page:
    """The tokens of a page; time grows with its length, whatever is broken in it.

    End tags that nothing opened, tags and comments that never end, and elements that
    others end are taken as browsers take them.
    """
    page, stack, open_, block, at, start = Page(), [ROOT], {}, 0, 0, 0
    tag_pattern, size = _TAG, len(html)
    seen: dict[int, int] = {}

    def text_until(end: int) -> None:
        if start < end and not (raw := html[start:end]).isspace():
            element = stack[-1]
            text = unescape(raw)
            folded = " ".join(_DIGITS.sub("0", text).split())
            if folded:
                token = _key(page.path[element], "=" + folded) if len(folded) < 200 else _long(page.path[element], folded)
                page.tokens.append(token)
                page.runs.append(Run(block, element, token, text))
                return
        if start < end and page.runs:
            page.runs.append(Run(block, stack[-1], 0, " "))

    def pop_to(depth: int) -> None:
        for element in stack[depth:]:
            open_[page.name[element]] -= 1
        del stack[depth:]

    while True:
        lt = html.find("<", at)
        if lt < 0 or lt + 1 == size:
            text_until(size)
            return page
        after = html[lt + 1]
        if after == "!" or after == "?":
            text_until(lt)
            comment = html.startswith("!--", lt + 1)
            end = html.find("-->" if comment else ">", lt + 2)
            at = start = size if end < 0 else end + (3 if comment else 1)
            continue
        if not (after.isascii() and after.isalpha()) and after != "/":
            at = lt + 1
            continue
        m = tag_pattern.match(html, lt)
        if m is None and after == "/" and not html[lt + 2 : lt + 3].isalpha():
            text_until(lt)
            end = html.find(">", lt)
            at = start = size if end < 0 else end + 1
            continue
        if m is None:
            # A quote is left open for good; from here on every tag ends at the next bracket.
            tag_pattern = _PLAIN_TAG
            m = tag_pattern.match(html, lt)
            if m is None:
                text_until(lt)
                return page
        text_until(lt)
        at = start = m.end()
        name = m[2].lower()
        is_block = name in _BLOCK
        block += is_block
        if m[1]:
            if not open_.get(name):
                page.tokens.append(_key(page.path[stack[-1]], "/" + name))
                continue
            depth = len(stack) - 1
            while page.name[stack[depth]] != name:
                if not is_block and page.name[stack[depth]] in _BLOCK:
                    break
                depth -= 1
            else:
                page.tokens.append(_key(page.path[stack[depth]], "/"))
                pop_to(depth)
            continue
        for ended, between in _CLOSES.get(name, ()):
            if any(open_.get(x) for x in ended):
                depth = len(stack) - 1
                while depth and page.name[stack[depth]] not in ended and page.name[stack[depth]] not in between:
                    depth -= 1
                if depth and page.name[stack[depth]] in ended:
                    pop_to(depth)
        kind = kind_of(name, m[3].strip() if len(m[3]) < 4096 else "")
        parent = stack[-1]
        path = _key(page.path[parent], kind.label)
        page.tokens.append(path)
        if name in _VOID:
            if name == "br" and page.runs:
                page.runs.append(Run(block, parent, 0, " "))
            continue
        inside = page.main[parent]
        dropped = page.dropped[parent] or kind.dropped or (kind.header and inside[2] < 0 and inside[1] < 0)
        element = len(page.parent)
        page.parent.append(parent)
        page.name.append(name)
        page.path.append(path)
        page.dropped.append(dropped)
        if kind.main and not dropped and inside[kind.main - 1] < 0:
            inside = (*inside[: kind.main - 1], element, *inside[kind.main :])
        page.main.append(inside)
        if name in _RAW:
            end = _RAW_END[name].search(html, at)
            at = start = end.end()
            continue
        stack.append(element)
        open_[name] = open_.get(name, 0) + 1


def _long(path: int, text: str) -> int:
    """As ``_key``, without keeping a long text."""
    return _key.__wrapped__(path, "=" + text)
