"""HTML as lines of text: one for each block of the page."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

# Comments, declarations, and tags with quoted attributes.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
# Elements whose content is no markup. Code without an end takes the rest of the page, as in browsers.
_RAW = frozenset("script style title textarea noscript template iframe svg xmp".split())
_CODE = frozenset("script style".split())
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "option p pre search section select summary table tbody tfoot thead tr ul".split()
)
_SPACED = frozenset("br td th img input button label wbr video audio object embed".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that never belong to an article.
_OUTSIDE = frozenset("nav footer aside menu dialog select button head search".split())
_FORMS = frozenset("form fieldset".split())
_BODIES = frozenset("article main".split())
# Words that pages give to such parts, alone or with words of layout; those of the second list tell
# as the first or last word of any name.
_NAMES = frozenset(
    "ad ads advertising sponsor sponsored sponsors promo promoted banner nav menu menus header aside rail "
    "widget widgets cookie cookies consent notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended comment respond reply replies "
    "discussion toolbar complementary contentinfo search".split()
)
_TELLING = frozenset(
    "advert adverts advertisement navbar navigation breadcrumb breadcrumbs masthead footer sidebar "
    "gdpr paywall comments commentlist disqus pagination pager".split()
)
_LAYOUT = frozenset(
    "site page main top bottom left right upper lower middle center box boxes container wrapper wrap block blocks "
    "section area list item items bar inner outer content body links link button buttons icons icon inline "
    "primary secondary global local sticky fixed floating mobile desktop js fb wp user reader readers thread form "
    "article articles post posts story stories entry media network networks slot unit panel card cards grid "
    "row col column module component region zone group results result view layer tools more text message "
    "policy privacy wall in up tag input field".split()
)
_NOT_NAMES = frozenset("no with without has have hide free".split())


@dataclass
class Line:
    """Text of a block; `outside` of any article by its elements; `named` so; in a `body`.

    form: in a form. place: number of the block element around it in `Page.parents`.
    """

    text: str
    links: int
    outside: bool
    named: bool
    body: int
    form: bool = False
    place: int = 0


@dataclass
class Page:
    lines: list[Line] = field(default_factory=list)
    title: str = ""
    lang: str = ""
    hrefs: list[str] = field(default_factory=list)
    #: Of each block element, in the order of the page: the one around it, and the last one inside.
    #: Number 0 is the page itself.
    parents: list[int] = field(default_factory=lambda: [0])
    lasts: list[int] = field(default_factory=lambda: [0])


def _attributes(raw: str) -> dict[str, str]:
    return {
        m[1].lower(): unescape(next((g for g in m.groups()[1:] if g is not None), ""))
        for m in reversed(list(_ATTRIBUTE.finditer(raw)))
    }


def _is_named(name: str, attrs: dict[str, str], in_body: bool) -> bool:
    """Whether a part's class, id or role says that it is no part of an article."""
    if name in ("html", "body") or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return name not in ("html", "body")
    if re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I):
        return True
    for given in " ".join(attrs.get(k, "") for k in ("class", "id", "role")).split():
        words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", given).lower())
        if not words or words[0] in _NOT_NAMES or words[-1] in _NOT_NAMES:
            continue
        # An article's own header holds its title.
        meant = {w for w in words if w in _NAMES and not (w == "header" and in_body)}
        if meant and all(w in _NAMES or w in _TELLING or w in _LAYOUT or len(w) == 1 for w in words):
            return True
        if words[0] in _TELLING or words[-1] in _TELLING:
            return True
    return False


def _tokens(html: str):
    """Tags, comments and declarations: match, end, and content where that is no markup."""
    unended: set[str] = set()
    at = 0
    while m := _TOKEN.search(html, at):
        at, body = m.end(), None
        name = (m["name"] or "").lower()
        if name in _RAW and not m["end"] and not m["attrs"].endswith("/") and name not in unended:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            if end:
                at, body = end.end(), html[at : end.start()]
            elif name in _CODE:
                at, body = len(html), html[at:]
            else:
                unended.add(name)
        yield m, at, body


def _ended_links(tokens) -> set[int]:
    """Where the links begin whose end comes before the next link."""
    ended, begun = set(), None
    for m, _, _ in tokens:
        if (m["name"] or "").lower() == "a":
            if m["end"] and begun is not None:
                ended.add(begun)
            begun = None if m["end"] else m.start()
    return ended


def read_page(html: str) -> Page:
    """The page's lines, in order; white space in a line is one space.

    An anchor is a link if it has an address. It ends at its end, at the next anchor, or, where
    neither comes first, at the next block.
    """
    page, parts, linked = Page(), [], 0
    # Name; whether outside, named, a body, a form; number of the block.
    open_: list[tuple[str, bool, bool, bool, bool, int]] = []
    opened: Counter[str] = Counter()
    tokens = list(_tokens(html))
    closes = Counter(m["name"].lower() for m, _, _ in tokens if m["name"] and m["end"])
    ended = _ended_links(tokens)
    outside = named = body = bodies = forms = number = 0
    in_link = until_block = False

    def end_line() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            place = open_[-1][5] if open_ else 0
            page.lines.append(Line(text, linked, outside > 0, named > 0, number if body else 0, forms > 0, place))
        parts.clear()
        linked = 0

    def drop(first: int) -> None:
        nonlocal outside, named, body, forms
        for name, is_outside, is_named, is_body, is_form, place in reversed(open_[first:]):
            opened[name] -= 1
            outside -= is_outside
            named -= is_named
            body -= is_body
            forms -= is_form
            if name in _BLOCKS:
                page.lasts[place] = len(page.parents) - 1
        del open_[first:]

    at = 0
    for m, after, content in [*tokens, (None, 0, None)]:
        between = html[at : m.start()] if m else html[at:]
        if between:
            text = unescape(between)
            parts.append(text)
            if in_link:
                linked += len(text.strip())
        if m is None:
            break
        at = after
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if name in _RAW:
            parts.append(" ")
            if name == "title" and content and not page.title:
                page.title = " ".join(unescape(content).split())
            continue
        if name in _BLOCKS:
            end_line()
            in_link = in_link and not until_block
        elif name in _SPACED:
            parts.append(" ")
        if m["end"]:
            closes[name] -= 1
            in_link = in_link and name != "a"
            if opened[name]:
                drop(next(i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name))
            continue
        raw = m["attrs"]
        attrs = _attributes(raw) if raw.strip(" /\n\t\r") else {}
        if name == "html" and attrs.get("lang"):
            page.lang = attrs["lang"]
        if name == "a":
            if attrs.get("href"):
                page.hrefs.append(attrs["href"])
            in_link, until_block = "href" in attrs, m.start() not in ended
            continue
        if name == "body":
            # Whatever the head left open ends here.
            drop(0)
        if name in _VOID or raw.rstrip().endswith("/"):
            continue
        # A part that is never closed cannot take the rest of the page along.
        closed = closes[name] > 0 or name == "head"
        is_named = bool(attrs) and closed and _is_named(name, attrs, body > 0)
        if not closed or (name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and not is_named):
            continue
        is_outside = name in _OUTSIDE or (name == "header" and not body)
        is_body = name in _BODIES and not is_named
        if is_body and not body:
            bodies += 1
            number = bodies
        place = open_[-1][5] if open_ else 0
        if name in _BLOCKS:
            page.parents.append(place)
            place = len(page.parents) - 1
            page.lasts.append(place)
        open_.append((name, is_outside, is_named, is_body, name in _FORMS, place))
        opened[name] += 1
        outside += is_outside
        named += is_named
        body += is_body
        forms += name in _FORMS
    end_line()
    drop(0)
    page.lasts[0] = len(page.parents) - 1
    return page
