"""Text columns: page markup, cleaning, tokens."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from topiclens.functions.references import decode_references
from topiclens.functions.wordlists import STOP_WORDS

# Everything in a page that is never text; without an end it goes on to the page's end.
HIDDEN = (
    r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)"
)
# A tag; a quoted attribute may hold the sign that ends it.
_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_TAG = r"</?[a-zA-Z]" + _REST
_NAME = r"<(/?[a-zA-Z][^\s/>]*+)" + _REST
# Elements without an end, and those whose start ends an open paragraph.
_VOID = "area base br col embed hr img input link meta param source track wbr".split()
_BLOCKS = (
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul"
).split()
_TABLE = "tbody thead tfoot tr td th caption".split()
_ALL_BLOCKS = [*_BLOCKS, *_TABLE, "li", "dt", "dd", "option", "select", "body", "html"]
_CELLS = ["table", "td", "th", "caption", "button"]
# Names whose start ends elements: of which names, and the names these do not reach beyond.
_IMPLIED = [
    (_BLOCKS, ["p"], _CELLS),
    (["li"], ["li", "p"], ["ul", "ol", "menu", *_CELLS]),
    (["dt", "dd"], ["dt", "dd", "p"], ["dl", *_CELLS]),
    (["option"], ["option"], ["select"]),
    (["td", "th"], ["td", "th", "caption"], ["table"]),
    (["tr"], ["tr", "td", "th", "caption"], ["table"]),
    (["tbody", "thead", "tfoot"], ["tbody", "thead", "tfoot", "tr", "td", "th", "caption"], ["table"]),
    (["body"], ["head"], []),
]
NUMERIC_TOKEN = r"^\p{N}+$"
# What counts as markup in text that is no page.
INLINE_TAG = r"<[^\n]+?>"


def _bound(value: Column, body) -> Column:
    """body of a value that is computed once: a one-element array gives it a name."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _names(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def _marks(html: Column) -> Column:
    """Each tag's name and number, whether it ends an element, what it ends, and what stops that."""

    def mark(raw: Column, i: Column) -> Column:
        ends = raw.startswith("/")
        name = F.when(ends, F.substr(raw, F.lit(2))).otherwise(raw)
        closes = F.when(ends, F.array(name))
        stops = F.when(ends & name.isin(*_TABLE), _names(["table"])).when(
            ends & name.isin("table", "body", "html"), _names([])
        )
        stops = stops.when(ends & name.isin(*_ALL_BLOCKS), _names(_CELLS[:-1])).when(ends, _names(_ALL_BLOCKS))
        for starts, closed, barrier in _IMPLIED:
            closes = closes.when(name.isin(*starts), _names(closed))
            stops = stops.when(name.isin(*starts), _names(barrier))
        return F.struct(
            name.alias("name"), (i + 1).alias("at"), ends.alias("ends"),
            closes.otherwise(_names([])).alias("closes"), stops.otherwise(_names([])).alias("stops"),
        )

    return F.transform(F.transform(F.regexp_extract_all(html, F.lit(_NAME), F.lit(1)), F.lower), mark)


def _spans(html: Column, tag: str) -> Column:
    """Numbers of the tags where each `tag` element starts and ends, in order of the starts.

    One pass over the tags with a stack of the open elements. A start ends what it implies the
    end of; an end ends all within its element, and is ignored where none is open.
    """
    none = F.array().cast("array<struct<name:string,at:int>>")

    def step(state: Column, x: Column) -> Column:
        stack = state["stack"]
        size = F.size(stack)
        places = F.sequence(F.lit(0), size - 1)
        named = lambda names: F.filter(
            F.when(size > 0, places).otherwise(F.array().cast("array<int>")),
            lambda i: F.array_contains(names, F.get(stack, i)["name"]),
        )
        barrier = F.coalesce(F.array_max(named(x["stops"])), F.lit(-1))
        closed = F.filter(named(x["closes"]), lambda i: i > barrier)
        # An end belongs to the innermost element, a start ends the outermost it implies.
        keep = F.coalesce(F.when(x["ends"], F.array_max(closed)).otherwise(F.array_min(closed)), size)
        gone = F.filter(F.slice(stack, keep + 1, F.greatest(size - keep, F.lit(0))), lambda e: e["name"] == tag)
        ended = F.transform(gone, lambda e: F.struct(e["at"].alias("a"), x["at"].alias("b")))
        kept = F.slice(stack, F.lit(1), keep)
        opened = F.array(F.struct(x["name"].alias("name"), x["at"].alias("at")))
        pushed = F.when(x["ends"] | x["name"].isin(*_VOID), kept).otherwise(F.concat(kept, opened))
        done = F.when(F.size(ended) > 0, F.concat(state["done"], ended)).otherwise(state["done"])
        return F.struct(pushed.alias("stack"), done.alias("done"))

    start = F.struct(none.alias("stack"), F.array().cast("array<struct<a:int,b:int>>").alias("done"))

    def finish(state: Column, last: Column) -> Column:
        left = F.filter(state["stack"], lambda e: e["name"] == tag)
        open_ones = F.transform(left, lambda e: F.struct(e["at"].alias("a"), last.alias("b")))
        return F.array_sort(F.concat(state["done"], open_ones))

    def fold(marks: Column) -> Column:
        return F.aggregate(marks, start, step, lambda s: finish(s, F.size(marks) + 1))

    return _bound(_marks(html), fold)


def extract_elements(html: Column, tag: str = "p", text: bool = True) -> Column:
    """The elements of a page as an array: their text, or their markup if not `text`.

    Elements come in the order in which they start, as a full parser lists them; one within
    another of its kind comes after it, and its text is in both. What has no end tag ends where
    the next element of its kind or its surrounding element does, as browsers read it.
    """
    found = _bound(F.regexp_replace(html, HIDDEN, ""), lambda shown: _elements(shown, tag.lower(), text))
    return F.when(html.isNotNull(), found)


def _elements(shown: Column, tag: str, text: bool) -> Column:
    spans = _spans(shown, tag)
    texts = F.split(shown, _TAG, -1)
    if text:
        whole = lambda x, s: decode_references(F.array_join(F.slice(x, s["a"] + 1, s["b"] - s["a"]), ""))
        return _bound(texts, lambda x: F.transform(spans, lambda s: whole(x, s)))
    marks = F.regexp_extract_all(shown, F.lit(_TAG), F.lit(0))

    def markup(x: Column, s: Column) -> Column:
        following = F.zip_with(
            F.slice(x["marks"], s["a"] + 1, s["b"] - s["a"] - 1),
            F.slice(x["texts"], s["a"] + 2, s["b"] - s["a"] - 1),
            lambda m, t: F.concat(m, t),
        )
        return F.concat(F.get(x["texts"], s["a"]), F.array_join(following, ""))

    both = F.struct(marks.alias("marks"), texts.alias("texts"))
    return _bound(both, lambda x: F.transform(spans, lambda s: markup(x, s)))


def extract_text(html: Column, tag: str = "p", sep: str = "") -> Column:
    """Text of all `tag` elements of a page, joined by `sep`."""
    return F.array_join(extract_elements(html, tag), sep)


def page_title(html: Column) -> Column:
    """The title; one in a script or a comment is none."""
    shown = F.regexp_replace(html, HIDDEN, "")
    return decode_references(F.regexp_extract(shown, r"(?is)<title[^>]*>(.*?)</title>", 1))


def straighten_apostrophes(text: Column) -> Column:
    """Typographic apostrophes to ', so that stop words such as isn't are found."""
    return _replace_all(text, {"‘": "'", "’": "'", "ʼ": "'"})


def _replace_all(text: Column, replacements: dict[str, str]) -> Column:
    for old, new in replacements.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _pieces(text: Column, pattern: str) -> Column:
    """All matches of a pattern. Far cheaper in Java than replacing its negated class."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def clean_text(text: Column) -> Column:
    """Lower-case ASCII words; other characters separate words, but ' and . stay.

    Line feeds are dropped, not turned into a space.
    """
    text = _replace_all(text, {"\n": "", "&nbsp": " "})
    # Before lower(): some non-ASCII letters lower to ASCII ones.
    return F.lower(F.array_join(_pieces(text, "[a-zA-Z0-9'.]+"), " "))


def clean_text_delete(text: Column) -> Column:
    """Delete punctuation, line feeds and non-ASCII characters; words may merge."""
    text = F.replace(text, F.lit("&nbsp;"), F.lit(" "))
    return F.array_join(_pieces(text, r"[a-zA-Z0-9 \t\r\x0B\f]+"), "")


def tokenize(text: Column) -> Column:
    """Lower-cased tokens between single whitespace characters; may hold empty tokens."""
    return F.split(F.regexp_replace(F.lower(text), r"\s+$", ""), r"\s")


def tokenize_alpha(text: Column) -> Column:
    """Lower-cased runs of ASCII letters outside of <tags>."""
    words = _pieces(F.regexp_replace(text, INLINE_TAG, " "), "[a-zA-Z]+")
    return F.transform(words, F.lower)


def drop_empty(tokens: Column) -> Column:
    return F.filter(tokens, lambda token: token != "")


def strip_punctuation(tokens: Column) -> Column:
    """Remove ASCII punctuation inside tokens."""
    return F.transform(tokens, lambda token: F.regexp_replace(token, r"\p{Punct}+", ""))


def drop_numeric(tokens: Column, compat: bool = False) -> Column:
    """Strip dots from tokens and drop the numeric ones.

    `compat` tests before stripping and keeps empty tokens: 12.5 stays, as 125.
    """
    if compat:
        kept = F.filter(tokens, lambda token: ~token.rlike(NUMERIC_TOKEN))
        return F.transform(kept, lambda token: F.replace(token, F.lit("."), F.lit("")))
    bare = F.transform(tokens, lambda token: F.replace(token, F.lit("."), F.lit("")))
    return F.filter(bare, lambda token: (token != "") & ~token.rlike(NUMERIC_TOKEN))


def article_words(text: Column) -> Column:
    """`drop_numeric(drop_empty(tokenize(clean_text(text))))` in one pass over the text.

    A word is a run of letters, digits and apostrophes that is not all digits.
    """
    # K (Kelvin) and dotted I are no ASCII letters, but lower() would make them such.
    text = _replace_all(text, {"\n": "", "&nbsp": " ", ".": "", "\u212a": " ", "\u0130": " "})
    return _pieces(F.lower(text), "[0-9]*[a-z'][a-z0-9']*")


def remove_stop_words(tokens: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Drop the listed words, whatever their case."""
    words = sorted({word.lower() for word in stop_words})
    return F.filter(tokens, lambda token: ~F.lower(token).isin(words))


def singular(token: Column) -> Column:
    """Singular of a regular English plural; other words stay as they are."""

    def ends(*suffixes: str) -> Column:
        found = F.lit(False)
        for suffix in suffixes:
            found = found | token.endswith(suffix)
        return found

    def cut(count: int) -> Column:
        return F.substring(token, F.lit(1), F.length(token) - count)

    man = F.when(F.length(token) > 3, F.concat(cut(2), F.lit("an"))).otherwise(token)
    return (
        F.when(~token.endswith("s") & ~token.endswith("men"), token)
        .when(ends("ss", "us", "is") | (F.length(token) < 3), token)
        .when(token.endswith("ies") & (F.length(token) > 4), F.concat(cut(3), F.lit("y")))
        .when(ends("ches", "shes", "sses", "xes", "zes"), cut(2))
        .when(token.endswith("men"), man)
        .otherwise(cut(1))
    )


def singulars(token: Column) -> Column:
    """What a plural may be the plural of, the likelier first: sizes may come from siz or size."""
    first = singular(token)
    bare = F.substring(token, F.lit(1), F.length(token) - 1)
    both = F.array_distinct(F.array(first, F.when(token.endswith("s"), bare).otherwise(first)))
    return F.when(first != token, both).otherwise(F.array().cast("array<string>"))


def ngrams(tokens: Column, n: int = 2) -> Column:
    """Runs of `n` neighbouring tokens, joined by a space."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(tokens) - (n - 1), F.lit(1)))
    runs = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, runs).otherwise(F.array().cast("array<string>"))


def prepared_text(text: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """One page's text, cleaned by deletion, in the singular, without stop words."""
    words = drop_empty(tokenize(clean_text_delete(text)))
    return F.array_join(remove_stop_words(F.transform(words, singular), stop_words), " ")
