"""The main text of web pages by the distribution of line blocks.

A page without its markup is a list of lines; lines of menus, notices and the like count as
empty. The length of the text in a window of lines, taken at each line, is near nothing
outside the article. It surges where the article begins and dives where it ends; the lines
between are kept. Marks (`article`, `main`) are believed where the text is: only if what they
hold has the page's longest window and at least half of its text, is the page read inside them.
Forms count as empty, unless one is around the page: if forms hold a dense window, the page's
longest, and more text than is outside of them, they say nothing.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclens.llm.common import map_texts
from topiclens.llm.html_lines import Line, Page, read_page

#: Lines in a window.
WINDOW = 3
#: A stretch of lines is kept if its longest window has this share of the page's longest,
#: or so many letters, however long others are.
SHARE = 0.2
DENSE = 80
#: Link lines in a row that are a list of links, if they have fewer letters than this on average.
LISTED = 2
LONG_LINK = 120
#: A line of which more is links is a link line.
MOST_LINKED = 0.6


def line_lengths(lines: list[Line], named: bool) -> list[int]:
    """Length of each line's text, 0 for those that are no part of an article."""
    lengths = [0 if x.outside or x.form or (named and x.named) else len(x.text) for x in lines]
    at = 0
    while at < len(lines):
        end = at
        while end < len(lines) and lengths[end] and lines[end].links > MOST_LINKED * lengths[end]:
            end += 1
        # A link line by itself, or long ones, may be a paragraph that quotes.
        if end - at >= LISTED and sum(lengths[at:end]) < LONG_LINK * (end - at):
            lengths[at:end] = [0] * (end - at)
        at = max(end, at + 1)
    return lengths


def marked_lengths(lines: list[Line], lengths: list[int], named: bool) -> list[int] | None:
    """Lengths of the lines that the page marks as its article's; None if its text is elsewhere.

    The lines marked must have the longest window and at least half of all text. Of these
    lines, those that are mostly links count too.
    """
    inside = [
        len(x.text) if x.body and not (x.outside or x.form or (named and x.named)) else 0 for x in lines
    ]
    beside = [0 if x.body else n for n, x in zip(lengths, lines)]
    most_inside = max((m for _, _, m in stretches(inside)), default=0)
    most_beside = max((m for _, _, m in stretches(beside)), default=0)
    return inside if most_inside >= max(1, most_beside) and sum(inside) >= sum(beside) else None


def stretches(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """From each surge to its dive: first line, line after the last, and the longest window.

    Windows begin at a line and cover `window` lines. Text surges where a window holds some
    after one that began with none, and dives where a whole window is empty.
    """
    found, n = [], len(lengths)
    at = 0
    while at < n:
        if not lengths[at]:
            at += 1
            continue
        first = at
        while at < n and any(lengths[at : at + window]):
            at += 1
        last = at
        while last > first and not lengths[last - 1]:
            last -= 1
        found.append((first, last, max(sum(lengths[i : i + window]) for i in range(first, last))))
    return found


def forget_wide_forms(lines: list[Line]) -> None:
    """Lines are in no form if forms hold the page's text rather than fields."""
    if not any(x.form for x in lines):
        return
    text = [0 if x.outside or x.named or x.links > MOST_LINKED * len(x.text) else len(x.text) for x in lines]
    inside = [n if x.form else 0 for n, x in zip(text, lines)]
    beside = [0 if x.form else n for n, x in zip(text, lines)]
    most_inside, most_beside = (max((m for _, _, m in stretches(v)), default=0) for v in (inside, beside))
    if most_inside >= max(DENSE, most_beside) and sum(inside) > sum(beside):
        for x in lines:
            x.form = False


def main_text(html: str | None) -> str:
    """A page's article: its blocks, one a line. No page, no text."""
    if not html:
        return ""
    page = read_page(html)
    lines = page.lines
    forget_wide_forms(lines)
    # If all was named as something else, the names say nothing.
    for named in (True, False):
        lengths = line_lengths(lines, named)
        inside = marked_lengths(lines, lengths, named)
        if inside or any(lengths):
            break
    if inside:
        return "\n".join(x.text for n, x in zip(inside, lines) if n)
    found = []
    # Marked parts and the text around them are judged each by itself.
    for first, last in _parts(lines):
        found += [(first + a, first + b, m) for a, b, m in stretches(lengths[first:last])]
    kept = _kept(page, lengths, found)
    return "\n".join(lines[i].text for first, last in kept for i in range(first, last) if lengths[i])


def _kept(page: Page, lengths: list[int], found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The stretches of an article: dense ones, and lines of others that are in their element.

    What cuts a short ending off from its article is then inside the article's element, such
    as adverts between its paragraphs. A line alone in its element counts as the outer one's.
    """
    lines, parents, lasts = page.lines, page.parents, page.lasts
    bar = min(DENSE, SHARE * max((m for _, _, m in found), default=0))
    alone = Counter(x.place for n, x in zip(lengths, lines) if n)

    def place(i: int) -> int:
        own = lines[i].place
        return parents[own] if parents[own] and alone[own] == 1 else own

    # Elements are numbered in the order of the page, so what is inside one has the numbers up to its last.
    around: dict[int, set[int]] = {}
    for first, last, longest in found:
        if longest >= bar:
            places = [place(i) for i in range(first, last) if lengths[i]]
            common, furthest = min(places), max(places)
            while lasts[common] < furthest:
                common = parents[common]
            around.setdefault(lines[first].body, set()).add(common)
    outermost: dict[int, list[int]] = {}
    for body, elements in around.items():
        chosen = outermost[body] = []
        for x in sorted(elements - {0}):
            if not chosen or x > lasts[chosen[-1]]:
                chosen.append(x)

    def within(i: int) -> bool:
        # Without an element around the dense ones, only lines that have none either.
        own, body = place(i), lines[i].body
        chosen = outermost.get(body, [])
        at = bisect_right(chosen, own) - 1
        return (at >= 0 and own <= lasts[chosen[at]]) or (own == 0 and 0 in around.get(body, ()))

    kept = []
    for first, last, longest in found:
        inside = [i for i in range(first, last) if lengths[i] and (longest >= bar or within(i))]
        if inside:
            kept.append((inside[0], inside[-1] + 1))
    return kept


def _parts(lines: list[Line]) -> list[tuple[int, int]]:
    """First line and line after the last, from one change of the marked part to the next."""
    ends = [i for i in range(1, len(lines)) if lines[i].body != lines[i - 1].body]
    return list(zip([0, *ends], [*ends, len(lines)]))


def extracted(pages: DataFrame, id: str = "page_id", html: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """(id, kept columns, text, n_chars), a row for each row of pages.

    Null and empty pages have an empty text. Character references are decoded once, white
    space inside a block is one space, blocks are joined by a line feed. Columns beyond those
    named are not looked at; repeated rows are read each by itself.
    """
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id, *keep)}

    def make():
        def apply(htmls, *others):
            texts = [main_text(h) for h in htmls]
            return [*others, texts, [len(t) for t in texts]]

        return apply

    names = ", ".join(f"c{i} {kind}" for i, kind in enumerate(kinds.values()))
    out = map_texts(pages, [html, id, *keep], make, f"{names}, text string, n_chars bigint", text=0)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kinds)], "text", "n_chars")
