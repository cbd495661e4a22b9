"""Character references of HTML, decoded once each, as browsers decode them."""

from __future__ import annotations

import html
import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]{0,31};?)"

# The public table of names, with their semicolon; some are known without it, too.
NAMES = dict(html5)
BARE = sorted((name for name in NAMES if not name.endswith(";")), key=lambda name: (-len(name), name))
# Names that pages use most; they are looked up first, as a map is searched from its start.
COMMON = ("amp;", "quot;", "nbsp;", "lt;", "gt;", "apos;", "copy;", "middot;", "amp", "nbsp")
# Numbers below 160 that do not stand for the character of that number.
ODD = {str(n): html.unescape(f"&#{n};") for n in range(160) if html.unescape(f"&#{n};") != chr(n)}
REPLACEMENT = "\ufffd"


def _table(values: dict[str, str]) -> Column:
    """A constant map; the optimizer makes one value of it."""
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


def _numeric(reference: Column) -> Column:
    """The character of a decimal or hexadecimal number of any length."""
    is_hex = F.lower(F.substring(reference, 3, 1)) == "x"
    digits = F.regexp_extract(reference, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
    # Longer numbers are beyond the last character.
    short = F.substring(digits, 1, 8)
    number = F.when(is_hex, F.conv(short, 16, 10)).otherwise(F.conv(short, 10, 10)).cast("long")
    number = F.when(F.length(digits) > 8, F.lit(0x110000).cast("long")).otherwise(
        F.coalesce(number, F.lit(0).cast("long"))
    )
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    no_char = number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(0xFFFE) == 0xFFFE)
    return (
        F.when(number < 160, F.coalesce(F.try_element_at(_table(ODD), number.cast("string")), char))
        .when(number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), F.lit(REPLACEMENT))
        .when(no_char, F.lit(""))
        .otherwise(char)
    )


def _named(reference: Column) -> Column:
    """The characters of a name; of an unknown one, those of the longest name it begins with."""
    name = F.substring(reference, F.lit(2), F.length(reference))
    first = _table({k: NAMES[k] for k in COMMON})
    known = _table(NAMES)
    begun = F.regexp_extract(name, f"^({'|'.join(BARE)})", 1)
    rest = F.substring(name, F.length(begun) + 1, F.length(name))
    whole = F.coalesce(F.try_element_at(first, name), F.try_element_at(known, name))
    part = F.when(begun != "", F.concat(F.try_element_at(known, begun), rest))
    return F.coalesce(whole, part, reference)


def decode_references(text: Column) -> Column:
    """Replace each reference by its characters; what comes out is not looked at again."""
    between = F.split(text, REFERENCE, -1)
    found = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))

    def decoded(reference: Column) -> Column:
        return F.when(reference.startswith("&#"), _numeric(reference)).otherwise(_named(reference))

    joined = F.zip_with(
        between, found, lambda a, b: F.when(b.isNull(), a).otherwise(F.concat(a, decoded(b)))
    )
    return F.when(text.contains("&"), F.array_join(joined, "")).otherwise(text)
