"""Porter stemming as column expressions.

The rules are those of M. F. Porter, "An algorithm for suffix stripping" (1980),
with the extensions that the Python NLP toolkits switch on by default: a few
irregular words, short -ies/-ied words, -y only after a consonant, -fulli, -logi.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Irregular words, then suffix -> replacement for steps 2 to 4.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "fulli": "ful", "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()

# A word is [C](VC)^m[V]; a leading y is written Y, so that it counts as a consonant.
CONSONANTS = "[^aeiou][^aeiouy]*"
VOWELS = "[aeiouy][aeiou]*"
M_ABOVE_0 = f"^(?:{CONSONANTS})?{VOWELS}{CONSONANTS}"
M_ABOVE_1 = f"{M_ABOVE_0}{VOWELS}{CONSONANTS}"
M_IS_1 = f"{M_ABOVE_0}(?:{VOWELS})?$"
HAS_VOWEL = "[aeiouy]"
SHORT = f"^(?:{CONSONANTS}[aeiouy][^aeiouwxyY]|[aeiou][^aeiou])$"
DOUBLED = "(?:" + "|".join(c * 2 for c in "bcdfghjkmnpqrtvwx") + ")$"


def _cut(word: Column, count: int | Column) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - count)


def _suffix(word: Column, suffixes) -> Column:
    return F.regexp_extract(word, "(" + "|".join(suffixes) + ")$", 1)


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def with_stem(df: DataFrame, term: str = "term", stem: str = "stem") -> DataFrame:
    """Add the stem of a column of lower-case words.

    Each step is a projection of its own, so that no step is evaluated twice.
    """
    w, s = F.col("_word"), F.col("_suffix")
    df = df.withColumn("_word", F.regexp_replace(F.lower(F.col(term)), "^y", "Y"))

    plural = (
        F.when(w.rlike("^.ies$"), _cut(w, 1))
        .when(w.rlike("(?:ss|i)es$"), _cut(w, 2))
        .when(w.rlike("[^s]s$"), _cut(w, 1))
        .otherwise(w)
    )
    df = df.withColumn("_word", plural)

    # -eed and -ied end the step; -ed and -ing go on with what is left of the word.
    df = df.withColumn("_suffix", _suffix(w, ["eed", "ied", "ed", "ing"]))
    df = df.withColumn("_rest", _cut(w, F.length(s)))
    rest = F.col("_rest")
    mended = (
        F.when(rest.rlike("(?:at|bl|iz)$"), F.concat(rest, F.lit("e")))
        .when(rest.rlike(DOUBLED), _cut(rest, 1))
        .when(rest.rlike("(?:ll|ss|zz)$"), rest)
        .when(rest.rlike(M_IS_1) & rest.rlike(SHORT), F.concat(rest, F.lit("e")))
        .otherwise(rest)
    )
    past = (
        F.when(s == "ied", F.when(F.length(w) == 4, _cut(w, 1)).otherwise(_cut(w, 2)))
        .when(s == "eed", F.when(rest.rlike(M_ABOVE_0), _cut(w, 1)).otherwise(w))
        .when((s != "") & rest.rlike(HAS_VOWEL), mended)
        .otherwise(w)
    )
    df = df.withColumn("_word", past)

    df = df.withColumn(
        "_word",
        F.when(w.rlike("^.+[^aeiouy]y$"), F.concat(_cut(w, 1), F.lit("i"))).otherwise(w),
    )

    for table in (STEP_2, STEP_3):
        df = df.withColumn("_suffix", _suffix(w, table))
        df = df.withColumn("_rest", _cut(w, F.length(s)))
        measured = F.when(s == "logi", F.concat(rest, F.lit("l"))).otherwise(rest)
        df = df.withColumn(
            "_word",
            F.when((s != "") & measured.rlike(M_ABOVE_0), F.concat(rest, _lookup(table, s)))
            .otherwise(w),
        )

    df = df.withColumn("_suffix", _suffix(w, STEP_4))
    df = df.withColumn("_rest", _cut(w, F.length(s)))
    longer = (s != "") & rest.rlike(M_ABOVE_1) & ((s != "ion") | rest.rlike("[st]$"))
    df = df.withColumn("_word", F.when(longer, rest).otherwise(w))

    df = df.withColumn("_rest", _cut(w, 1))
    silent = rest.rlike(M_ABOVE_1) | (rest.rlike(M_IS_1) & ~rest.rlike(SHORT))
    df = df.withColumn("_word", F.when(w.endswith("e") & silent, rest).otherwise(w))

    df = df.withColumn(
        "_word",
        F.when(w.endswith("ll") & _cut(w, 1).rlike(M_ABOVE_1), _cut(w, 1)).otherwise(w),
    )

    lower = F.lower(F.col(term))
    result = F.coalesce(
        _lookup(IRREGULAR, lower), F.when(F.length(lower) <= 2, lower), F.lower(w)
    )
    return df.withColumn(stem, result).drop("_word", "_suffix", "_rest")
