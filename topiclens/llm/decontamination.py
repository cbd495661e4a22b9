"""Benchmark passages in documents, found by winnowing.

Of every window of `span` words the least hash of its k-grams is kept; equal windows keep
equal hashes, so each shared span of `span` words or more is found. A run of windows that
keep the same hash is one fingerprint. Fingerprints that documents and test items share are
extended to whole windows, and hit words are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclens.llm.common import cut

SPAN = 10
GRAM = 5
#: Rows of test data that are copied to all executors; 32 bytes or so each. More are shuffled.
COPIED_ROWS = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words in lower case: runs of a-z, 0-9 and all characters beyond ASCII."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN)
    return F.filter(parts, lambda w: w != "")


def _after(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.size(values))


def _paired(values: Column, others: Column) -> Column:
    return F.zip_with(values, others, lambda a, b: F.xxhash64(a, b))


def _least(values: Column, others: Column) -> Column:
    return F.zip_with(values, others, lambda a, b: F.least(a, b))


def _with_grams(df: DataFrame, length: int, name: str) -> DataFrame:
    """Add hashes of the word runs of `length` that start at each word of `h`.

    The last length - 1 places hold no whole run and are not to be used.
    """
    if length == 1:
        return df.withColumn(name, F.col("h"))
    half = f"{name}_{length // 2 if length % 2 == 0 else length - 1}"
    if length % 2 == 0:
        df = _with_grams(df, length // 2, half)
        return df.withColumn(name, _paired(F.col(half), _after(F.col(half), length // 2)))
    df = _with_grams(df, length - 1, half)
    return df.withColumn(name, _paired(F.col(half), _after(F.col("h"), length - 1)))


def _hashed(df: DataFrame, text: str, *keys: Column) -> DataFrame:
    words = df.select(*keys, words_of(F.col(f"`{text}`")).alias("words"))
    return words.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("h")).drop("words")


def _windows(df: DataFrame, span: int, gram: int) -> DataFrame:
    """Add, for each window of `span` words: `kept`, its least k-gram hash, and `window`, its own."""
    n = F.greatest(F.size("h") - (span - 1), F.lit(0))
    df = _with_grams(df.where(F.size("h") >= span), gram, "g")
    df = _with_grams(df, span, "w")
    reach, name = 1, "g"
    wide = span - gram + 1  # k-grams in a window
    while reach * 2 <= wide:
        df = df.withColumn(f"m{reach * 2}", _least(F.col(name), _after(F.col(name), reach)))
        reach, name = reach * 2, f"m{reach * 2}"
    if reach < wide:
        df = df.withColumn("m", _least(F.col(name), _after(F.col(name), wide - reach)))
        name = "m"
    return df.withColumns({"kept": F.slice(name, 1, n), "window": F.slice("w", 1, n)})


def fingerprints(df: DataFrame, span: int, gram: int, *keys: str) -> DataFrame:
    """A row for each run of windows that keep one hash: keys, kept, at, windows.

    df: keys and `h`, the hashes of the words. at: the first window's place; windows: the
    hashes of the run's windows.
    """
    made = _windows(df, span, gram).select(*keys, "kept", "window")
    starts = F.filter(
        F.sequence(F.lit(1), F.size("kept")),
        lambda i: (i == 1) | (F.get("kept", i - 1) != F.get("kept", i - 2)),
    )
    made = made.withColumn("starts", starts)
    runs = F.zip_with(
        "starts",
        _after(F.col("starts"), 1),
        lambda i, j: F.struct(
            F.get("kept", i - 1).alias("kept"),
            (i - 1).alias("at"),
            F.slice("window", i, F.coalesce(j, F.size("kept") + 1) - i).alias("windows"),
        ),
    )
    return made.select(*keys, F.inline(runs))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Copy a table of proven size to all executors; leave a larger one to the planner."""
    return F.broadcast(df) if rows <= COPIED_ROWS else df


def passage_hits(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
) -> DataFrame:
    """(hit_id, hit_sum, n_hit, items): documents that hold a window, and the items' ids.

    hit_sum is a hash of the text, so that rows that repeat an id are told apart.
    """
    key = [F.col(f"`{id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("sum")]
    tests = _hashed(items.where(F.col(f"`{item_id}`").isNotNull()), item_text, F.col(f"`{item_id}`").alias("item"))
    tests = cut(tests.where(F.size("h") > 0))
    lengths = sorted(
        r[0] for r in tests.select(F.size("h")).where(F.size("h") < span).distinct().collect()
    )  # at most span - 1 numbers
    long = _windows(tests, span, gram).select("item", F.inline(F.arrays_zip("kept", "window")))
    found = long.select("item", "kept", "window", F.lit(span).alias("length"))
    for length in lengths:
        whole = _with_grams(tests.where(F.size("h") == length), length, "w")
        whole = whole.select("item", F.get("w", F.lit(0)).alias("window"))
        found = found.unionByName(
            whole.select("item", F.col("window").alias("kept"), "window", F.lit(length).alias("length"))
        )
    # Windows that the same items hold are one class.
    owners = F.array_sort(F.collect_set(F.col("item").cast("string")))
    windows = found.groupBy("length", "kept", "window").agg(owners.alias("items"))
    windows = cut(windows.withColumn("owner", F.xxhash64("items")))
    n_windows = windows.count()

    hashed = _hashed(docs, text, *key)
    prints = fingerprints(hashed, span, gram, "id", "sum")
    marks = windows.where(F.col("length") == span).select("kept").distinct()
    hits = prints.join(_small(marks, n_windows), "kept").select(
        "id", "sum", "kept", "at", F.posexplode("windows").alias("pos", "window")
    )
    hits = hits.select("id", "sum", "kept", "window", (F.col("at") + F.col("pos")).alias("at"), F.lit(span).alias("length"))
    for length in lengths:
        short = _with_grams(hashed.where(F.size("h") >= length), length, "w")
        short = short.select(
            "id", "sum", F.posexplode(F.slice("w", 1, F.size("h") - (length - 1))).alias("at", "window")
        )
        hits = hits.unionByName(
            short.select("id", "sum", F.col("window").alias("kept"), "window", "at", F.lit(length).alias("length"))
        )
    lookup = windows.select("length", "kept", "window", "owner")
    hits = hits.join(_small(lookup, n_windows), ["length", "kept", "window"])
    each = hits.groupBy("id", "sum").agg(
        F.array_sort(F.collect_set(F.struct("at", "length"))).alias("spans"),
        F.collect_set("owner").alias("owners"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["at"] + x["length"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), x["at"] + x["length"] - F.greatest(s["end"], x["at"]))).alias("n"),
        ),
        lambda s: s["n"],
    )
    each = cut(each.select("id", "sum", covered.alias("n_hit"), "owners"))
    classes = windows.select("owner", "items").dropDuplicates(["owner"])
    held = (
        each.select("id", "sum", F.explode("owners").alias("owner"))
        .join(classes, "owner")
        .select("id", "sum", F.explode("items").alias("item"))
        .groupBy("id", "sum")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    held = held.withColumnsRenamed({"id": "held_id", "sum": "held_sum"})
    each = each.drop("owners").join(
        held, F.col("id").eqNullSafe(F.col("held_id")) & (F.col("sum") == F.col("held_sum"))
    ).drop("held_id", "held_sum")
    return each.withColumnsRenamed({"id": "hit_id", "sum": "hit_sum"})


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated), a row for each row of docs.

    A window is `span` consecutive words of an item, or a shorter item as a whole. n_hit
    counts the document's words inside any occurrence of a window, n_items the items whose
    windows occur; items_sha256 is the SHA-256 of their ids, sorted as strings, joined by
    commas. Null and empty texts have no words. Items with a null id are left out; an empty
    table of items hits nothing. Windows count as equal if two 64-bit hashes of their words
    are. Rows that repeat an id are judged each by its own text; other columns are not looked
    at.
    """
    each = passage_hits(docs, items, id, text, item_id, item_text, span, gram)
    counted = docs.select(
        F.col(f"`{id}`").alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("sum"),
        F.size(words_of(F.col(f"`{text}`"))).cast("long").alias("n_words"),
    )
    out = counted.join(
        each, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("sum") == F.col("hit_sum")), "left"
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    found = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        F.col("id").alias(id),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(found).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", found).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def without_passages(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that hold no window of an item; all columns stay."""
    each = passage_hits(docs, items, id, text)
    same = docs[id].eqNullSafe(each["hit_id"]) & (F.xxhash64(docs[text]) == each["hit_sum"])
    return docs.join(each, same, "left_anti")
