"""Choosing and routing articles and crawled pages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiclens import storage
from topiclens.functions import text as text_fn
from topiclens.operators.terms import pieces

# Page classes.
OK, FAILED, REDIRECT = "ok", "failed", "redirect"
KEYWORD_TOPIC = -1
REDIRECT_MARK = "#REDIRECT"


def project(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns)


def replace_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Copy a column under a new name and drop the old one."""
    return df.withColumnRenamed(old, new)


#: Keys that a look at a table's distribution takes, about, and rows that are put in order at once.
SAMPLED, ORDERED = 2048, 4096


def key_at(df: DataFrame, key: str, position: int):
    """The unique key at a place, from 0, in its order; None if there are not as many rows.

    The place is narrowed down between sampled keys whose distances are counted; each look
    reads the keys between two bounds alone, which reach the scan. Only ORDERED rows are ever
    sorted.
    """
    keys = df.select(F.col(f"`{key}`").alias("k")).where("k IS NOT NULL")
    size = keys.count()
    if position >= size:
        return None
    while size > ORDERED:
        share = F.pmod(F.xxhash64("k", F.lit("place")), F.lit(size // SAMPLED)) == 0
        sampled = sorted(r["k"] for r in keys.where(share).select("k").collect())
        # The first key of each part but the first.
        bounds = sampled[8::16]
        if not bounds:
            break
        held = F.array(*[F.lit(b) for b in bounds])
        part = F.size(F.filter(held, lambda b: b <= F.col("k")))
        sizes = dict(keys.groupBy(part.alias("part")).count().collect())
        at = 0
        while position >= sizes.get(at, 0):
            position -= sizes.get(at, 0)
            at += 1
        if at:
            keys = keys.where(F.col("k") >= F.lit(bounds[at - 1]))
        if at < len(bounds):
            keys = keys.where(F.col("k") < F.lit(bounds[at]))
        size = sizes[at]
    return keys.orderBy("k").limit(position + 1).agg(F.max("k")).first()[0]


def row_range(df: DataFrame, key: str, start: int, stop: int) -> DataFrame:
    """Rows `start` to `stop` (exclusive) in the order of a unique key, in any order.

    The keys at both places are found first; then the range is a filter that reaches the scan.
    Nothing is sorted or copied. Rows without a key are in no range. To split a table among
    jobs in any order, `shard` needs no places.
    """
    first = key_at(df, key, start) if stop > start else None
    if first is None:
        return df.where(F.lit(False))
    found = df.where(F.col(f"`{key}`") >= F.lit(first))
    after = key_at(df, key, stop)
    return found if after is None else found.where(F.col(f"`{key}`") < F.lit(after))


def with_position(df: DataFrame, *order: str | Column) -> DataFrame:
    """Add `position`: the row's place, from 0, in an order without ties.

    The sorted table is settled; its parts are numbered from the sizes of the parts before
    them. Nothing but one row per part meets in one task.
    """
    # The id holds the number of the part, and in its low 33 bits the place within it.
    rows = storage.settle(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    rows = rows.withColumn("_part", F.shiftright("_id", 33))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")
    starts = sizes.select("_part", before.alias("_start"))
    position = F.col("_start") + F.pmod("_id", F.lit(1 << 33))
    return rows.join(starts, "_part").select(*df.columns, position.alias("position"))


def shard(df: DataFrame, key: str, shards: int, index: int) -> DataFrame:
    """One of `shards` disjoint parts that together make up the table; no shuffle."""
    return df.filter(F.pmod(F.xxhash64(key), F.lit(shards)) == index)


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first `n` rows by a unique key: a sample that is the same in every run.

    Each task keeps its own first n, so no table is sorted or copied.
    """
    return df.orderBy(key).limit(n)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def non_empty(df: DataFrame, column: str = "text") -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def not_redirect(df: DataFrame, column: str = "text") -> DataFrame:
    """Drop wiki lines that only point to another article."""
    return df.filter(~F.col(column).startswith(REDIRECT_MARK))


def _mentions(column: str, words: list[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.col(column).contains(word)
    return found


def keyword_articles(
    df: DataFrame, keyword: str, column: str = "text", topic: int = KEYWORD_TOPIC
) -> DataFrame:
    """Articles that contain a keyword, as a topic of their own."""
    return df.filter(_mentions(column, [keyword])).select("post_id", F.lit(topic).alias("topic"))


def exclude_keywords(df: DataFrame, keywords: list[str], column: str = "text") -> DataFrame:
    return df.filter(~_mentions(column, keywords))


def with_page_status(crawl: DataFrame) -> DataFrame:
    """Add `page_status`: redirect for 3xx, failed without a url or a 2xx answer, else ok."""
    code = F.col("status")
    status = (
        F.when(F.col("post_url").isNull() | code.isNull(), FAILED)
        .when(code.between(300, 399), REDIRECT)
        .when(code.between(200, 299), OK)
        .otherwise(FAILED)
    )
    return crawl.withColumn("page_status", status)


def page_articles(crawl: DataFrame, tag: str = "p", sep: str = "") -> DataFrame:
    """Cleaned, non-empty article text of the pages that were fetched."""
    text = text_fn.clean_text(text_fn.extract_text(F.col("html"), tag, sep))
    fetched = with_page_status(crawl).filter(F.col("page_status") == OK)
    # A filter on the text would be pushed below it, and each of its terms would parse the page again.
    found = F.filter(F.array(text), lambda t: t != "")
    return fetched.select("post_id", F.explode(found).alias("text"))


def with_tokens(articles: DataFrame, lemmas: DataFrame | None = None) -> DataFrame:
    """`post_id, tokens`: clean text to the tokens the topic model reads.

    `lemmas` is a table (term, lemma), as of `articles_to_topics.corpus_lemmas` or of a
    dictionary; other terms stay as they are.
    """
    words = text_fn.article_words(text_fn.straighten_apostrophes(F.col("text")))
    tokens = articles.select("post_id", text_fn.remove_stop_words(words).alias("tokens"))
    return tokens if lemmas is None else with_lemmas(tokens, lemmas)


#: Entries of a lemma table up to which every task has a copy of it.
HELD = 1 << 18


def with_lemmas(tokens: DataFrame, lemmas: DataFrame) -> DataFrame:
    """`post_id, tokens` with terms replaced inside each article's own array.

    A table of up to HELD lemmas is copied to all tasks and looked up where the tokens are, so
    nothing is shuffled; a larger one is joined.
    """
    table = lemmas.select("term", "lemma").where("term IS NOT NULL AND lemma IS NOT NULL")
    held = table.limit(HELD + 1).toArrow()
    if held.num_rows > HELD:
        return joined_lemmas(tokens, lemmas)
    shared = tokens.sparkSession.sparkContext.broadcast(held.combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, lemmas = (c.combine_chunks() for c in shared.value.columns)
        for batch in batches:
            for rows, sizes in pieces(batch):
                words = rows.column(1).flatten()
                found = lemmas.take(pc.index_in(words, value_set=terms, skip_nulls=True))
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                made = pa.ListArray.from_arrays(
                    ends, pc.coalesce(found.cast(words.type), words), mask=rows.column(1).is_null()
                )
                yield pa.RecordBatch.from_arrays([rows.column(0), made], names=["post_id", "tokens"])

    kind = tokens.schema["post_id"].dataType.simpleString()
    return tokens.select("post_id", "tokens").mapInArrow(run, f"post_id {kind}, tokens array<string>")


def joined_lemmas(tokens: DataFrame, lemmas: DataFrame) -> DataFrame:
    """The same by a join.

    What is looked up are an article's distinct terms; it gets back a map of those that
    change, so neither its tokens nor its counts are taken apart and put together again.
    """
    terms = tokens.select("post_id", F.explode(F.array_distinct("tokens")).alias("term"))
    changed = (
        terms.join(lemmas.select("term", "lemma"), "term")
        .groupBy("post_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "lemma"))).alias("_changed"))
    )
    replaced = F.transform("tokens", lambda t: F.coalesce(F.try_element_at("_changed", t), t))
    return tokens.join(changed, "post_id", "left").select(
        "post_id", F.when(F.col("_changed").isNull(), F.col("tokens")).otherwise(replaced).alias("tokens")
    )
