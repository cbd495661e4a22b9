"""The library's input tables, derived from the tables under a test data folder.

Each is a column-wise mapping or an aggregate of a whole table, so it grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topiclens.functions import text as text_fn
from topiclens.operators.bags import of_articles
from topiclens.operators.hits import topic_rollup
from topiclens.plans.articles_to_topics import corpus_lemmas, lemma_bags, lemma_tokens
from topiclens.sources.readers import spread
from topiclens.storage import settle

# The study window of the test data. It starts inside the data, so some hits precede it.
CUT = "2024-01-08 00:00:00"
LAST_DAY = 14
LAST_BIN = (LAST_DAY + 1) * 24 - 4
# Parts to share small tables among before work on their text, if the session asks for it.
PARTS = "topiclens.parts"
# Labels up to which every task has a copy of them.
HELD_LABELS = 1 << 21
KEYWORDS = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _parts(spark: SparkSession) -> int | None:
    asked = spark.conf.get(PARTS, None)
    return int(asked) if asked else None


def hits(spark: SparkSession, folder: str) -> DataFrame:
    return as_hits(table(spark, folder, "events"))


def as_hits(events: DataFrame) -> DataFrame:
    """A hit per event: the post from user and `props.k`, the session from user and day."""
    ts = F.col("ts").cast("timestamp")
    post_id = F.col("user_id") * 10 + F.get_json_object("props", "$.k").cast("long")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    device = F.col("event_id") % 3
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("uuid"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format(ts, "yyyyMMdd")).alias(
            "session_id"
        ),
        ts.alias("ts"),
        post_id.alias("post_id"),
        F.timestamp_seconds(F.unix_timestamp(start) + post_id % 20 * 86400).alias("post_published"),
        F.when(device == 0, "smartphone")
        .when(device == 1, "desktop")
        .otherwise("tablet")
        .alias("device_type"),
        F.col("value").alias("hit_revenue"),
        F.col("event_type").alias("keyword"),
    )


def post_topics(spark: SparkSession, folder: str) -> DataFrame:
    """An article's topic is its source's number; posts that are no document have none."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("post_id"),
        F.regexp_extract("source", "[0-9]+", 0).cast("int").alias("topic"),
    )


def articles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("post_id"), "text")


def wiki_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The articles, every seventh of them only pointing to another one."""
    mark = F.when(F.col("post_id") % 7 == 0, F.lit("#REDIRECT ")).otherwise(F.lit(""))
    return articles(spark, folder).select("post_id", F.concat(mark, "text").alias("text"))


def some_without_paragraphs(html: Column, post_id: Column) -> Column:
    """Every fifth page's paragraphs as blocks of another kind."""
    plain = F.regexp_replace(html, r"<(/?)p>", "<$1section>")
    return F.when(post_id % 5 == 0, plain).otherwise(html)


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """The articles, for work on their text."""
    return spread(articles(spark, folder), "post_id", _parts(spark))


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The articles' tokens in dictionary form, as far as the articles tell it."""
    return lemma_tokens(texts(spark, folder))


def bags(spark: SparkSession, folder: str) -> DataFrame:
    """The same tokens as bags of words."""
    return lemma_bags(texts(spark, folder))


def word_bags(spark: SparkSession, folder: str) -> DataFrame:
    """Bags of the articles' words as they stand."""
    return settle(of_articles(texts(spark, folder)))


def lemmas(found: DataFrame) -> DataFrame:
    """The table that turns them into dictionary form."""
    return settle(corpus_lemmas(found))


def crawl(spark: SparkSession, folder: str) -> DataFrame:
    """Crawled pages; the answer code and missing urls are made from the page id."""
    page = F.col("page_id")
    code = F.when(page % 10 == 0, 404).when(page % 10 == 1, 301).otherwise(200)
    return table(spark, folder, "pages").select(
        page.alias("post_id"),
        F.when(page % 50 != 7, F.col("url")).alias("post_url"),
        code.alias("status"),
        "html",
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """The crawl, for work on its markup."""
    return spread(crawl(spark, folder), "post_id", _parts(spark))


def interest(spark: SparkSession, folder: str) -> DataFrame:
    """Events per day and type as interest in a keyword, 100 on its best day."""
    daily = (
        table(spark, folder, "events")
        .groupBy(F.col("ts").cast("date").alias("date"), F.col("event_type").alias("keyword"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.max("n").over(Window.partitionBy("keyword"))
    return daily.select("date", "keyword", (F.lit(100.0) * F.col("n") / best).alias("interest"))


def keyword_weights(spark: SparkSession, folder: str) -> DataFrame:
    """`topic, term, weight`: the share of a topic's hits that have the keyword."""
    counts = topic_rollup(
        hits(spark, folder), post_topics(spark, folder), ["keyword"], views=F.count(F.lit(1))
    )
    total = F.sum("views").over(Window.partitionBy("topic"))
    return counts.select(
        "topic", F.col("keyword").alias("term"), (F.col("views") / total).alias("weight")
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """`vec_id, topic, vector`: embeddings in double precision, with their label as topic."""
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.col("label").alias("topic"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


def alpha_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """`post_id, tokens`: the articles' words in their order."""
    words = text_fn.tokenize_alpha(F.col("text"))
    return texts(spark, folder).select("post_id", words.alias("tokens"))


def lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """`term, polarity` of words and pairs of words, from the articles' quality labels.

    A term of at least five labelled articles is as positive, from -5 to 5, as more of them
    are good; terms in the middle are left out.
    """
    tokens = F.col("tokens")
    both = F.array_distinct(F.concat(tokens, text_fn.ngrams(tokens, 2)))
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("post_id"), "quality")
    # A text is far longer than its label, so texts stay where they are.
    if labels.count() <= HELD_LABELS:
        labels = F.broadcast(labels)
    # Texts meet their labels before they are taken apart.
    words = text_fn.tokenize_alpha(F.col("text")).alias("tokens")
    labelled = texts(spark, folder).join(labels, "post_id").select("quality", words)
    rated = labelled.select("quality", F.explode(both).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quality").alias("good")
    )
    value = F.expr("CAST((20 * good + n) DIV (2 * n) AS LONG) - 5")
    return rated.filter("n >= 5").select("term", value.alias("polarity")).filter("polarity != 0")
