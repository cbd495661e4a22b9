from pyspark.sql import functions as F

from topiclens.functions import text
from topiclens.plans import articles_to_topics
from topiclens.operators import articles as ops


def rows(df, *columns):
    return {tuple(row) for row in df.select(*columns).collect()}


def test_page_status_and_articles(spark):
    crawl = spark.createDataFrame(
        [
            (1, "http://a", 200, "<p>Fine, text</p>"),
            (2, None, 200, "<p>no url</p>"),
            (3, "http://c", 404, "<p>gone</p>"),
            (4, "http://d", 301, "<p>moved</p>"),
            (5, "http://e", None, "<p>no answer</p>"),
            (6, "http://f", 204, "<div>no paragraph</div>"),
            (7, "http://g", 299, None),
            (8, "http://h", 399, ""),
            (9, "http://i", 500, ""),
        ],
        "post_id long, post_url string, status int, html string",
    )
    assert rows(ops.with_page_status(crawl), "post_id", "page_status") == {
        (1, "ok"), (2, "failed"), (3, "failed"), (4, "redirect"), (5, "failed"), (6, "ok"),
        (7, "ok"), (8, "redirect"), (9, "failed"),
    }
    assert rows(ops.page_articles(crawl), "post_id", "text") == {(1, "fine text")}


def test_filters(spark):
    df = spark.createDataFrame(
        [
            (1, "#REDIRECT [[x]]"),
            (2, "a trump card"),
            (3, ""),
            (4, None),
            (5, "Kardashian #REDIRECT"),
        ],
        "post_id long, text string",
    )
    assert rows(ops.non_empty(df), "post_id") == {(1,), (2,), (5,)}
    assert rows(ops.not_redirect(df), "post_id") == {(2,), (3,), (5,)}
    assert rows(ops.keyword_articles(df, "trump"), "post_id", "topic") == {(2, -1)}
    kept = ops.exclude_keywords(df, ["Kardashian", "Jenner"])
    assert rows(kept, "post_id") == {(1,), (2,), (3,)}


def test_ranges_and_shards(spark):
    df = spark.range(100).withColumnRenamed("id", "post_id")
    assert rows(ops.row_range(df, "post_id", 10, 13), "post_id") == {(10,), (11,), (12,)}
    placed = ops.with_position(df.orderBy(F.rand(1)), "post_id")
    assert rows(placed, "post_id", "position") == {(i, i) for i in range(100)}
    many = spark.range(0, 300_000, 1, 7).select((F.col("id") * 3).alias("post_id"))
    far = ops.row_range(many, "post_id", 250_000, 250_003)
    assert rows(far, "post_id") == {(750_000,), (750_003,), (750_006,)}
    assert rows(ops.first_rows(df, "post_id", 2), "post_id") == {(0,), (1,)}
    shards = [rows(ops.shard(df, "post_id", 7, i), "post_id") for i in range(7)]
    assert sum(len(s) for s in shards) == 100 and len(set.union(*shards)) == 100
    assert ops.row_count(df).first().rows == 100


def test_tokens_of_an_article(spark):
    df = spark.createDataFrame(
        [(1, "The 3 cats’ toys isn’t 12.5 U.S. <Getty> image"), (2, "")],
        "post_id long, text string",
    )
    assert rows(ops.with_tokens(df).select("post_id", F.array_join("tokens", " ")), "*") == {
        (1, "cats' toys us"), (2, ""),
    }
    lemmas = spark.createDataFrame([("toys", "toy"), ("cats", "cat")], "term string, lemma string")
    found = {r.post_id: r.tokens for r in ops.with_tokens(df, lemmas).collect()}
    assert found == {1: ["cats'", "toy", "us"], 2: []}


def test_only_plurals_with_a_known_singular_change(spark):
    texts = {1: "movies movie lens gas series", 2: "movies news movies", 3: ""}
    df = spark.createDataFrame(list(texts.items()), "post_id long, text string")
    found = {r.post_id: r.tokens for r in articles_to_topics.lemma_tokens(df).collect()}
    assert found == {1: ["movie", "movie", "lens", "gas", "series"], 2: ["movie", "news", "movie"], 3: []}
    more = df.unionByName(spark.createDataFrame([(4, "movy cars car sizes size")], "post_id long, text string"))
    found = {r.post_id: r.tokens for r in articles_to_topics.lemma_tokens(more).collect()}
    assert found[2] == ["movy", "news", "movy"] and found[4] == ["movy", "car", "car", "size", "size"]


def test_any_column_function_is_a_step(spark):
    df = spark.createDataFrame([(1, "A b")], "post_id long, text string")
    steps = [text.clean_text, F.upper, lambda x: F.replace(x, F.lit(" "), F.lit("-"))]
    for step in steps:
        df = df.withColumn("text", step(F.col("text")))
    assert df.first().text == "A-B"


def test_ranges_of_a_table_with_uneven_keys(spark):
    # Keys crowd near 0, are negative, far apart and missing; a range is a filter on the key.
    keys = sorted({(i * 37) % 9001 for i in range(9000)} | {-(2**40), 2**50} | {10**6 * i for i in range(1, 3000)})
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)] * 50, "k long").repartition(5)
    for start, stop in [(0, 3), (5000, 5200), (len(keys) - 2, len(keys) + 5), (7, 7), (9, 3), (10**6, 10**7), (0, 10**6)]:
        found = ops.row_range(df, "k", start, stop)
        assert sorted(r.k for r in found.collect()) == keys[start:stop]
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in text and "Exchange" not in text.replace("Exchange RoundRobin", "")
    words = spark.createDataFrame([(f"w{i:05d}",) for i in range(20_000)], "k string")
    assert sorted(r.k for r in ops.row_range(words, "k", 15_000, 15_002).collect()) == ["w15000", "w15001"]
    assert ops.row_range(df.where("k < -9e15"), "k", 0, 5).count() == 0


def test_a_limit_does_not_sort_the_table(spark):
    df = spark.range(100_000).repartition(7)
    found = ops.first_rows(df, "id", 4)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and [r.id for r in found.collect()] == [0, 1, 2, 3]


def test_pages_are_parsed_once(spark):
    rows = [(1, "u", 200, "<p>Fine text</p>"), (2, "u", 200, "<p></p>"), (3, "u", 200, None), (4, "u", 200, "<b>x</b>")]
    crawl = spark.createDataFrame(rows, "post_id long, post_url string, status int, html string")
    found = ops.page_articles(crawl)
    # Filters on the text would have the whole parser in them.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("<script") == 1
    assert [tuple(r) for r in found.collect()] == [(1, "fine text")]
