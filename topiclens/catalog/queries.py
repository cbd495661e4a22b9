"""Named queries: each reads whole tables under a folder and returns a DataFrame.

Doubles are rounded, since a sum's last digits depend on the order of addition. Ratios
of sums keep more places: at six, sums of cents over 32 views end in a 5 to be rounded.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclens import schemas, storage
from topiclens.functions import clock, text
from topiclens.operators import articles as article_ops
from topiclens.operators import clusters, extras
from topiclens.operators import hits as hit_ops
from topiclens.operators import interest as interest_ops
from topiclens.operators import neighbours, regression, series, terms, topics
from topiclens.plans import articles_to_topics, session_report, testbed, trend_report
from topiclens.session import in_utc
from topiclens.sources import readers, writers
from topiclens.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYWORD = "thing"
EXCLUDED = ["worthless", "stanea"]
PLACES = 6
RATIO_PLACES = 9


def query(function: Query) -> Query:
    """Register a function under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(in_utc(spark), folder.rstrip("/"))

    QUERIES[function.__name__] = run
    return function


def rounded(df: DataFrame, *columns: str, places: int = PLACES) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name in columns})


def ratios(df: DataFrame, *columns: str) -> DataFrame:
    return rounded(df, *columns, places=RATIO_PLACES)


def moment(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


# Choosing and routing -----------------------------------------------------------------


@query
def project(spark, folder):
    return article_ops.project(testbed.articles(spark, folder), "post_id", "text")


@query
def drop_column(spark, folder):
    lines = testbed.table(spark, folder, "documents").drop("n_chars")
    return article_ops.replace_column(lines, "text", "body")


@query
def row_range(spark, folder):
    pages = testbed.crawl(spark, folder).select("post_id", "post_url", "status")
    return article_ops.row_range(pages, "post_id", 10, 40)


@query
def first_n(spark, folder):
    lines = testbed.table(spark, folder, "documents").select("doc_id", "lang", "text")
    return article_ops.first_rows(lines, "doc_id", 100)


@query
def row_range_far(spark, folder):
    lines = testbed.table(spark, folder, "documents").select("doc_id", "lang")
    return article_ops.row_range(lines, "doc_id", 110, 190)


@query
def row_count(spark, folder):
    return article_ops.row_count(testbed.articles(spark, folder), "articles")


@query
def limit_n(spark, folder):
    metrics = hit_ops.session_metrics(_combined(spark, folder))
    return rounded(article_ops.first_rows(metrics, "session_id", 5), "revenue")


@query
def non_empty(spark, folder):
    html = testbed.some_without_paragraphs(F.col("html"), F.col("post_id"))
    pages = testbed.pages(spark, folder).select(
        "post_id", text.clean_text(text.extract_text(html)).alias("text")
    )
    return article_ops.non_empty(pages)


@query
def not_redirect(spark, folder):
    return article_ops.not_redirect(testbed.wiki_lines(spark, folder))


@query
def keyword_articles(spark, folder):
    return article_ops.keyword_articles(testbed.articles(spark, folder), KEYWORD)


@query
def exclude_keywords(spark, folder):
    kept = article_ops.exclude_keywords(testbed.articles(spark, folder), EXCLUDED)
    return kept.select("post_id")


@query
def page_status(spark, folder):
    pages = article_ops.with_page_status(testbed.crawl(spark, folder))
    return pages.select("post_id", "post_url", "status", "page_status")


# Text -----------------------------------------------------------------------------------


@query
def extract_paragraphs(spark, folder):
    html = F.col("html")
    return testbed.pages(spark, folder).select(
        "post_id",
        F.size(text.extract_elements(html)).alias("paragraphs"),
        text.extract_text(html).alias("text"),
    )


@query
def page_title(spark, folder):
    pages = testbed.pages(spark, folder)
    return pages.select("post_id", text.page_title(F.col("html")).alias("title"))


@query
def clean_text(spark, folder):
    docs = testbed.texts(spark, folder)
    return docs.select("post_id", text.clean_text(F.col("text")).alias("text"))


@query
def clean_text_delete(spark, folder):
    docs = testbed.texts(spark, folder)
    return docs.select("post_id", text.clean_text_delete(F.col("text")).alias("text"))


def _token_rows(df: DataFrame, tokens: Column) -> DataFrame:
    return df.select(
        "post_id", F.size(tokens).alias("n_tokens"), F.array_join(tokens, "|").alias("tokens")
    )


@query
def tokenize(spark, folder):
    return _token_rows(testbed.texts(spark, folder), text.tokenize(F.col("text")))


@query
def tokenize_alpha(spark, folder):
    tokens = text.strip_punctuation(text.tokenize_alpha(F.col("html")))
    return _token_rows(testbed.pages(spark, folder), tokens)


def _clean_tokens() -> Column:
    return text.drop_empty(text.tokenize(text.clean_text(F.col("text"))))


@query
def drop_numeric(spark, folder):
    return _token_rows(testbed.texts(spark, folder), text.drop_numeric(_clean_tokens()))


@query
def remove_stopwords(spark, folder):
    return _token_rows(testbed.texts(spark, folder), text.remove_stop_words(_clean_tokens()))


@query
def lemmatize(spark, folder):
    docs = article_ops.with_tokens(testbed.texts(spark, folder))
    counts = storage.settle(terms.term_counts(docs))
    return terms.lemmatize(counts, storage.settle(terms.plural_lemmas(counts)))


def _alpha_counts(spark, folder) -> DataFrame:
    tokens = text.remove_stop_words(text.tokenize_alpha(F.col("text")))
    return terms.term_counts(testbed.texts(spark, folder).select("post_id", tokens.alias("tokens")))


@query
def stem_terms(spark, folder):
    return terms.stem_terms(_alpha_counts(spark, folder))


@query
def stemmed_counts(spark, folder):
    return terms.stem(storage.settle(_alpha_counts(spark, folder)))


@query
def prepared_text(spark, folder):
    docs = testbed.texts(spark, folder)
    return docs.select("post_id", text.prepared_text(F.col("text")).alias("text"))


@query
def ngrams(spark, folder):
    docs = testbed.tokens(spark, folder)
    pairs = docs.select("post_id", text.ngrams(F.col("tokens"), 2).alias("tokens"))
    return terms.term_totals(terms.term_counts(pairs))


# Features and topics --------------------------------------------------------------------


@query
def term_counts(spark, folder):
    return terms.term_counts(testbed.tokens(spark, folder))


@query
def vocabulary(spark, folder):
    return terms.vocabulary(terms.term_counts(testbed.tokens(spark, folder)))


@query
def tfidf(spark, folder):
    return rounded(articles_to_topics.weighted_terms(testbed.texts(spark, folder)), "tfidf")


def _centroids(spark, folder) -> DataFrame:
    weights = articles_to_topics.weighted_terms(testbed.texts(spark, folder))
    return topics.centroids(weights, testbed.post_topics(spark, folder))


@query
def centroids(spark, folder):
    return rounded(_centroids(spark, folder), "weight")


@query
def topic_top_terms(spark, folder):
    # Rounded before ranking, so that equal weights tie in every engine.
    return topics.top_terms(rounded(_centroids(spark, folder), "weight"))


@query
def topic_sizes(spark, folder):
    return topics.topic_sizes(testbed.post_topics(spark, folder))


def _nearest(spark, folder) -> DataFrame:
    vectors = testbed.vectors(spark, folder)
    return topics.nearest_centroid(vectors, topics.dense_centers(vectors))


@query
def nearest_centroid(spark, folder):
    return rounded(_nearest(spark, folder).select("vec_id", "topic", "distance"), "distance")


@query
def clustering_cost(spark, folder):
    cost = topics.clustering_cost(_nearest(spark, folder))
    return cost.select(
        F.round("cost", 4).alias("cost"), F.round("scaled_cost", 9).alias("scaled_cost")
    )


@query
def topics_kmeans(spark, folder):
    """Sizes of the fitted topics."""
    docs = testbed.bags(spark, folder)
    model = topics.fit_topics(docs)
    return topics.topic_sizes(topics.assign_topics(model, docs))


@query
def text_to_topic(spark, folder):
    """All the way from article text to the fitted topics' keywords."""
    model = topics.fit_topics(testbed.bags(spark, folder))
    return topics.topic_terms_table(topics.model_centroids(spark, model))


@query
def stemmed_topics(spark, folder):
    """From raw text by word stems to three topics and their keywords."""
    docs = testbed.texts(spark, folder)
    model = articles_to_topics.learn_stemmed_topics(docs)
    return topics.topic_terms_table(topics.model_centroids(spark, model))


@query
def classify_new(spark, folder):
    """Crawled pages put into the topics that were learnt from the articles."""
    return _labelled_pages(spark, folder)


def _labelled_pages(spark, folder) -> DataFrame:
    docs = testbed.word_bags(spark, folder)
    lemmas = testbed.lemmas(docs)
    model = articles_to_topics.learn_topics(docs, lemmas)
    pages = articles_to_topics.crawl_to_articles(testbed.pages(spark, folder))
    return articles_to_topics.label_articles(model, pages, lemmas)


@query
def model_roundtrip(spark, folder):
    """Topics given by a model that was written and read again."""
    docs = testbed.bags(spark, folder)
    path = f"{storage.shared_folder(spark)}/model-{uuid4().hex}"
    topics.save_model(topics.fit_topics(docs), path)
    model = topics.load_model(path)
    storage.remove(spark, path)
    return topics.assign_topics(model, docs)


@query
def k_sweep(spark, folder):
    return topics.k_sweep(testbed.bags(spark, folder), [3, 10, 25])


@query
def topics_lda(spark, folder):
    return topics.lda_topics(testbed.bags(spark, folder))


@query
def synonyms(spark, folder):
    return topics.synonyms(testbed.tokens(spark, folder), KEYWORD)


# Hits, sessions, devices ----------------------------------------------------------------


def _combined(spark, folder) -> DataFrame:
    return hit_ops.hits_with_topic(
        testbed.hits(spark, folder).select("session_id", "ts", "post_id", "hit_revenue"),
        testbed.post_topics(spark, folder),
    )


def _tied(spark, folder) -> DataFrame:
    """Hits known to the day only, so that a session's first hits share a moment."""
    return _combined(spark, folder).withColumn("ts", F.date_trunc("day", "ts"))


def _hits_and_topics(spark, folder) -> tuple[DataFrame, DataFrame]:
    return testbed.hits(spark, folder), testbed.post_topics(spark, folder)


@query
def hits_with_topic(spark, folder):
    hits, topic_map = _hits_and_topics(spark, folder)
    combined = hit_ops.hits_with_topic(hits, topic_map)
    seconds = clock.seconds_since(F.col("ts"), testbed.CUT)
    return combined.select(
        "event_id", "session_id", "post_id", "topic", seconds.alias("timeframe"),
        "hit_revenue", "device_type",
    )


@query
def session_first_ts(spark, folder):
    first = hit_ops.session_first_ts(_combined(spark, folder))
    return first.select("session_id", moment(F.col("first_ts")).alias("first_ts"))


@query
def session_starts(spark, folder):
    return hit_ops.session_starts(_combined(spark, folder))


@query
def session_starts_ties(spark, folder):
    return hit_ops.session_starts(_tied(spark, folder), ties="all")


@query
def session_metrics(spark, folder):
    return rounded(hit_ops.session_metrics(_combined(spark, folder)), "revenue")


@query
def session_metrics_ties(spark, folder):
    return rounded(hit_ops.session_metrics(_tied(spark, folder), ties="all"), "revenue")


@query
def session_metrics_by_topic(spark, folder):
    report = session_report.landing_topic_report(*_hits_and_topics(spark, folder))
    return ratios(rounded(report, "revenue"), "revenue_per_session")


@query
def avg_hit_by_topic(spark, folder):
    return ratios(hit_ops.avg_hit_by_topic(*_hits_and_topics(spark, folder)), "avg_hit")


@query
def device_counts(spark, folder):
    hits, topic_map = _hits_and_topics(spark, folder)
    return hit_ops.device_counts(hits, topic_map, ["smartphone", "desktop"])


@query
def device_share(spark, folder):
    shares = hit_ops.device_share(*_hits_and_topics(spark, folder), "smartphone")
    return ratios(shares, "device_share", "other_share")


@query
def device_outer_join(spark, folder):
    hits, topic_map = _hits_and_topics(spark, folder)
    return hit_ops.device_outer_join(hits, topic_map, "smartphone", "desktop")


@query
def topic_weekday(spark, folder):
    return rounded(hit_ops.topic_weekday(*_hits_and_topics(spark, folder)), "revenue")


@query
def topic_lifespan(spark, folder):
    ages = hit_ops.topic_lifespan(*_hits_and_topics(spark, folder))
    return ratios(ages, "mean_age", "median_age", "p90_age")


# Time -----------------------------------------------------------------------------------


@query
def time_since_cut(spark, folder):
    ts = F.col("ts")
    return testbed.hits(spark, folder).select(
        "event_id",
        clock.seconds_since(ts, testbed.CUT).alias("seconds"),
        F.round(clock.hours_since(ts, testbed.CUT), PLACES).alias("hours"),
    )


@query
def days_since_cut(spark, folder):
    days = clock.days_since(F.col("date"), testbed.CUT).alias("day")
    dated = testbed.interest(spark, folder).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return dated.select("date", "keyword", days)


@query
def hour_to_day(spark, folder):
    hours = clock.hours_since(F.col("ts"), testbed.CUT)
    return testbed.hits(spark, folder).select(
        "event_id",
        F.floor(hours).cast("int").alias("hour"),
        clock.hour_bin(hours).alias("bin"),
        clock.hour_to_day(hours).alias("day"),
    )


@query
def day_to_date(spark, folder):
    dated = series.with_dates(_binned(spark, folder), testbed.CUT)
    start = clock.hour_to_timestamp(F.col("timeframe"), testbed.CUT)
    return dated.select(
        "topic",
        "timeframe",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        moment(start).alias("bin_start"),
    )


# Series ---------------------------------------------------------------------------------


def _binned(spark, folder) -> DataFrame:
    return series.binned_metrics(*_hits_and_topics(spark, folder), testbed.CUT)


def _study(spark, folder) -> DataFrame:
    hits, topic_map = _hits_and_topics(spark, folder)
    recent = series.hits_from_cut(hits, testbed.CUT)
    return series.after_cut(series.binned_metrics(recent, topic_map, testbed.CUT))


@query
def binned_metrics(spark, folder):
    return rounded(_binned(spark, folder), "revenue")


@query
def after_cut(spark, folder):
    return rounded(_study(spark, folder), "revenue")


@query
def study_window(spark, folder):
    hits, topic_map = _hits_and_topics(spark, folder)
    chosen = series.study_hits(hits, testbed.CUT, testbed.LAST_DAY)
    daily = series.topic_daily(series.binned_metrics(chosen, topic_map, testbed.CUT))
    return rounded(series.study_window(daily, testbed.LAST_DAY), "revenue")


@query
def timeframes(spark, folder):
    return series.timeframes(_study(spark, folder))


@query
def topic_series(spark, folder):
    return rounded(series.topic_series(_study(spark, folder)), "revenue")


@query
def base_series(spark, folder):
    return rounded(series.base_series(_study(spark, folder)), "revenue")


@query
def topic_daily(spark, folder):
    return rounded(series.topic_daily(_study(spark, folder)), "revenue")


@query
def revenue_per_view(spark, folder):
    return ratios(series.revenue_per_view(_study(spark, folder)), "revenue_per_view")


@query
def rpv_daily(spark, folder):
    return ratios(series.rpv_daily(_study(spark, folder)), "revenue_per_view")


@query
def dense_series(spark, folder):
    dense = series.dense_series(_binned(spark, folder), 0, testbed.LAST_BIN)
    return rounded(dense, "revenue")


@query
def standardized_series(spark, folder):
    return rounded(series.standardized_series(_study(spark, folder)), *series.MEASURES)


def _arriving(spark, folder, schema) -> DataFrame:
    """The events' files as a stream: a single file, or a folder of part files, as the glob finds both."""
    return spark.readStream.schema(schema).parquet(f"{folder}/event[s].parquet")


@query
def stream_binned_metrics(spark, folder):
    """The binned metrics of a stream of hit files, after all of them have arrived."""
    run = f"{storage.shared_folder(spark)}/hits-{uuid4().hex}"
    topic_map = testbed.post_topics(spark, folder)
    events = testbed.table(spark, folder, "events")
    stream = testbed.as_hits(_arriving(spark, folder, events.schema))
    incremental.follow_hits(stream, f"{run}/sums", f"{run}/log", testbed.CUT).awaitTermination()
    partials = storage.settle(spark.read.parquet(f"{run}/sums"))
    storage.remove(spark, run)
    return rounded(incremental.binned_so_far(partials, topic_map), "revenue")


# Interest and regression ----------------------------------------------------------------


@query
def interest_wide(spark, folder):
    wide = interest_ops.interest_wide(testbed.interest(spark, folder), testbed.KEYWORDS)
    return rounded(wide, *testbed.KEYWORDS).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def _revenue_table(spark, folder) -> DataFrame:
    return trend_report.revenue_table(
        *_hits_and_topics(spark, folder),
        testbed.interest(spark, folder),
        testbed.KEYWORDS,
        testbed.CUT,
        testbed.LAST_DAY,
    )


@query
def revenue_with_interest(spark, folder):
    return rounded(_revenue_table(spark, folder), "revenue", *testbed.KEYWORDS)


@query
def topic_trendline(spark, folder):
    trend = interest_ops.topic_trendline(
        testbed.interest(spark, folder), testbed.keyword_weights(spark, folder)
    )
    return rounded(trend, "trendline").withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query
def revenue_ols(spark, folder):
    fits = trend_report.revenue_model(_revenue_table(spark, folder), testbed.KEYWORDS)
    return rounded(fits, "coefficient", "r2")


@query
def revenue_predicted(spark, folder):
    fits = trend_report.predicted_revenue(_revenue_table(spark, folder), testbed.KEYWORDS)
    return fits.select(
        "topic",
        "day",
        *[F.round(name, 4).alias(name) for name in ("actual", "predicted", "r2")],
    )


@query
def revenue_regr(spark, folder):
    fits = regression.revenue_regr(_revenue_table(spark, folder), "view")
    return rounded(fits, "slope", "intercept", "r2")


# Polarity, transitions, shares -----------------------------------------------------------


def _polarity(spark, folder) -> DataFrame:
    lexicon = testbed.lexicon(spark, folder)
    return extras.polarity(testbed.alpha_tokens(spark, folder), lexicon)


@query
def polarity(spark, folder):
    return _polarity(spark, folder)


@query
def metrics_by_polarity(spark, folder):
    metrics = extras.metrics_by_polarity(testbed.hits(spark, folder), _polarity(spark, folder))
    return rounded(metrics, "revenue")


@query
def event_transitions(spark, folder):
    return ratios(extras.event_transitions(testbed.hits(spark, folder)), "probability")


@query
def top_decile_share(spark, folder):
    shares = extras.top_share(testbed.hits(spark, folder))
    return ratios(rounded(shares, "revenue", "top_revenue"), "top_share")


@query
def stream_keyword_views(spark, folder):
    """Views per day and keyword of a stream of hit files, after all of them have arrived."""
    run = f"{storage.shared_folder(spark)}/keywords-{uuid4().hex}"
    events = testbed.table(spark, folder, "events")
    stream = testbed.as_hits(_arriving(spark, folder, events.schema))
    incremental.follow_keywords(stream, f"{run}/counts", f"{run}/log").awaitTermination()
    updates = storage.settle(spark.read.parquet(f"{run}/counts"))
    storage.remove(spark, run)
    views = incremental.keyword_views(updates)
    return views.withColumn("start", moment(F.col("start")))


# Files written and read again ---------------------------------------------------------------


def _through_files(spark, write, read) -> DataFrame:
    """What is read of files that were written; the files are gone when it is returned."""
    path = f"{storage.shared_folder(spark)}/files-{uuid4().hex}"
    write(path)
    found = storage.settle(read(path))
    storage.remove(spark, path)
    return found


@query
def hits_file(spark, folder):
    """Hits as CSV, read again by position with their types."""
    hits = testbed.hits(spark, folder).withColumn("post_url", F.lit("http://example.com/a,b"))
    rows = hits.select(
        *[
            moment(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "timestamp" else f.name
            for f in schemas.HITS.fields
        ]
    )
    read = _through_files(
        spark,
        lambda path: rows.write.csv(path, header=True),
        lambda path: readers.read_hits(spark, path),
    )
    return read.select(
        "uuid",
        "session_id",
        moment(F.col("ts")).alias("ts"),
        "post_id",
        "post_url",
        "device_type",
        F.round("hit_revenue", PLACES).alias("hit_revenue"),
    )


@query
def articles_file(spark, folder):
    docs = testbed.articles(spark, folder).select(
        "post_id", text.clean_text(F.col("text")).alias("text")
    )
    return _through_files(
        spark,
        lambda path: writers.write_articles_csv(docs, path),
        lambda path: readers.read_articles(spark, path),
    )


@query
def topic_map_file(spark, folder):
    topic_map = testbed.post_topics(spark, folder)
    return _through_files(
        spark,
        lambda path: writers.write_topic_map(topic_map, path),
        lambda path: readers.read_table(spark, path),
    )


@query
def by_topic_files(spark, folder):
    topic_map = testbed.post_topics(spark, folder)
    return _through_files(
        spark,
        lambda path: writers.write_by_topic(topic_map, path),
        lambda path: readers.read_table(spark, path),
    )


@query
def pages_by_status_files(spark, folder):
    pages = testbed.crawl(spark, folder).select("post_id", "post_url", "status")
    return _through_files(
        spark,
        lambda path: writers.write_pages_by_status(pages, path),
        lambda path: readers.read_table(spark, path),
    )


@query
def text_lines_file(spark, folder):
    """Texts as lines, read again as articles with an id of their own."""
    lines = testbed.articles(spark, folder).select(F.translate("text", "\r\n", "  ").alias("value"))

    def write(path):
        lines.distinct().write.text(path)

    read = _through_files(spark, write, lambda path: readers.read_lines(spark, path))
    return read.groupBy("text").agg(F.countDistinct("post_id").alias("ids"))


# What must be true of fitted models -------------------------------------------------------


@query
def model_roundtrip_same(spark, folder):
    """Whether each article has the same topic before and after the model was written."""
    docs = testbed.bags(spark, folder)
    model = topics.fit_topics(docs)
    path = f"{storage.shared_folder(spark)}/model-{uuid4().hex}"
    topics.save_model(model, path)
    again = topics.load_model(path)
    storage.remove(spark, path)
    before = topics.assign_topics(model, docs).withColumnRenamed("topic", "before")
    return topics.assign_topics(again, docs).join(before, "post_id").select(
        "post_id", (F.col("topic") == F.col("before")).cast("int").alias("same")
    )


@query
def kmeans_gap(spark, folder):
    """How much farther each article's centre is than its nearest one."""
    docs = testbed.bags(spark, folder)
    model = topics.fit_topics(docs)
    vectors = clusters.vectors(docs, model.vocabulary, model.idf, model.min_tf)
    # A row for each term with what it has in every centre.
    entries = [(i, [int(x) for x in term]) for i, term in enumerate(model.centers.T)]
    centers = spark.createDataFrame(entries, "term int, c array<long>")
    squares = F.array(*[F.lit(int(x)) for x in (model.centers**2).sum(axis=1)]).cast("array<long>")
    long = vectors.select("post_id", F.inline(F.arrays_zip("terms", "weights")))
    dots = (
        long.join(F.broadcast(centers), long["terms"] == centers["term"])
        .groupBy("post_id")
        .agg(
            F.array(*[F.sum(F.col("weights") * F.col("c")[t]) for t in range(model.k)])
            .cast("array<long>")
            .alias("dots")
        )
    )
    given = topics.assign_topics(model, docs).withColumnRenamed("topic", "given")
    # Every article's distance, but for its own square, from every one of the k topics.
    none = F.array_repeat(F.lit(0).cast("long"), model.k)
    distances = F.zip_with(squares, F.coalesce("dots", none), lambda square, dot: square - 2 * dot)
    far = given.join(dots, "post_id", "left").withColumn("d", distances)
    gap = F.max(F.get("d", F.col("given"))) - F.min(F.array_min("d"))
    return far.groupBy("post_id").agg(F.round(gap / clusters.UNIT**2, 6).alias("gap"))


@query
def kmeans_step(spark, folder):
    """The centres after one round from the start: means of the nearest articles."""
    docs = testbed.bags(spark, folder)
    vocabulary, idf = clusters.learn_vocabulary(
        docs, terms.MIN_DF, terms.MIN_TF, terms.VOCAB_SIZE
    )
    found = storage.settle(clusters.vectors(docs, vocabulary, idf, terms.MIN_TF))
    start = clusters.start_centers(found, topics.K, len(vocabulary))
    moved, _ = clusters.step(found, start)
    rows = [
        (t, vocabulary[i], int(x))
        for t, center in enumerate(moved) for i, x in enumerate(center) if x
    ]
    return spark.createDataFrame(rows, "topic int, term string, weight long")


@query
def word_pairs(spark, folder):
    """Of each word: common words near it, how often, and how much more often than by chance."""
    docs = testbed.tokens(spark, folder)
    common = terms.term_totals(terms.term_counts(docs)).orderBy(F.desc("corpus_count"), "term")
    contexts = neighbours.common_words(common.limit(terms.VOCAB_SIZE))
    stripes = storage.settle(neighbours.pair_stripes(docs, contexts))
    weighed = neighbours.weighted_pairs(stripes, len(contexts))
    names = F.array(*[F.lit(t) for t in contexts.to_pylist()]).cast("array<string>")
    pairs = F.transform(
        F.arrays_zip("places", "n"),
        lambda e: F.struct((-e["n"]).alias("n"), F.get(names, e["places"]).alias("context")),
    )
    whole = F.reduce("n", F.lit(0).cast("long"), lambda a, b: a + b)
    weight = F.reduce("weights", F.lit(0.0), lambda a, b: a + b)
    return weighed.select(
        "word",
        F.size("places").cast("long").alias("contexts"),
        whole.alias("n"),
        F.round(weight, 4).alias("weight"),
        F.array_min(pairs)["context"].alias("commonest"),
    )


@query
def k_sweep_falls(spark, folder):
    """Whether more topics cost less."""
    ks = [3, 10, 25]
    costs = topics.k_sweep(testbed.bags(spark, folder), ks)
    wide = costs.groupBy().pivot("k", ks).agg(F.first("cost"))
    steps = [
        F.struct(
            F.lit(a).alias("fewer"), F.lit(b).alias("k"), (F.col(str(b)) < F.col(str(a))).cast("int").alias("falls")
        )
        for a, b in zip(ks, ks[1:])
    ]
    return wide.select(F.inline(F.array(*steps)))


@query
def lda_known_terms(spark, folder):
    """Terms of each LDA topic that are in the vocabulary."""
    docs = testbed.bags(spark, folder)
    found = topics.lda_topics(docs)
    known = terms.vocabulary(terms.term_counts(docs)).select("term")
    return found.join(known, "term").groupBy("topic").agg(F.count(F.lit(1)).alias("terms"))


@query
def classified_pages(spark, folder):
    """Pages that were given one of the learnt topics."""
    found = _labelled_pages(spark, folder)
    return found.select("post_id", F.col("topic").between(0, topics.K - 1).cast("int").alias("known"))


@query
def synonyms_known(spark, folder):
    """Synonyms that are frequent terms of the corpus, other than the word itself."""
    docs = testbed.tokens(spark, folder)
    found = topics.synonyms(docs, KEYWORD).filter(F.col("word") != KEYWORD)
    totals = terms.term_totals(terms.term_counts(docs)).withColumnRenamed("term", "word")
    return found.join(totals.filter(F.col("corpus_count") >= terms.MIN_DF), "word").agg(
        F.count(F.lit(1)).alias("synonyms")
    )
