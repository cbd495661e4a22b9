import shutil
from pathlib import Path

from topiclens.catalog.queries import QUERIES
from topiclens.operators import series
from topiclens.operators.topics import fit_topics
from topiclens.plans import testbed
from topiclens.plans.articles_to_topics import label_articles
from topiclens.streaming import incremental


def equal(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hits_in_several_batches(spark, small, tmp_path):
    """Files arrive in two runs and a batch is repeated; the sums stay those of one batch run."""
    events = testbed.table(spark, small, "events")
    landing = str(tmp_path / "in")
    early = events.filter("event_id < 300")
    early.coalesce(1).write.parquet(landing)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)

    def run(log="log"):
        hits = testbed.as_hits(stream.parquet(landing))
        query = incremental.follow_hits(
            hits, str(tmp_path / "sums"), str(tmp_path / log), testbed.CUT
        )
        query.awaitTermination()

    run()
    events.filter("event_id >= 300").repartition(3).write.mode("append").parquet(landing)
    run()
    partials = spark.read.parquet(str(tmp_path / "sums"))
    assert partials.select("batch").distinct().count() >= 2
    topics = testbed.post_topics(spark, small)
    columns = ["topic", "timeframe", "articles", "views"]
    batch = series.binned_metrics(testbed.hits(spark, small), topics, testbed.CUT)
    assert equal(incremental.binned_so_far(partials, topics).select(columns), batch.select(columns))
    # A log in which the last batch is not noted as done: it runs again.
    commits = tmp_path / "log" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    undone = {str(last), f".{last}.crc"}
    shutil.copytree(
        tmp_path / "log",
        tmp_path / "log2",
        ignore=lambda folder, names: undone & set(names) if folder == str(commits) else set(),
    )
    run("log2")
    assert (tmp_path / "log2" / "commits" / str(last)).exists()
    again = spark.read.parquet(str(tmp_path / "sums"))
    assert equal(incremental.binned_so_far(again, topics).select(columns), batch.select(columns))


def test_streams_of_part_files(spark, small, tmp_path):
    """A table of several part files gives what a single file gives."""
    for file in Path(small).iterdir():
        if file.name != "events.parquet":
            (tmp_path / file.name).symlink_to(file)
    events = testbed.table(spark, small, "events")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    assert len(list((tmp_path / "events.parquet").glob("part-*.parquet"))) == 3
    for name in ("stream_binned_metrics", "stream_keyword_views"):
        found = QUERIES[name](spark, str(tmp_path))
        assert not found.isEmpty() and equal(found, QUERIES[name](spark, small))


def test_new_articles_get_topics(spark, small, tmp_path):
    articles = testbed.articles(spark, small)
    model = fit_topics(testbed.tokens(spark, small), k=3, min_df=2, min_tf=2, vocab_size=200)
    articles.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(articles.schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "map")
    incremental.follow_articles(model, stream, out, str(tmp_path / "log")).awaitTermination()
    found = spark.read.parquet(out).select("post_id", "topic")
    assert equal(found, label_articles(model, articles))
