from datetime import date

import pytest

from topiclens import schemas, storage
from topiclens.sources import readers, writers


def rows(df, *columns):
    return {tuple(row) for row in df.select(*columns or "*").collect()}


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_articles_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'said "so, there"'), (2, ""), (3, None), (4, "naïve")], "post_id long, text string"
    )
    writers.write_articles_csv(df, str(tmp_path / "a"))
    assert rows(readers.read_articles(spark, str(tmp_path / "a"))) == {
        (1, 'said "so, there"'), (4, "naïve"),
    }


def test_quoted_line_feeds(spark, tmp_path):
    path = write(tmp_path / "x.csv", 'post_id,text\n1,"two\nlines"\n')
    assert rows(readers.read_strings_csv(spark, path, multi_line=True)) == {("1", "two\nlines")}


def test_typed_csv_binds_by_position(spark, tmp_path):
    path = write(tmp_path / "b.csv", ",topic,time,n,v,r\n0,17,4.0,2,3,1.5\n")
    assert rows(readers.read_binned(spark, path)) == {(0, 17, 4.0, 2, 3, 1.5)}
    strict = readers.read_typed_csv(spark, path, schemas.BINNED, by_position=False)
    with pytest.raises(Exception, match="(?i)header"):
        strict.collect()


def test_hits_csv(spark, tmp_path):
    path = write(
        tmp_path / "h.csv",
        "uuid,sessionId,ts,post_id,post_published,post_url,deviceType,hit_revenue\n"
        "u,s,2017-03-01 00:00:01,16777217,2017-02-01 00:00:00,http://x,smartphone,0.1\n",
    )
    row = readers.read_hits(spark, path).first()
    assert (row.post_id, row.hit_revenue, row.ts.second) == (16777217, 0.1, 1)


def test_topic_map_roundtrip(spark, tmp_path):
    path = write(tmp_path / "t.csv", ",post_id,topic_k25\n0,5,24\n")
    topics = readers.read_topic_map(spark, path)
    assert topics.schema == schemas.TOPIC_MAP
    writers.write_topic_map(topics, str(tmp_path / "map"))
    assert rows(readers.read_table(spark, str(tmp_path / "map"))) == {(5, 24)}


def test_lines(spark, tmp_path):
    path = write(tmp_path / "wiki", "#REDIRECT a\nb c\nb c\n")
    found = readers.read_lines(spark, path).collect()
    assert sorted(r.text for r in found) == ["#REDIRECT a", "b c", "b c"]
    assert len({r.post_id for r in found}) == 3


def test_term_polarity(spark, tmp_path):
    path = write(tmp_path / "p.txt", "abandon\t-2\ncan't stand\t-3\nnaïve\t-2\n\"x\t1\n")
    assert rows(readers.read_term_polarity(spark, path)) == {
        ("abandon", -2), ("can't stand", -3), ("naïve", -2), ('"x', 1),
    }


def test_interest_files_with_columns_of_their_own(spark, tmp_path):
    write(tmp_path / "topic_0_trends.csv", "date,kim,isPartial\n2017-03-01,5,False\n")
    write(tmp_path / "topic_17_trends.csv", "date,rob,blac\n2017-03-01,1,2\n2017-03-02,3,\n")
    write(tmp_path / "other.csv", "date,no\n2017-03-01,5\n")
    day = date(2017, 3, 1)
    assert rows(readers.read_interest_files(spark, str(tmp_path))) == {
        (0, day, "kim", 5.0), (17, day, "rob", 1.0), (17, day, "blac", 2.0),
        (17, date(2017, 3, 2), "rob", 3.0), (17, date(2017, 3, 2), "blac", None),
    }


def test_folders_by_topic_and_status(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "topic int, x string")
    writers.write_by_topic(df, str(tmp_path / "t"))
    assert (tmp_path / "t" / "topic=2").is_dir()
    assert rows(spark.read.parquet(str(tmp_path / "t")), "topic", "x") == rows(df)
    crawl = spark.createDataFrame(
        [(1, "u", 200, "h"), (2, None, 200, "h"), (3, "u", 302, "h")], schemas.CRAWL
    )
    writers.write_pages_by_status(crawl, str(tmp_path / "s"))
    found = {p.name for p in (tmp_path / "s").glob("page_status=*")}
    assert found == {"page_status=ok", "page_status=failed", "page_status=redirect"}


def test_register(spark):
    writers.register(spark.range(3), "three")
    assert spark.sql("SELECT count(*) FROM three").first()[0] == 3


def test_tables_are_spread_only_if_asked(spark):
    table = spark.range(0, 10, 1, 3)
    assert readers.spread(table, "id") is table
    assert readers.spread(table, "id", 5).rdd.getNumPartitions() == 5


def test_settle_uses_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert storage.shared_folder(spark) == folder
    before = spark.sparkContext.getCheckpointDir()
    df = storage.settle(spark.range(5))
    assert df.count() == 5 and folder in df.rdd._jrdd.rdd().context().getCheckpointDir().get()
    assert spark.sparkContext.getCheckpointDir() == before


def test_removed_folders_are_gone(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/x")
    storage.remove(spark, f"{tmp_path}/x")
    assert not (tmp_path / "x").exists()
