"""Polarity, transitions and shares on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from topiclens.operators import extras
from topiclens.plans import testbed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_longer_phrases_hold_shorter_ones(spark):
    lexicon = spark.createDataFrame(
        [("good", 3), ("not good", -2), ("not", -1), ("a b c d", 5), ("c d", 1), ("d e", 7)],
        "term string, polarity long",
    )
    texts = {1: "not good good", 2: "a b c d e", 3: "none", 4: "", 5: "good not"}
    docs = spark.createDataFrame([(i, t.split()) for i, t in texts.items()], "post_id long, tokens array<string>")
    got = {r.post_id: (r.polarity, r.matches) for r in extras.polarity(docs, lexicon).collect()}
    assert got == {1: (1, 2), 2: (12, 2), 3: (0, 0), 4: (0, 0), 5: (2, 2)}


def test_transitions_cross_stretches(spark):
    rows = [("s", 10, 2, "b"), ("s", 10, 1, "a"), ("s", 9000, 3, "c"), ("s", 90_000, 4, "a"), ("t", 5, 5, "a")]
    hits = spark.createDataFrame(rows, "session_id string, s long, event_id long, keyword string")
    hits = hits.selectExpr("session_id", "timestamp_seconds(s) AS ts", "event_id", "keyword")
    got = {(r.event, r.next_event): (r.transitions, r.probability) for r in extras.event_transitions(hits).collect()}
    assert got == {("a", "b"): (1, 1.0), ("b", "c"): (1, 1.0), ("c", "a"): (1, 1.0)}


def test_top_share_counts_ties_by_user(spark):
    rows = [(f"u{i:02}", 1.0) for i in range(19)] + [("u19", 5.0), ("u19", 5.0), ("u05", None)]
    hits = spark.createDataFrame(rows, "uuid string, hit_revenue double")
    row = extras.top_share(hits).first()
    assert (row.users, row.top_users, row.revenue, row.top_revenue) == (20, 2, 29.0, 11.0)
    assert row.top_share == pytest.approx(11 / 29)


def test_a_copied_lexicon_gives_what_a_joined_one_does(spark, monkeypatch):
    r = random.Random(5)
    texts = [[r.choice("abcd") for _ in range(r.randrange(12))] for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "post_id long, tokens array<string>")
    terms = {" ".join(r.choice("abcd") for _ in range(r.randrange(1, 5))) for _ in range(25)}
    rows = [(t, r.randrange(-5, 6)) for t in sorted(terms)]
    lexicon = spark.createDataFrame([*rows, rows[0], ("a b c d a", 9)], "term string, polarity long")
    copied = extras.polarity(docs, lexicon)
    # No n-gram travels: the only exchanges are of a row for each article.
    assert "posexplode" not in plan(copied)
    got = sorted(map(tuple, copied.collect()))
    monkeypatch.setattr(extras, "HELD", 3)
    joined = extras.polarity(docs, lexicon)
    assert "posexplode" in plan(joined)
    assert sorted(map(tuple, joined.collect())) == got and any(m for _, _, m in got)


def test_a_lexicon_is_held_as_numbers(spark):
    r = random.Random(7)
    words = [f"word{i}" for i in range(300)]
    terms = {" ".join(r.choice(words) for _ in range(n)) for n in (1, 2, 2, 2, 2, 3, 4) for _ in range(900)}
    rows = [(t, r.randrange(-5, 6)) for t in sorted(terms)]
    lexicon = spark.createDataFrame([*rows, rows[0], (None, 3), ("one of five words here", 2)], "term string, polarity long")
    settled = lexicon.where("term IS NOT NULL").groupBy("term").agg(
        F.sum("polarity").alias("polarity"), F.count("*").alias("times")
    )
    held = extras._phrases(settled)
    size = sum(len(keys) for keys, _, _ in held.levels)
    assert sum(x.nbytes for level in held.levels for x in level) == 10 * size and size >= len(terms)
    texts = [[r.choice([*words, "other"]) for _ in range(r.randrange(60))] for _ in range(40)]
    texts += [t.split(" ") for t, _ in rows[:300]]
    docs = spark.createDataFrame([*enumerate(texts), (9999, [None, *words[:1]])], "post_id long, tokens array<string>")
    looked, joined = (
        {x.post_id: (x.polarity, x.matches) for x in df.groupBy("post_id").agg(
            F.sum("polarity").alias("polarity"), F.sum("matches").alias("matches")
        ).collect() if x.matches}
        for df in (extras._looked_up(docs, held), extras._joined(docs, settled))
    )
    assert looked == joined and len(looked) > 250


def test_texts_are_not_shuffled_to_their_labels(spark, small):
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        shown = plan(testbed.lexicon(spark, small))
    finally:
        spark.conf.set(key, before)
    assert shown.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in shown


def test_texts_meet_labels_before_their_words_travel(spark, small):
    with_labels = testbed.lexicon(spark, small)
    shown = plan(with_labels)
    # The plan is read from its end: words are taken apart above the join.
    assert shown.index("explode(") < shown.index("Join")
    assert with_labels.where(F.col("polarity") == 0).count() == 0
