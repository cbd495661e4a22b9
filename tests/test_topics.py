"""Features and topics: long form against ML, and what holds for any clustering."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from topiclens import storage
from topiclens.operators import articles, bags, clusters, neighbours, terms, topics
from topiclens.plans import articles_to_topics, testbed

LIMITS = {"min_df": 2, "min_tf": 2, "vocab_size": 300}


@pytest.fixture(scope="module")
def docs(spark, small):
    return testbed.tokens(spark, small).persist()


@pytest.fixture(scope="module")
def model(docs):
    return topics.fit_topics(docs, k=6, max_iter=20, **LIMITS)


def test_counts_are_run_lengths(spark):
    df = spark.createDataFrame(
        [(1, ["b", "a", "b"]), (2, []), (3, ["x"]), (4, None)], "post_id long, tokens array<string>"
    )
    assert {tuple(r) for r in terms.term_counts(df).collect()} == {
        (1, "a", 1), (1, "b", 2), (3, "x", 1),
    }


def test_counts_equal_grouping(docs):
    grouped = docs.select("post_id", F.explode("tokens").alias("term")).groupBy("post_id", "term")
    expected = grouped.agg(F.count("*").alias("tf"))
    counts = terms.term_counts(docs)
    assert counts.exceptAll(expected).isEmpty() and expected.exceptAll(counts).isEmpty()


def test_vocabulary_limits(spark):
    tokens = [
        (1, ["a"] * 5 + ["b"] * 5 + ["c"]),
        (2, ["a", "c", "d"]),
        (3, ["a", "b", "c"]),
        (4, ["d"] * 4),
    ]
    df = spark.createDataFrame(tokens, "post_id long, tokens array<string>")
    counts = terms.term_counts(df)
    vocab = terms.vocabulary(counts, min_df=2, vocab_size=3, min_tf=5)
    found = [tuple(r) for r in vocab.orderBy("term_id").collect()]
    # d (5 in two documents) is in; c (3) is cut; documents count below min_tf too.
    assert found == [(0, "a", 7, 3, 1), (1, "b", 6, 2, 1), (2, "d", 5, 2, 0)]
    tied = terms.vocabulary(terms.term_counts(df.filter("post_id = 3")), 1, 2, 1)
    assert [r.term for r in tied.orderBy("term_id").collect()] == ["a", "b"]
    weights = terms.tfidf(counts, vocab, df, min_tf=5)
    assert {(r.post_id, r.term): r.tfidf for r in weights.collect()} == {
        (1, "a"): pytest.approx(5 * math.log(5 / 2)),
        (1, "b"): pytest.approx(5 * math.log(5 / 2)),
    }


def test_fraction_of_an_article(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b", "c"])], "post_id long, tokens array<string>")
    kept = terms.keep_frequent(terms.term_counts(df), 0.5)
    assert [r.term for r in kept.collect()] == ["a"]
    vocab = terms.vocabulary(terms.term_counts(df), 1, 10, 0.5).collect()
    assert {(r.term, r.kept_docs) for r in vocab} == {("a", 1), ("b", 0), ("c", 0)}


def test_kept_frames_of_the_caller_stay_kept(docs):
    topics.fit_features(docs, **LIMITS)
    assert docs.storageLevel.useMemory


def test_long_form_equals_ml(docs):
    """Above the tie at the border of the vocabulary, which ML does not order."""
    counts = terms.term_counts(docs)
    vocab = terms.vocabulary(counts, **LIMITS)
    border = vocab.agg(F.min("corpus_count")).first()[0]
    mine = terms.tfidf(counts, vocab, docs, LIMITS["min_tf"])
    shared = {r.term for r in vocab.filter(F.col("corpus_count") > border).collect()}
    features = topics.fit_features(docs, **LIMITS)
    words = features.stages[0].vocabulary
    ml = {
        (row.post_id, words[i]): x
        for row in features.transform(docs).select("post_id", "tfidf").collect()
        for i, x in zip(row.tfidf.indices, row.tfidf.values)
        if words[i] in shared
    }
    long = {(r.post_id, r.term): r.tfidf for r in mine.collect() if r.term in shared}
    assert long.keys() == ml.keys() and len(long) > 100
    assert all(long[key] == pytest.approx(ml[key]) for key in long)


def dense(docs, model):
    """Each article's vector, in full, as the model has it."""
    found = {}
    for row in clusters.vectors(docs, model.vocabulary, model.idf, model.min_tf).collect():
        found[row.post_id] = v = np.zeros(len(model.vocabulary))
        v[row.terms] = row.weights
    return found


def test_clusters(docs, model):
    vectors = dense(docs, model)
    topic = {r.post_id: r.topic for r in topics.assign_topics(model, docs).collect()}
    assert topic.keys() == vectors.keys() and len(topic) == docs.count()
    cost = 0.0
    for post, v in vectors.items():
        distances = ((model.centers - v) ** 2).sum(axis=1)
        assert topic[post] == distances.argmin()
        cost += distances.min()
    assert topics.model_cost(model) == pytest.approx(cost / clusters.UNIT**2, rel=1e-9)
    sizes = topics.topic_sizes(topics.assign_topics(model, docs))
    assert sizes.agg(F.sum("articles")).first()[0] == len(vectors)


def test_centers_are_means(docs):
    model = topics.fit_topics(docs, k=3, max_iter=100, **LIMITS)
    vectors = dense(docs, model)
    topic = {r.post_id: r.topic for r in topics.assign_topics(model, docs).collect()}
    for t, center in enumerate(model.centers):
        own = np.array([vectors[p] for p, x in topic.items() if x == t])
        assert np.abs(own.mean(axis=0) - center).max() <= 0.5


def test_vectors_equal_the_long_form(docs, model):
    counts = terms.term_counts(docs)
    long = terms.tfidf(counts, terms.vocabulary(counts, **LIMITS), docs, LIMITS["min_tf"])
    vectors = dense(docs, model)
    number = {t: i for i, t in enumerate(model.vocabulary)}
    rows = long.collect()
    assert len(rows) > 100
    for r in rows:
        assert vectors[r.post_id][number[r.term]] == pytest.approx(r.tfidf * clusters.UNIT, abs=0.51)
    assert sum((v > 0).sum() for v in vectors.values()) == sum(r.tfidf * clusters.UNIT >= 0.5 for r in rows)


@pytest.mark.parametrize("parts", [3, 17])
def test_same_centers_on_any_parts(docs, model, parts):
    again = topics.fit_topics(docs.repartition(parts), k=6, max_iter=20, **LIMITS)
    assert np.array_equal(again.centers, model.centers)
    assert again.cost == model.cost and again.vocabulary == model.vocabulary


def test_starts_are_distinct(spark):
    rows = [(i, ["a"] * (1 + i // 30)) for i in range(60)] + [(99, None)]
    df = spark.createDataFrame(rows, "post_id long, tokens array<string>")
    model = topics.fit_topics(df, k=25, min_df=1, min_tf=1, vocab_size=9)
    # Three different articles make three topics, and no cost is left.
    assert model.k == 3 and model.cost == 0
    assert clusters.assign(model, df.where("post_id < 0")).count() == 0
    none = topics.fit_topics(df.where("post_id < 0"), k=2)
    assert none.k == 0 and [r.topic for r in topics.assign_topics(none, df).collect()] == [0] * 61


def test_top_terms_break_ties_by_term(spark):
    weights = spark.createDataFrame(
        [(1, "b", 0.5), (1, "a", 0.5), (1, "c", 0.9), (2, "z", 0.1)],
        "topic int, term string, weight double",
    )
    top = topics.top_terms(weights, 2)
    assert {(r.topic, r.term, r["rank"]) for r in top.collect()} == {
        (1, "c", 1), (1, "a", 2), (2, "z", 1),
    }


def test_model_survives_writing(spark, docs, model):
    path = f"{storage.shared_folder(spark)}/model-test"
    topics.save_model(model, path)
    again = topics.load_model(path)
    before = topics.assign_topics(model, docs)
    after = topics.assign_topics(again, docs)
    assert before.exceptAll(after).isEmpty() and after.count() == docs.count()
    table = topics.topic_terms_table(topics.model_centroids(spark, again))
    assert table.columns == ["topic", "term", "weight", "rank"]
    assert table.agg(F.max("rank")).first()[0] <= 10


def test_new_articles_get_a_known_topic(spark, small):
    model = articles_to_topics.learn_topics(testbed.texts(spark, small), k=4, **LIMITS)
    new = spark.createDataFrame([(1, "Entirely new words."), (2, "")], "post_id long, text string")
    found = articles_to_topics.label_articles(model, new).collect()
    assert {r.post_id for r in found} == {1, 2} and all(0 <= r.topic < 4 for r in found)


def test_empty_vectors_can_be_dropped(docs):
    features = topics.fit_features(docs, **LIMITS).transform(docs)
    kept = topics.with_any_term(features).count()
    assert 0 < kept < features.count()


def test_cost_falls_with_k(docs):
    sweep = {r.k: r for r in topics.k_sweep(docs, [2, 12], **LIMITS).collect()}
    assert sweep[12].cost < sweep[2].cost
    assert sweep[2].scaled_cost == pytest.approx(sweep[2].cost / 1e6)


def test_lda_terms(docs):
    found = topics.lda_topics(docs, k=3, max_iter=5, top_k=4, **LIMITS).collect()
    assert len(found) == 12 and {r.topic for r in found} == {0, 1, 2}
    assert all(r.weight > 0 and r.term for r in found)
    assert {r["rank"] for r in found} == {1, 2, 3, 4}


def test_lda_deals_out_numbers_and_no_words(docs, monkeypatch):
    seen, deal = [], topics.dealt
    monkeypatch.setattr(topics, "dealt", lambda df, *rest: seen.append(df) or deal(df, *rest))
    found = topics.lda_topics(docs, k=3, max_iter=5, top_k=4, **LIMITS).collect()
    (dealt,) = seen
    assert dealt.columns == ["post_id", "tfidf"]
    # The vectors are Spark ML's, by its vocabulary, but for the order of terms that are equally common.
    features = topics.fit_features(docs, **LIMITS)
    counts, idf = features.stages
    made = topics.tfidf_vectors(storage.settle(bags.of(docs)), counts.vocabulary, idf.idf.toArray().tolist(), counts.getMinTF())
    expected = {r.post_id: r.tfidf for r in features.transform(docs).collect()}
    assert {r.post_id: r.tfidf for r in made.collect()} == expected
    again = topics.lda_topics(storage.settle(bags.of(docs.repartition(5))), k=3, max_iter=5, top_k=4, **LIMITS).collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in found]


def test_bags_are_counted_as_tokens_are(spark):
    rows = [(1, ["a", "b", "a", None]), (2, []), (3, None), (2, ["c", "a"]), (None, ["b"])]
    df = spark.createDataFrame(rows, "post_id long, tokens array<string>")
    counted = Counter(map(tuple, terms.term_counts(df).collect()))
    assert Counter(map(tuple, terms.term_counts(bags.of(df)).collect())) == counted
    assert counted[(1, "a", 2)] == counted[(2, "c", 1)] == counted[(None, "b", 1)] == 1


def test_synonyms(docs):
    found = topics.synonyms(docs, "thing", 5, contexts=200, directions=8).collect()
    assert len(found) == 5 and all(r.word != "thing" and abs(r.similarity) <= 1.01 for r in found)
    again = topics.synonyms(docs.repartition(11), "thing", 5, contexts=200, directions=8).collect()
    assert again == found
    assert topics.synonyms(docs, "no such word").collect() == []
    assert topics.synonyms(docs.limit(0), "thing").collect() == []


def test_pairs_are_counted_within_the_window(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b", "c", "a"]), (2, ["b"]), (3, None), (4, [None, "a", "b"])], "post_id long, tokens array<string>"
    )
    common = spark.createDataFrame([("a",), ("b",)], "term string")
    found = neighbours.pair_counts(df, common, window=2)
    # a b c a: b and the last a are two places apart.
    assert {tuple(r) for r in found.collect()} == {
        ("a", "b", 3), ("b", "a", 3), ("c", "a", 2), ("c", "b", 1),
    }


def test_directions_keep_what_the_greatest_singular_vectors_do(spark):
    r = np.random.default_rng(2)
    matrix = np.maximum(r.normal(size=(80, 6)) @ r.normal(size=(6, 30)) + r.normal(size=(80, 30)) * 0.05, 0)
    rows = [(str(i), *zip(*[(j, int(x * 1024)) for j, x in enumerate(row) if x > 0])) for i, row in enumerate(matrix)]
    df = spark.createDataFrame([(w, list(p), list(x)) for w, p, x in rows], "word string, places array<int>, weights array<long>")
    a = neighbours.directions_of(df.repartition(1), 30, 5, rounds=12)
    b = neighbours.directions_of(df.repartition(7), 30, 5, rounds=12)
    assert np.array_equal(a, b)
    kept = np.linalg.norm(matrix @ (a / 65536))
    best = np.sqrt((np.linalg.svd(matrix)[1][:5] ** 2).sum())
    assert kept == pytest.approx(best, rel=1e-3)
    assert np.abs(a.T @ a / 65536**2 - np.eye(5)).max() < 1e-3


def test_words_used_alike_are_near(spark):
    # cat and dog stand among the same words, sun among others.
    sentence = {"cat": "the pet {} eats food", "dog": "the pet {} eats food", "sun": "a star {} warms rock"}
    rows = [(i, text.format(w).split()) for i, (w, text) in enumerate(sentence.items())] * 9
    df = spark.createDataFrame(rows, "post_id long, tokens array<string>")
    found = topics.synonyms(df, "cat", 20, directions=4).collect()
    assert found[0].word == "dog" and found[0].similarity == pytest.approx(1.0, abs=1e-3)
    assert {r.word: r.similarity for r in found}["sun"] < 0.2


def test_lemma_table(spark):
    counts = spark.createDataFrame(
        [(1, "cats", 2), (1, "cat", 1), (2, "dogs", 3), (2, "mice", 1)],
        "post_id long, term string, tf long",
    )
    table = spark.createDataFrame([("cats", "cat"), ("mice", "mouse")], "term string, lemma string")
    assert {tuple(r) for r in terms.lemmatize(counts, table).collect()} == {
        (1, "cat", 3), (2, "dogs", 3), (2, "mouse", 1),
    }
    # Only cats has its singular in the corpus.
    assert [tuple(r) for r in terms.plural_lemmas(counts).collect()] == [("cats", "cat")]
    assert {r.stem for r in terms.stem_terms(counts).collect()} == {"cat", "dog", "mice"}


def test_stemmed_topics(spark):
    lines = spark.createDataFrame(
        [
            (1, "Cats and <b>dogs</b>: the cat's cats."),
            (2, "#REDIRECT [[cat]]"),
            (3, "relational operators operate"),
            (4, "the 12"),
        ],
        "post_id long, text string",
    )
    bags = {r.post_id: sorted(r.tokens) for r in articles_to_topics.stemmed_tokens(lines).collect()}
    assert bags == {1: ["cat", "cat", "cat", "dog"], 3: ["oper", "oper", "relat"], 4: []}
    model = articles_to_topics.learn_stemmed_topics(lines, k=2)
    assert sorted(topics.model_vocabulary(model)) == ["cat", "dog", "oper", "relat"]
    weights = topics.model_centroids(spark, model)
    assert {r.topic for r in weights.collect()} <= {0, 1}


def test_nearest_centroid(spark):
    vectors = spark.createDataFrame(
        [(1, 0, [0.0, 0.0]), (2, 0, [2.0, 0.0]), (3, 1, [9.0, 9.0]), (4, 1, [2.0, 0.5])],
        "vec_id long, topic int, vector array<double>",
    )
    centers = topics.dense_centers(vectors)
    assert {r.topic: r.center for r in centers.collect()} == {0: [1.0, 0.0], 1: [5.5, 4.75]}
    nearest = topics.nearest_centroid(vectors, centers)
    assert {(r.vec_id, r.topic) for r in nearest.collect()} == {(1, 0), (2, 0), (3, 1), (4, 0)}
    cost = topics.clustering_cost(nearest).first()
    assert cost.cost == pytest.approx(1 + 1 + 3.5**2 + 4.25**2 + 1 + 0.25)
    tied = spark.createDataFrame([(2, [1.0]), (1, [-1.0])], "topic int, center array<double>")
    zero = spark.createDataFrame([(1, [0.0])], "vec_id long, vector array<double>")
    assert topics.nearest_centroid(zero, tied).first().topic == 1


def test_terms_are_counted_across_pieces(spark, monkeypatch):
    rows = [(1, ["b", "a", "b"]), (2, []), (3, None), (1, ["a"]), (4, ["a"] * 9)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.list_(pa.string()))], ["post_id", "tokens"])
    assert [(p.num_rows, sizes.tolist()) for p, sizes in terms.pieces(batch, 3)] == [(3, [3, 0, 0]), (1, [1]), (1, [9])]
    df = spark.createDataFrame(rows, "post_id long, tokens array<string>")
    found = terms.term_counts(df)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [(1, "a", 1), (1, "a", 1), (1, "b", 2), (4, "a", 9)]


def test_lemmas_are_looked_up_where_the_tokens_are(spark):
    df = spark.createDataFrame([(1, ["cats", "x", "cats"]), (2, []), (3, None)], "post_id long, tokens array<string>")
    table = spark.createDataFrame([("cats", "cat"), ("dogs", "dog"), (None, "y")], "term string, lemma string")
    found = articles.with_lemmas(df, table)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    expected = [(1, ["cat", "x", "cat"]), (2, []), (3, None)]
    assert sorted(map(tuple, found.collect())) == expected
    assert sorted(map(tuple, articles.joined_lemmas(df, table).collect())) == expected


def test_rounds_have_no_more_tasks_than_they_need(spark, monkeypatch):
    df = spark.createDataFrame([(i, ["a"] * (i % 3 + 1) + ["b"]) for i in range(90)], "post_id long, tokens array<string>")
    used = []
    step = clusters.step
    monkeypatch.setattr(clusters, "step", lambda found, c: used.append(found.rdd.getNumPartitions()) or step(found, c))
    clusters.learn(df.repartition(70), [2], 5, 1, 1, 10)
    assert used and max(used) <= spark.sparkContext.defaultParallelism


def test_costs_beyond_64_bits(spark):
    big = 1 << 31
    found = spark.createDataFrame([(i, [0], [big]) for i in range(9)], "post_id long, terms array<int>, weights array<long>")
    moved, cost = clusters.step(found.coalesce(1), np.zeros((1, 1), np.int64))
    assert cost == 9 * big**2 > 1 << 64 and moved.tolist() == [[big]]


def test_parts_of_lda_grow_before_their_number(spark):
    def parts(n):
        return topics.dealt(spark.range(n).withColumnRenamed("id", "post_id")).rdd.getNumPartitions()

    assert [parts(n) for n in (10, 3500, 200_000, 1_600_000)] == [1, 4, 64, 100]


def test_stripes_equal_pairs_counted_one_by_one(spark, monkeypatch):
    r = np.random.default_rng(3)
    texts = [[str(x) for x in r.integers(0, 9, r.integers(0, 30))] for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "post_id long, tokens array<string>").repartition(5)
    common = spark.createDataFrame([("1",), ("4",), ("none",)], "term string")
    expected = Counter()
    for t in texts:
        for i, word in enumerate(t):
            expected.update((word, c) for c in [*t[max(i - 3, 0) : i], *t[i + 1 : i + 4]] if c in ("1", "4"))
    assert {(a, b): n for a, b, n in neighbours.pair_counts(df, common, 3).collect()} == expected
    stripes = neighbours.pair_stripes(df, neighbours.common_words(common), 3)
    # One exchange of stripes besides the test's own, and none of pairs.
    assert stripes._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    assert stripes.count() == len({a for a, _ in expected})


def test_rare_words_are_no_synonyms(spark):
    # once stands beside ten words, but occurs only one time.
    rows = [(i, ["the", "pet", "cat", "eats", "food", "the", "pet", "dog", "eats", "food"]) for i in range(6)]
    rows.append((9, ["the", "pet", "once", "eats", "food"] * 1 + ["the", "pet"]))
    df = spark.createDataFrame(rows, "post_id long, tokens array<string>")
    words = {r.word for r in topics.synonyms(df, "cat", 20, directions=4).collect()}
    assert "dog" in words and "once" not in words


def _bags(found):
    """What each article has how often, and the number of pieces."""
    rows = found.select(*bags.NAMES).coalesce(1).toArrow().combine_chunks().to_batches()
    pieces = list(bags.opened(iter(rows)))
    held = []
    for p in pieces:
        names, ids = p.words.to_pylist(), p.ids.to_pylist()
        counts = [Counter() for _ in ids]
        for owner, number, n in zip(p.owner, p.number, p.n):
            counts[owner][names[number]] += int(n)
        held += zip(ids, counts)
    return held, len(pieces)


TEXTS = [
    "Cats, cats &nbsp 3d 12 1.5 it’s it's rock'n'roll", None, "", "x.y a\nb &nb\nsp End.", "K İ ſ é über <b>5</b> cats",
    "12 1990s 3.000 ' '' the THE The", "\x00\x85 日本 dogs\tdogs",
]


def test_bags_count_the_tokens(spark, monkeypatch):
    monkeypatch.setattr(bags, "TEXT_BYTES", 60)
    df = spark.createDataFrame([(i // 2, t) for i, t in enumerate(TEXTS)], "post_id long, text string").coalesce(1)
    tokens = articles.with_tokens(df)
    expected = sorted((r.post_id, sorted(Counter(r.tokens or []).items())) for r in tokens.collect())
    for made in (bags.of_articles(df), bags.of_tokens(tokens)):
        held, _ = _bags(made)
        assert sorted((i, sorted(c.items())) for i, c in held) == expected
    assert _bags(bags.of_articles(df))[1] > 1
    assert "Generate" not in bags.of_articles(df)._jdf.queryExecution().executedPlan().toString()


def test_words_of_bags_are_replaced_by_lookup_or_join(spark):
    rows = [(1, ["cats", "cat", "x", "cats"]), (2, []), (None, ["dogs"]), (1, ["cat"])]
    df = storage.settle(bags.of_tokens(spark.createDataFrame(rows, "post_id long, tokens array<string>").coalesce(2)))
    table = spark.createDataFrame([("cats", "cat"), ("dogs", "dog"), ("y", "z")], "term string, target string")
    expected = [(1, {"cat": 3, "x": 1}), (1, {"cat": 1}), (2, {}), (None, {"dog": 1})]
    for made in (bags.with_terms(df, table, "target"), bags.joined_terms(df, table)):
        assert sorted(_bags(made)[0], key=str) == sorted(expected, key=str)


def test_models_of_a_sweep_share_their_rounds(spark, monkeypatch):
    rows = [(i, ["a"] * (i % 7) + ["b"] * (i % 5) + ["c"] * (i % 3)) for i in range(90)]
    df = spark.createDataFrame(rows, "post_id long, tokens array<string>")
    alone = [clusters.learn(df, [k], 30, 1, 1, 10)[0] for k in (2, 4, 8)]
    passes, sums = [], clusters.sums
    monkeypatch.setattr(clusters, "sums", lambda found, *models: passes.append(len(models)) or sums(found, *models))
    together = clusters.learn(df, [2, 4, 8], 30, 1, 1, 10)
    assert passes[0] == 3 and len(passes) < sum(passes)
    for a, b in zip(alone, together):
        assert a.cost == b.cost and np.array_equal(a.centers, b.centers)


def test_stemmed_bags_equal_stemmed_tokens(spark):
    # Articles 1 and the nameless one share ids; the others are alone.
    rows = [(1, "operators operate <i>cats</i>"), (2, "cats and cat"), (1, "operating"), (None, "dogs"), (None, None), (3, "#REDIRECT x")]
    df = spark.createDataFrame(rows, "post_id long, text string")
    expected = [(r.post_id, Counter(r.tokens)) for r in articles_to_topics.stemmed_tokens(df).collect()]
    assert sorted(_bags(articles_to_topics.stemmed_bags(df))[0], key=str) == sorted(expected, key=str)


def test_topics_are_learnt_from_bags_that_gave_the_lemmas(spark, monkeypatch):
    rows = [(i, "cats and a cat " * 5 if i % 2 else "dogs bark " * (5 + i % 3)) for i in range(12)]
    df = spark.createDataFrame(rows, "post_id long, text string")
    held = storage.settle(bags.of_articles(df))
    lemmas = storage.settle(articles_to_topics.corpus_lemmas(held))
    limits = {"k": 2, "min_df": 1, "min_tf": 1}
    expected = articles_to_topics.learn_topics(df, lemmas, **limits)
    monkeypatch.setattr(bags, "of_articles", None)  # no text is parsed again
    model = articles_to_topics.learn_topics(held, lemmas, **limits)
    assert "cats" not in model.vocabulary and model.vocabulary == expected.vocabulary
    assert model.cost == expected.cost and np.array_equal(model.centers, expected.centers)


def test_rounds_read_and_send_bytes(spark, monkeypatch):
    rows = [(i, ["a"] * (i % 7) + ["b"] * (i % 5) + ["c"] * (i % 3)) for i in range(90)] + [(None, ["a"]), (91, None)]
    df = storage.settle(bags.of_tokens(spark.createDataFrame(rows, "post_id long, tokens array<string>").coalesce(3)))
    assert not any("array<int>" in kind for _, kind in df.dtypes)
    args = (["a", "b", "c"], [0.5, 1.5, 2.5], 1)
    held, plain = clusters.blocks(df, *args), clusters.vectors(df, *args)
    assert [kind for _, kind in held.dtypes] == ["array<bigint>", "binary", "binary", "binary"]
    assert sorted(map(str, clusters.opened(held).collect())) == sorted(map(str, plain.collect()))
    centers = clusters.start_centers(held, 4, 3)
    assert np.array_equal(centers, clusters.start_centers(plain, 4, 3))
    monkeypatch.setattr(clusters, "SPAN", 4)
    found = clusters.sums(held, centers).collect()
    # A row for each part of a topic, not for each term.
    assert found and len(found) <= 8 and sorted(found) == sorted(clusters.sums(plain, centers).collect())
    (moved, cost), (again, same) = clusters.step(held, centers), clusters.step(plain, centers)
    assert np.array_equal(moved, again) and cost == same
    assert clusters.blocks(df.limit(0), *args).count() == 0
