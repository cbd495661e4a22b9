"""Fitted operators: edges, and accuracy on rows that were held out."""

import math
import random
import zlib

import numpy as np
from fixtures import documents, prose, rows_of

from topiclens.llm import languages, quality, toxicity
from topiclens.llm.fitting import bounded_sample
from topiclens.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def left_out(id, parts, remainder):
    return zlib.crc32(str(id).encode()) % parts == remainder


def test_languages_on_held_out_rows(spark, small):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    got = QUERIES["op4_string_kernel"](spark, MEDIUM).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == left_out(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_language_edges(spark):
    rows = [(i, prose(i, 40), "xx") for i in range(30)]
    rows += [(100 + i, "".join(random.Random(i).choices("äöü ßqwz", k=200)), "yy") for i in range(30)]
    rows += [(200, prose(1, 5), None), (201, None, "xx")]
    model = languages.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["xx", "yy"]
    texts = [None, "", "123 !? 🙂", "alpha beta", "ÄÖÜ ß", "äöü " * 20_000 + "alpha", "alpha beta", "a"]
    out = languages.identified(documents(spark, list(enumerate(texts))), model)
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert [got[i] for i in (0, 1, 2)] == [("und", 0.0)] * 3
    assert [got[i][0] for i in (3, 4, 5)] == ["xx", "yy", "yy"] and got[3] == got[6]
    kept = languages.in_known_languages(documents(spark, list(enumerate(texts))), model)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7]
    assert languages.identified(documents(spark, []), model).collect() == []
    nothing = languages.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert rows_of(languages.identified(documents(spark, [(1, "abc")]), nothing)) == [(1, "und", 0.0)]


def test_without_labels_texts_with_a_letter_stay(spark):
    rows = [(1, "abc", None), (2, "12 !?", None), (3, None, None), (4, "", None), (5, "é", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = languages.in_known_languages(docs, languages.fit(docs))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 5]


def test_passages_to_fit_on_are_bounded(spark, monkeypatch):
    rows = [(i, prose(i, 2000), "xx") for i in range(7)] + [(9, "äöü ", "yy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = sum(len(languages.passages(t)) for _, t, x in rows if x == "xx")
    seen = []
    kernel = languages._kernel
    monkeypatch.setattr(languages, "_kernel", lambda parts, landmarks: seen.extend(parts) or kernel(parts, landmarks))
    # A whole step would let all of them through.
    languages.fit(docs, most_passages=whole - 2)
    assert len(seen) == whole - 2 + 1
    assert languages._spread([1, 2, 3], 3) == [1, 2, 3] and languages._spread([*range(7)], 3) == [0, 2, 4]


def test_presences_do_not_span_passages():
    together, _ = languages.presences(["ab", "cd"])
    alone = np.concatenate([languages.presences([p])[0] for p in ("ab", "cd")])
    assert (together == alone).all()


def test_quality_on_held_out_rows(spark, small):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    got = QUERIES["op5_line_crf"](spark, MEDIUM).collect()
    assert all(r.held_out == left_out(r.doc_id, 3, 1) and 0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(1)
    good, moves = rng.normal(size=9), rng.normal(size=(2, 2))
    owner = np.array([0] * 4 + [2] * 1 + [5] * 4)
    got, pair, inner = quality.chances(good, owner, moves)
    for name in (0, 2, 5):
        at = np.flatnonzero(owner == name)
        weights, n = {}, len(at)
        for path in range(2**n):
            y = [(path >> k) & 1 for k in range(n)]
            score = sum(good[at[k]] * y[k] for k in range(n)) + sum(moves[y[k - 1], y[k]] for k in range(1, n))
            weights[tuple(y)] = math.exp(score)
        whole = sum(weights.values())
        for k in range(n):
            assert math.isclose(got[at[k]], sum(w for y, w in weights.items() if y[k]) / whole)
        for k in range(1, n):
            row = int(np.flatnonzero(inner == at[k])[0])
            for a in (0, 1):
                for b in (0, 1):
                    want = sum(w for y, w in weights.items() if (y[k - 1], y[k]) == (a, b)) / whole
                    assert math.isclose(pair[row, a, b], want)


def test_quality_edges(spark):
    texts = [prose(i, 60).replace("alpha", "\n") for i in range(20)] + ["AB!! " * 40 for _ in range(20)]
    docs = documents(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(40)] + [(77, 1), (None, 0), (3, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    odd = [None, "", "\n\n ", prose(99, 60), "XY!! " * 30, prose(5, 20_000), "one\n" * 5000, prose(99, 60)]
    got = {r.doc_id: r for r in quality.scored(documents(spark, list(enumerate(odd))), model).collect()}
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[0].score == got[1].score == got[2].score < 0.5 and got[0].line_chances == []
    assert got[3].score > 0.5 > got[4].score and got[3].score == got[7].score
    assert len(got[6].line_chances) == 5000
    assert quality.scored(documents(spark, []), model).collect() == []
    for none in (labels.where("quality = 1"), labels.where("quality > 1")):
        rows = quality.scored(docs, quality.fit(docs, none)).collect()
        assert len(rows) == 40 and len({r.score for r in rows}) == 1


def test_toxicity_edges_and_offending_sentences(spark):
    texts = [prose(i, 80).replace("alpha", "end.\n") + (" You vile thing!" if i % 2 else "") for i in range(80)]
    docs = documents(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(500, 1), (None, 0), (61, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    assert all((got[i].score >= 0.5) == bool(i % 2) for i in range(80))
    for i in range(1, 80, 2):
        (hit,) = got[i].offending
        assert "You vile thing" in texts[i][hit.start : hit.end]
    odd = [None, "", "...", "🙂 you vile thing!", "you vile thing. " * 3000, prose(3, 20_000)]
    rows = {r.doc_id: r for r in toxicity.scored(documents(spark, list(enumerate(odd))), model).collect()}
    assert rows[0].score == rows[1].score == rows[2].score == 0 and rows[3].score >= 0.5
    assert rows[4].score == 1.0 and len(rows[4].offending) == 3000 and 0 <= rows[5].score <= 1
    assert toxicity.scored(documents(spark, []), model).collect() == []
    alike = toxicity.fit(docs, labels.where("toxic = 0"))
    assert all(r.score < 0.5 for r in toxicity.scored(docs, alike).collect())


def test_rare_toxic_words_are_learned():
    toxic = [prose(i, 60) + (" A zorvexian." if i < 10 else " You vile thing.") for i in range(300)]
    model = toxicity._fit(toxic + [prose(300 + i, 60) for i in range(300)], [1] * 300 + [0] * 300)
    clean = [prose(700 + i, 60) for i in range(20)]
    scores, found = toxicity._scorer(model)([*clean, *(t + " What a zorvexian." for t in clean)])
    assert all(x < 0.5 for x in scores[:20]) and all(x >= 0.5 for x in scores[20:])
    assert all(len(x) == 1 for x in found[20:])


def test_toxicity_query(spark, small):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    got = QUERIES["op8_noisy_or"](spark, MEDIUM).collect()
    assert all(r.held_out == left_out(r.doc_id, 5, 0) and 0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
    # Few labels at this size: those fitted on are told apart, and clean ones stay clean.
    known = [r for r in got if r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in known) >= 0.9 * len(known)


def test_bounded_sample_is_bounded_and_does_not_depend_on_partitions(spark):
    rows = spark.range(20_000).selectExpr("id", "IF(id % 10 = 0, 'a', 'b') AS label")
    one = {r.id for r in bounded_sample(rows.coalesce(1), "label", "id", 300).collect()}
    many = bounded_sample(rows.repartition(13), "label", "id", 300)
    assert one == {r.id for r in many.collect()} and 450 < len(one) < 750
    assert bounded_sample(rows.where("id < 100"), "label", "id", 300).count() == 100
