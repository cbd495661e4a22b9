import random
from itertools import combinations

import pytest
from fixtures import documents, prose, rows_of

from topiclens.llm import near_duplicates
from topiclens.llm.components import components
from topiclens.llm.queries import QUERIES


def brute(rows, least=75):
    """Sets and least reachable ids, by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    group = {i: i for i in sets}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= least * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            group[y] = x
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


def told(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else w + "z" for w in text.split())


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"),
            (7, prose(1, 300)), (8, prose(1, 300).upper()), (9, prose(1, 300) + " tail"),
            (10, prose(2, 20_000)), (11, prose(2, 20_000)), (12, "a b c d e f"), (13, "a b c d e f")]
    got = told(near_duplicates.duplicate_groups(documents(spark, rows)))
    assert got == brute(rows)
    assert got[1] == (0, 1, True) and got[5] == (1, 4, False) and got[9][1] == 7


def test_null_id_repeated_rows_and_empty_table(spark):
    rows = [(None, prose(3, 50)), (1, prose(3, 50)), (1, prose(3, 50)), (2, prose(3, 50))]
    got = rows_of(near_duplicates.duplicate_groups(documents(spark, rows)))
    assert got == [(1, 46, 1, True), (1, 46, 1, True), (2, 46, 1, False), (None, 46, None, True)]
    assert near_duplicates.duplicate_groups(documents(spark, [])).collect() == []


def test_many_near_copies_and_a_shared_passage(spark):
    base, passage = prose(5, 120), prose(6, 60)
    rows = [(i, edited(base, i, 0.012 * (i % 4))) for i in range(120)]
    rows += [(1000 + i, f"{prose(100 + i, 40)} {passage} {prose(500 + i, 20)}") for i in range(150)]
    rows += [(2000 + i, edited(rows[120 + i][1], i, 0.02)) for i in range(0, 150, 10)]
    random.Random(1).shuffle(rows)
    got = told(near_duplicates.duplicate_groups(documents(spark, rows)))
    want = brute(rows)
    assert got == want
    assert len({v[1] for v in want.values()}) > 100


@pytest.mark.parametrize("small", [2, 1000])
def test_buckets_of_any_size_give_the_same(spark, monkeypatch, small):
    monkeypatch.setattr(near_duplicates, "SMALL", small)
    rows = [(i, edited(prose(7, 100), i, 0.05)) for i in range(60)]
    assert told(near_duplicates.duplicate_groups(documents(spark, rows))) == brute(rows)


def test_without_duplicates_keeps_columns(spark):
    docs = documents(spark, [(1, prose(1, 30)), (2, prose(1, 30)), (3, None)])
    kept = near_duplicates.without_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = dict(rows_of(components(spark.createDataFrame(links, "a long, b long"))))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_query_against_all_pairs(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert told(QUERIES["op7_circulant_minhash"](spark, small)) == brute([tuple(r) for r in docs])
