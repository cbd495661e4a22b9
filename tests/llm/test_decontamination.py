import hashlib
import re

import pytest
from fixtures import documents, prose, rows_of

from topiclens.llm import decontamination


def words(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(docs, items):
    wins = set()
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        wins |= {(i, tuple(w[j : j + n])) for j in range(len(w) - n + 1) if n and i is not None}
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for i, win in wins:
            for j in range(len(w) - len(win) + 1):
                if tuple(w[j : j + len(win)]) == win:
                    hit |= set(range(j, j + len(win)))
                    found.add(str(i))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=lambda r: [(x is None, str(x)) for x in r])


ITEMS = [
    (1, prose(1, 30)), (2, prose(2, 12)), (3, prose(1, 30)[:80]), (12, "short item"), (4, "Éclair!"),
    (5, "seven words are fewer than ten, indeed"), (6, None), (7, ""), (8, "..."), (None, prose(9, 15)),
    (9, "a a a a a a a a a a a a"),
]


def test_against_brute_force(spark):
    p = ITEMS[0][1].split()
    docs = [
        (1, prose(50, 40) + " " + " ".join(p[5:20]).upper() + ", " + prose(51, 9)),
        (2, " ".join(p[:9]) + " x " + " ".join(p[10:19])),  # nine words on either side
        (3, " ".join(p[:10])), (4, None), (5, ""), (6, "the short-ITEM éclair; Éclair"),
        (7, "x " + "a " * 25), (8, ("; ".join([ITEMS[1][1]] * 3))), (9, prose(1, 30) + prose(2, 12)),
        (10, prose(3, 20_000) + " " + ITEMS[1][1]), (11, "seven words are fewer than ten indeed"),
        (3, "another text of the same id: short item"), (None, "short item"), (12, prose(9, 15)),
        (6, "the short-ITEM éclair; Éclair"),
    ]
    got = rows_of(decontamination.contamination(documents(spark, docs), spark.createDataFrame(ITEMS, "item_id long, text string")))
    assert got == brute(docs, ITEMS)


@pytest.mark.parametrize("rows", [0, 1 << 20])
def test_copied_or_shuffled_test_data_give_the_same(spark, monkeypatch, rows):
    monkeypatch.setattr(decontamination, "COPIED_ROWS", rows)
    docs = [(i, prose(100 + i, 30) + (" " + ITEMS[i % 2][1] if i % 3 else "")) for i in range(40)]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows_of(decontamination.contamination(documents(spark, docs), items)) == brute(docs, ITEMS)


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, [(1, prose(1, 30))])
    assert rows_of(decontamination.contamination(docs, items), "n_words", "n_hit") == [(30, 0)]
    assert decontamination.contamination(documents(spark, []), items).collect() == []
    assert decontamination.without_passages(docs, items).count() == 1


def test_clean_documents_stay(spark):
    docs = documents(spark, [(1, ITEMS[0][1]), (2, prose(77, 50)), (3, None)])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontamination.without_passages(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
