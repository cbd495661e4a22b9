import math
import random

import pytest
from fixtures import rows_of
from pyspark.sql import functions as F

from topiclens.llm import top_matches


def brute(rows, k, asked):
    q = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q.setdefault(i, []).append([math.floor(1024 * x) for x in v])
    out = []
    for i in q:
        if not asked(i):
            continue
        own = min(q[i])
        found = sorted(
            (-sum(a * b for a, b in zip(own, v)), j) for j in q if j != i for v in q[j] if len(v) == len(own)
        )
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out, key=lambda r: [(False, str(x)) for x in r])


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, id int, v string")


def vectors(n, size, seed=1):
    r = random.Random(seed)
    return [(i, [r.gauss(0, 1) for _ in range(size)]) for i in range(n)]


def got(spark, rows, k=10):
    return rows_of(top_matches.top_matches(table(spark, rows), F.col("vec_id") % 20 == 0, k))


ROWS = {
    "random": vectors(400, 64),
    "odd size": vectors(120, 7),
    "ties": [(i, [float(i % 3), 1.0]) for i in range(200)],
    "one common vector": vectors(100, 8) + [(1000 + i, [0.5] * 8) for i in range(300)],
    "few": vectors(5, 3),
    "alone": [(0, [1.0, 2.0])],
    "odd values": vectors(60, 4) + [(100, None), (120, [None, 1.0, 1.0, 1.0]), (140, [math.nan] * 4),
                                    (160, [math.inf, 0.0, 0.0, 0.0]), (180, []), (200, [1.0] * 5), (220, [1.0] * 4),
                                    (None, [1.0] * 4), (240, [0.0] * 4), (260, [-0.0001] * 4), (280, [1e6] * 4)],
    "repeated": vectors(50, 4) + vectors(50, 4) + [(20, [9.0] * 4)],
    "empty": [],
}


@pytest.mark.parametrize("name", ROWS)
def test_against_brute_force(spark, name):
    assert got(spark, ROWS[name]) == brute(ROWS[name], 10, lambda i: i % 20 == 0)


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(top_matches, "BLOCK_VALUES", 200)
    monkeypatch.setattr(top_matches, "FIRST_PASS", 20)
    monkeypatch.setattr(top_matches, "PAIRS", 50)
    assert got(spark, ROWS["random"], 3) == brute(ROWS["random"], 3, lambda i: i % 20 == 0)


def test_large_products_are_exact(spark):
    rows = [(i, [float(2**20 + i), float(2**19 - 3 * i), 0.25]) for i in range(60)]
    assert got(spark, rows) == brute(rows, 10, lambda i: i % 20 == 0)
