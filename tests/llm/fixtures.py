"""Small tables that hold what real ones do: nulls, empty and long texts, repeats, odd columns."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


def documents(spark, rows, extra: bool = True):
    """(doc_id, text) and, as extra columns, names that operators might use inside."""
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    names = "id sum key kept n whole part node u v window at hit_id lang_pred score".split()
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], schema)


def rows_of(df, *columns):
    got = df.select(*columns).collect() if columns else df.collect()
    return sorted([tuple(r) for r in got], key=lambda r: [(x is None, str(x)) for x in r])
