import random
import re
from collections import Counter

import pytest
from fixtures import documents, prose
from pyspark.sql import functions as F

from topiclens.llm import phrases


def brute(rows, least, longest, top):
    """As the contract says, with whole numbers of any size."""
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    key = (lang, tuple(w[i : i + k]))
                    counts[key] = counts.get(key, 0) + 1
    out = []
    for lang in n:
        mine = {p: f for (g, p), f in counts.items() if g == lang and f >= least}
        kept = []
        for p, a in mine.items():
            if len(p) < 2 or any(
                len(q) > len(p) and 100 * f >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, f in mine.items()
            ):
                continue
            score, _, l, r = min((1000 * a * n[lang] // (mine[p[:k]] * mine[p[k:]]), k, mine[p[:k]], mine[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def found(spark, rows, parts=3, **options):
    names = "doc_id phrase prefix next f part rank n score w k first rest longer following counts".split()
    schema = "lang string, text string, " + ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], schema).repartition(parts)
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def text(seed, n):
    r = random.Random(seed)
    return "".join(r.choice("abcdé") + r.choice(["", "", "x"]) + r.choice(" \t. , ;\n  \r") for _ in range(n))


ROWS = [
    (None, "New York is New York. New york, NEW YORK"), ("und", "new york \x0b new\x0cyork"), ("en", None), ("en", ""),
    ("en", " ., ;"), ("en", "same words again. " * 9), ("en", "same words again. " * 9), ("de", "K İst nicht k. É é"),
    ("en", "\x1c a\x1cb\xa0c a\x1cb\xa0c"), *[("en", text(i, 300)) for i in range(20)], *[("fr", text(99 + i, 200)) for i in range(9)],
]


@pytest.mark.parametrize("least,longest,top,parts", [(3, 5, 2000, 3), (8, 4, 5, 1), (2, 2, 7, 7), (4, 3, 2000, 2)])
def test_against_brute_force(spark, least, longest, top, parts):
    assert found(spark, ROWS, parts, least=least, longest=longest, top=top) == brute(ROWS, least, longest, top)


def test_small_chunks_and_parts(spark, monkeypatch):
    # A stripe in many parts, from many chunks, and a filter too small to be of use.
    monkeypatch.setattr(phrases, "CHUNK_WORDS", 50)
    monkeypatch.setattr(phrases, "SHARES", 300)
    monkeypatch.setattr(phrases, "ROW_WORDS", 2)
    monkeypatch.setattr(phrases, "BUNDLE_WORDS", 300)
    monkeypatch.setattr(phrases, "MOST_BITS", 1 << 10)
    assert found(spark, ROWS, least=3) == brute(ROWS, 3, 5, 2000)


def test_no_rows(spark):
    assert found(spark, []) == [] and found(spark, [("en", None), (None, "")]) == []


def test_one_long_text(spark):
    rows = [("en", prose(1, 60_000))]
    assert found(spark, rows, least=60) == brute(rows, 60, 5, 2000)


def test_large_products(spark):
    # 1000 a n passes 64 bits.
    counted = spark.createDataFrame(
        [("en", "", None, 4 * 10**12), ("en", "", "a", 10**12), ("en", "", "b", 3 * 10**12), ("en", "a", "b", 9 * 10**11)],
        "lang string, prefix string, next string, f long",
    )
    (row,) = phrases._scored(counted, 100).collect()
    assert row.score == 1000 * 9 * 10**11 * 4 * 10**12 // (10**12 * 3 * 10**12)


def test_nothing_is_left_in_the_folder(spark):
    import os

    from topiclens.llm.common import shared_folder

    phrases.collocations(documents(spark, [(1, "a b")]).withColumn("lang", F.lit("en"))).collect()
    folder = shared_folder(spark).removeprefix("file:")
    assert not [x for x in os.listdir(folder) if x.startswith("phrases-")]
