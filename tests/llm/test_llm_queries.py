"""Named queries against their SQL, and the pipeline against brute force."""

import subprocess
import sys
from pathlib import Path

import pytest
from compare import duck, rows_of
from test_byte_pairs import PATH
from test_near_duplicates import brute as near_groups
from test_decontamination import brute as passages
from test_secrets import base

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from topiclens.llm.oracle import ORACLE
from topiclens.llm.queries import QUERIES

ROOT = Path(__file__).parents[2]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small, name):
    expected = duck(small).execute(ORACLE[name])
    names = [d[0] for d in expected.description]
    df = QUERIES[name](spark, small)
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, expected.fetchall())


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_pipeline_against_brute_force(spark, small):
    import public_tokenizers
    import tiktoken

    from topiclens.llm import byte_pairs

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    groups = near_groups(rows)
    rows = [(i, t) for i, t in rows if groups[i][2]]
    dirty = {r[0] for r in passages(rows, items) if r[5]}
    rows = [(i, t) for i, t in rows if i not in dirty]
    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_pairs.read_ranks(PATH), special_tokens={}
    )
    got = {r.doc_id: r.n_tokens for r in queries()["pipeline"](spark, small).collect()}
    assert set(got) == {i for i, _ in rows}
    # Here, documents without a certain secret have no weak one either.
    assert all(got[i] == len(known.encode_ordinary(t)) for i, t in rows if not base(t))
    assert any(base(t) and got[i] != len(known.encode_ordinary(t)) for i, t in rows) or not any(base(t) for _, t in rows)


def test_stages_keep_the_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), small)
        assert out.columns == docs.columns and out.count() == 0


def test_the_rest_does_not_need_this_part():
    code = (
        "import sys, importlib.abc\n"
        "class No(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name.startswith('topiclens.llm') or name == 'corpus_pipeline': raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, No())\n"
        "sys.path.insert(0, '.')\n"
        "import topiclens.catalog.queries, topiclens.catalog.oracle\n"
        "print(not any('llm' in m for m in sys.modules if m.startswith('topiclens')))\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.stdout.strip() == "True", done.stderr
