"""Every named query against its SQL on the small tables."""

import pytest
from compare import differences, duck

from __spark_entry__ import entry
from topiclens.catalog.oracle import ORACLE
from topiclens.catalog.queries import QUERIES

MODELS = {
    "topics_kmeans", "text_to_topic", "stemmed_topics", "classify_new", "model_roundtrip", "k_sweep",
    "topics_lda", "synonyms",
}


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_all_but_fitted_models_have_sql():
    assert set(QUERIES) - set(ORACLE) == MODELS
    assert not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small, con, name):
    assert differences(QUERIES[name](spark, small), con, ORACLE[name]) is None


def test_entry(spark, small):
    rows = entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {
        "topic", "sessions", "revenue", "views", "revenue_per_session",
    }
