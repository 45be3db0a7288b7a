"""Every registered query against its independent DuckDB SQL (sf0.001 here;
``python tests/check_oracle.py`` runs the same at sf0.01)."""

import pytest
from cases import SF_SMALL
from oracle_harness import compare, duck

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_date", "question_id", "title", "score", "answer_count"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 50


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    if name not in ORACLE:
        df.count()
        return
    ok, msg = compare(df, con, ORACLE[name])
    assert ok, msg
