"""Driver contract: every query with a SQL text equals DuckDB at sf0.01
(row count, column names, multiset of rows); the others produce rows."""

import pytest

from conftest import SF001, SF01
from oracle_compare import compare, duck

import __spark_entry__ as E

ORACLE = E.oracle_sql()
QUERIES = E.queries()
ML_KEYS = {"train_lr", "train_rf", "train_gbt", "train_svm", "feature_importance",
           "model_leaderboard", "scored_motors", "scored_fact"}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_sql_or_is_rows_only():
    # the training-data queries that SQL cannot express have tests of their own
    missing = {q for q in set(QUERIES) - set(ORACLE) if not q.startswith("op") and q != "pipeline"}
    assert missing <= ML_KEYS | {"stream_scores"}, missing
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF01, con)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "LABEL" in df.columns and "SERIAL_NUMBER" in df.columns


def test_rows_only_lineage(spark):
    df = QUERIES["bronze_lineage"](spark, SF001)
    assert df.count() == 1000
    assert df.where("SERIAL_NUMBER IS NULL").count() == 0
