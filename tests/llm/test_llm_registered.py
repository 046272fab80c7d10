"""Registered queries against DuckDB, and the pipeline against single stages by brute force."""

import pytest

from compare import compare, duck
from tidemark.llm import oracles, queries

NO_SQL = {"op1_quality_classifier", "op5_language_id", "op6_suffix_tree_score", "op10_pack"}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_matches_sql(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name in NO_SQL:
        assert df.count() > 0
        return
    assert compare(df, duck(sf_dir), oracles.STATEMENTS[name]) == []


def test_only_models_lack_sql():
    assert set(queries.QUERIES) - set(oracles.STATEMENTS) == NO_SQL


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == [*range(1, 14)]
