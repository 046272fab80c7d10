"""Every registered query against its SQL counterpart, and the plans it must not have."""

import os
import subprocess
import sys

import pytest

from compare import compare, duck
from tidemark.plans import catalog, oracle

SQL = oracle.statements()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.REGISTRY))
def test_matches_sql(spark, sf_dir, con, name):
    df = catalog.run(name, spark, sf_dir)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in SQL:
        assert df.count() >= 0
        return
    assert compare(df, con, SQL[name]) == []


def test_workers_find_the_package_from_another_folder(sf_dir, tmp_path):
    """Python workers import what the driver shipped, not what lies in its working directory."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "import __spark_entry__ as e\n"
        "from tidemark.session import build_session\n"
        "s = build_session(master='local[2]', **{'spark.sql.shuffle.partitions': '2', 'spark.checkpoint.dir': 'work'})\n"
        f"print('ROWS', e.queries()['price_anomalies'](s, {sf_dir!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in out.stdout, out.stderr[-2000:]


def test_only_the_forest_lacks_sql():
    assert set(catalog.REGISTRY) - set(SQL) == {"price_anomalies"}
    assert set(SQL) <= set(catalog.REGISTRY)


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.queries()) >= set(catalog.REGISTRY)
    assert contract.entry(spark).count() > 0
