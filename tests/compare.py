"""Run registered queries against their SQL counterparts: python tests/compare.py [sf_dir] [names...]."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def compare(df, con, sql):
    """List of differences, empty when both sides agree exactly."""
    rel = con.sql(sql)
    problems = []
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return [f"columns {sorted(set(df.columns) ^ set(rel.columns))}"]
    kinds = dict(df.dtypes)
    for n, t in zip(rel.columns, rel.types):
        if TYPES.get(str(t), str(t)) != kinds[n]:
            problems.append(f"type {n}: {kinds[n]} vs {t}")
    ours = sorted((tuple(canon(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=sort_key)
    cols = ", ".join(f'"{n}"' for n in names)
    theirs = sorted((tuple(canon(v) for v in r) for r in con.sql(f"SELECT {cols} FROM ({sql}) q").fetchall()), key=sort_key)
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} vs {len(theirs)}")
    diff = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if diff:
        a, b = diff[0]
        where = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        problems.append(f"{len(diff)} differing rows, e.g. {where[:4]}")
    return problems


def main():
    from tidemark.plans import catalog, oracle
    from tidemark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "compare",
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(sf_dir), oracle.statements()
    for name in sys.argv[2:] or catalog.REGISTRY:
        started = time.time()
        if name not in sqls:
            print(f"----  {name}: no SQL")
            continue
        try:
            problems = compare(catalog.run(name, spark, sf_dir), con, sqls[name])
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:500]}"]
        print(f"{'ok  ' if not problems else 'FAIL'}  {name} {time.time() - started:.1f}s {problems or ''}", flush=True)


if __name__ == "__main__":
    main()
