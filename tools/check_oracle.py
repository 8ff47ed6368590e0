"""Run every registered query in Spark and its SQL in DuckDB and compare.

    python tools/check_oracle.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from texelframe.session import build_session
from workload.queries import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v).__name__) if v is None else "", f"{v:.6f}" if isinstance(v, float) else str(v)) for v in row)


def compare(spark_rows: list[dict], duck_rows: list[tuple], duck_names: list[str]) -> str | None:
    """None when equal, else what differs first."""
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} != {len(duck_rows)}"
    names = sorted(duck_names)
    order = [duck_names.index(n) for n in names]
    right = sorted((tuple(r[i] for i in order) for r in duck_rows), key=_key)
    if spark_rows and sorted(spark_rows[0]) != names:
        return f"columns {sorted(spark_rows[0])} != {names}"
    left = sorted((tuple(r[n] for n in names) for r in spark_rows), key=_key)
    for a, b in zip(left, right):
        for n, u, v in zip(names, a, b):
            same = u == v or (isinstance(u, float) and isinstance(v, float) and math.isnan(u) and math.isnan(v))
            if not same or (u is not None and type(u) is not type(v)):
                return f"{n}: {u!r} != {v!r} in {dict(zip(names, a))} / {dict(zip(names, b))}"
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-"), "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            rows = [r.asDict() for r in df.collect()]
            spent = time.time() - start
            if name not in ORACLES:
                verdict = "rows only"
            else:
                cur = con.execute(ORACLES[name])
                spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
                duck_types = {d[0]: str(d[1]) for d in cur.description}
                verdict = compare(rows, cur.fetchall(), list(duck_types)) or "ok"
                wide = [n for n in spark_types if {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}.get(spark_types[n]) != duck_types.get(n)]
                if wide and verdict == "ok":
                    verdict = "types differ: " + ", ".join(f"{n} {spark_types[n]}/{duck_types.get(n)}" for n in wide)
        except Exception as err:
            spent, verdict, rows = time.time() - start, "FAILED " + str(err)[:600], []
            if "-v" in os.environ.get("CHECK", ""):
                traceback.print_exc()
        bad += verdict not in ("ok", "rows only")
        print(f"{name:34s} {len(rows):8d} rows {spent:6.2f}s  {verdict}", flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
