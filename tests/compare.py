"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import os
import time
from pathlib import Path

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def duck_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, query, sql: str, sf_dir: str) -> dict:
    """Problems found (empty: equal), row count and seconds of both sides."""
    start = time.time()
    got = query(spark, sf_dir).toArrow()
    spark_seconds = time.time() - start
    start = time.time()
    want = con.sql(sql).to_arrow_table()
    duck_seconds = time.time() - start
    problems = []
    if sorted(got.column_names) != sorted(want.column_names):
        problems.append(f"columns {sorted(got.column_names)} against {sorted(want.column_names)}")
    if got.num_rows != want.num_rows:
        problems.append(f"{got.num_rows} rows against {want.num_rows}")
    if not problems:
        names = sorted(got.column_names)
        for name in names:
            a, b = str(got.schema.field(name).type), str(want.schema.field(name).type)
            if a != b and not {a, b} <= {"string", "large_string"}:
                problems.append(f"{name}: {a} against {b}")
        left = sorted(map(repr, zip(*[got.column(n).to_pylist() for n in names])))
        right = sorted(map(repr, zip(*[want.column(n).to_pylist() for n in names])))
        different = [(a, b) for a, b in zip(left, right) if a != b]
        if different:
            problems.append(f"{len(different)} rows differ, first {different[0]}")
    return {
        "problems": problems,
        "rows": got.num_rows,
        "spark": round(spark_seconds, 2),
        "duck": round(duck_seconds, 2),
    }
