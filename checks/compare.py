"""Run queries in Spark and DuckDB and compare them: python -m checks.compare [SF_DIR] [NAME...]."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    if hasattr(value, "quantize"):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# Spark type -> DuckDB type of the columns that are compared.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """None when both sides hold the same rows, else a short description."""
    df = QUERIES[name](spark, sf_dir)
    got = _bag(df.columns, df.collect())
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    want = _bag(names, cursor.fetchall())
    got_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    want_types = {r[0]: r[1] for r in con.execute(f"describe {ORACLE[name]}").fetchall()}
    if got_types != want_types:
        return f"columns {set(got_types.items()) ^ set(want_types.items())}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"only Spark {list(extra)[:2]}; only SQL {list(missing)[:2]}"
        )
    return None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    from smelter.session import get_session

    spark = get_session(
        "compare",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, name)
        except Exception as error:
            problem = f"error {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28} {time.time() - start:6.2f}s {problem or 'equal'}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
