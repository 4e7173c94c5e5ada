"""Run queries against their SQL: ``python -m checks.compare SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None if the query's rows equal its SQL's, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = Counter(tuple(row) for row in df.select(*columns).collect())
    if name not in ORACLE:
        return None if ours else "no rows"
    relation = con.sql(ORACLE[name])
    if sorted(relation.columns) != columns:
        return f"columns: {columns} != {sorted(relation.columns)}"
    theirs = Counter(relation.select(*[f'"{c}"' for c in columns]).fetchall())
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (
            f"{sum(ours.values())} != {sum(theirs.values())} rows; only ours "
            f"{sum(extra.values())} {extra.most_common(2)!r:.600}; only SQL "
            f"{sum(missing.values())} {missing.most_common(2)!r:.600}"
        )
    return None if ours else "equal, but no rows"


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = 0
    for name in names or list(QUERIES):
        began = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failures += problem is not None
        kind = "" if name in ORACLE else " (rows only)"
        print(f"{time.time() - began:6.1f}s {name}{kind}: {problem or 'ok'}", flush=True)
    print(f"{failures} of {len(names or QUERIES)} failed")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
