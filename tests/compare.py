"""Runs queries and their SQL oracles side by side. Also a command:

    python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import datetime
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _kind(value) -> str:
    if isinstance(value, datetime.datetime):
        return "timestamp"
    return type(value).__name__


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((_kind(r[i]), r[i]) for i in order) for r in rows)


SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def types_of(db: duckdb.DuckDBPyConnection, sql: str) -> dict[str, str]:
    described = db.execute(f"DESCRIBE {sql}").fetchall()
    return {r[0]: SPARK_TYPES.get(r[1], r[1].lower()) for r in described}


def difference(df, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns, types, values and row counts."""
    sql_types = types_of(db, sql)
    found = db.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    if types != sql_types:
        return f"types {sorted(set(types.items()) ^ set(sql_types.items()))}"
    want = rows_of(names, found.fetchall())
    have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want == have:
        return None
    extra, missing = have - want, want - have
    return (
        f"{sum(have.values())} rows against {sum(want.values())}; "
        f"only in Spark {list(extra.items())[:2]}; only in SQL {list(missing.items())[:2]}"
    )


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as driver

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, oracles = connect(sf_dir), driver.oracle_sql()
    failed = 0
    for name, build in driver.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = (
                difference(build(spark, sf_dir), db, oracles[name])
                if name in oracles
                else f"no SQL, {build(spark, sf_dir).count()} rows"
            )
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {problem or 'same'}", flush=True)
    print(f"{failed} differ")


if __name__ == "__main__":
    main()
