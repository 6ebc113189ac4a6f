"""Run registered queries on Spark and their reference SQL on DuckDB, and compare the rows.

    python -m harness.compare /root/testdata/sf0.01 [query ...]
"""

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from harness.oracle import oracle_sql
from harness.queries import ORDERED, queries
from shoplake.sources.session import create_spark


def _key(row: tuple) -> tuple:
    return tuple((value is not None, str(value)) for value in row)


def _rows(columns: list[str], rows: list[tuple], ordered: bool) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    found = [tuple(row[i] for i in order) for row in rows]
    return found if ordered else sorted(found, key=_key)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{sf_dir}/{file}'")
    return con


def _plain(type_name: str) -> str:
    names = {
        "string": "VARCHAR",
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "date": "DATE",
        "boolean": "BOOLEAN",
    }
    return names.get(type_name, type_name)


def difference(
    spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str
) -> str | None:
    """What differs, or nothing."""
    df = queries()[name](spark, sf_dir)
    result = con.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    ordered = name in ORDERED
    theirs = _rows(columns, result.fetchall(), ordered)
    ours = _rows(df.columns, [tuple(row) for row in df.collect()], ordered)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    their_types = dict(zip(columns, [str(d[1]) for d in result.description]))
    our_types = {f.name: _plain(f.dataType.simpleString()) for f in df.schema}
    odd = [(c, our_types[c], their_types[c]) for c in columns if our_types[c] != their_types[c]]
    if ours == theirs:
        return f"types {odd}" if odd else None
    pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(ours)} / {len(theirs)} rows, {len(pairs)} differ, first {pairs[:1]}; {odd}"


def main(sf_dir: str, names: list[str]) -> int:
    spark = create_spark(
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names or queries():
        started = time.time()
        try:
            found = difference(spark, con, sf_dir, name)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{time.time() - started:6.1f}s {name}: {found or 'ok'}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
