"""Run a registered query in Spark and its SQL in DuckDB, and compare them."""

from __future__ import annotations

import glob
import os

import duckdb

import __spark_entry__ as entry

ORDERED_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def compare(spark, con, name: str, sf_dir: str) -> int:
    """Number of rows; raises AssertionError where the two results differ."""
    result = entry.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    rows = [tuple(r) for r in result.select(*[f"`{c}`" for c in columns]).collect()]
    cur = con.execute(entry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in cur.description}
    assert sorted(types) == columns, (sorted(types), columns)
    mine = {f.name: ORDERED_TYPES[f.dataType.simpleString()] for f in result.schema}
    assert mine == types, (mine, types)
    order = [[d[0] for d in cur.description].index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in cur.fetchall()]
    assert len(rows) == len(expected), (len(rows), len(expected))
    for got, want in zip(_sorted(rows), _sorted(expected)):
        assert got == want, (got, want)
    return len(rows)
