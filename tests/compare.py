"""Comparison of a Spark result with a DuckDB result: names, types and values."""

import math
from pathlib import Path

import duckdb

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def spark_result(df):
    names = sorted(df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = sorted([tuple(_plain(row[n]) for n in names) for row in df.collect()])
    return [(n, types[n]) for n in names], rows


def duckdb_result(con, sql):
    result = con.execute(sql)
    columns = [(d[0], TYPES.get(str(d[1]), str(d[1]))) for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i][0])
    rows = sorted([tuple(_plain(row[i]) for i in order) for row in result.fetchall()])
    return [columns[i] for i in order], rows
