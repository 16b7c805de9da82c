"""Run a registered query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import time

import duckdb

from threadline.plans.inputs import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, sf_dir, fn, sql, con=None):
    """None when equal, else a short description; also returns rows and seconds."""
    start = time.time()
    df = fn(spark, sf_dir)
    arrow = df.toArrow()
    seconds = time.time() - start
    got = _rows(arrow.column_names, list(zip(*[c.to_pylist() for c in arrow.columns])) if arrow.num_rows else [])
    if sql is None:
        return None, len(got), seconds
    expected = (con or connect(sf_dir)).sql(sql).to_arrow_table()
    want = _rows(expected.column_names, list(zip(*[c.to_pylist() for c in expected.columns])) if expected.num_rows else [])
    if sorted(arrow.column_names) != sorted(expected.column_names):
        return f"columns {sorted(arrow.column_names)} against {sorted(expected.column_names)}", len(got), seconds
    types = {
        n: (str(arrow.schema.field(n).type), str(expected.schema.field(n).type))
        for n in arrow.column_names
        if _family(arrow.schema.field(n).type) != _family(expected.schema.field(n).type)
    }
    if types:
        return f"types {types}", len(got), seconds
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3] if len(got) < 300000 else []
        only_want = [r for r in want if r not in set(got)][:3] if len(want) < 300000 else []
        return f"{len(got)} rows against {len(want)}; spark only {only_got}; sql only {only_want}", len(got), seconds
    return None, len(got), seconds


def _family(kind) -> str:
    text = str(kind)
    return text.replace("large_", "").split("(")[0].replace("timestamp[us, tz=UTC]", "timestamp[us]").replace("element", "item").replace(" not null", "").replace("list<l:", "list<item:")
