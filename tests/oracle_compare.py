"""Compare a registered Spark query with its DuckDB oracle (same rules as the driver:
columns sorted by name, row count, order-insensitive values)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from pricelens.sources.fixtures import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits)
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def frames_equal(spark_pdf, duck_pdf, digits: int = 6):
    """Return (ok, message)."""
    sc, dc = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    if sc != dc:
        return False, f"columns differ: {sc} vs {dc}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"rows differ: {len(spark_pdf)} vs {len(duck_pdf)}"
    a = sorted(tuple(_norm(x, digits) for x in r) for r in spark_pdf[sc].itertuples(index=False))
    b = sorted(tuple(_norm(x, digits) for x in r) for r in duck_pdf[dc].itertuples(index=False))
    a = [tuple(None if (isinstance(x, float) and math.isnan(x)) else x for x in r) for r in a]
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return False, f"first difference at sorted row {i}: {x} vs {y}"
    return True, "ok"


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    s = fn(spark, sf_dir).toPandas()
    d = con.execute(sql).df()
    return frames_equal(s, d)


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
                  "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def types_differ(spark_df, con, sql):
    """Columns whose Spark type and DuckDB type disagree (empty dict when aligned)."""
    s = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in spark_df.schema.fields}
    d = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {k: (s.get(k), d.get(k)) for k in set(s) | set(d) if s.get(k) != d.get(k)}
