"""All registered queries and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib

_MODULES = ["ingest", "study", "geofeat", "prep", "models", "curveplan", "storage", "extra",
            "gaps"]


def _load():
    queries, oracle = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(f"{__package__}.{m}")
        queries.update(mod.QUERIES)
        oracle.update(mod.ORACLE)
    return queries, oracle


def queries():
    return _load()[0]


def _bigint_count_if(sql: str) -> str:
    """DuckDB's count_if is HUGEINT; Spark's is BIGINT. Wrap every call in a cast."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


def _half_up_round6(sql: str) -> str:
    """Spark rounds a double half-up on its printed decimal form, DuckDB on the binary
    value; rewrite every ``round(x, 6)`` so DuckDB rounds the printed form too."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(key):k - 1]
        head, sep, digits = inner.rpartition(",")
        if not sep or digits.strip() != "6" or head.lstrip().startswith("CAST(CAST("):
            out.append(sql[i:k])
        else:
            arg = _half_up_round6(head)
            out.append(sql[i:j] + f"CAST(round(CAST(CAST({arg} AS VARCHAR) AS DECIMAL(38,18)), 6)"
                       " AS DOUBLE)")
        i = k


def oracle_sql():
    return {k: _half_up_round6(_bigint_count_if(v)) for k, v in _load()[1].items()}
