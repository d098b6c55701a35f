"""Every registered query against its DuckDB oracle at sf0.01 (the driver's check)."""

import pytest

import __spark_entry__ as E
from paths import SF001, SF0001
from oracle_compare import duck, frames_equal, types_differ

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    assert types_differ(sdf, con, ORACLE[name]) == {}
    got = sdf.toPandas()
    want = con.execute(ORACLE[name]).df()
    ok, msg = frames_equal(got, want)
    assert ok, msg


def test_every_query_runs_on_smoke_data(spark):
    for name, fn in E.queries().items():
        if name not in ORACLE:
            continue
        assert fn(spark, SF0001).count() >= 0, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and set(df.columns) >= {"split_name", "count", "median"}


def test_registry_contract():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert all(callable(f) for f in q.values())
    assert all(n.isidentifier() and n == n.lower() for n in q)
