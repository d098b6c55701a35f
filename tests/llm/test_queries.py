"""Registered queries of this subpackage against their DuckDB SQL."""

import pandas as pd
import pytest
from oracle_compare import duck, frames_equal, types_differ

import __spark_entry__ as E
from pricelens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    df, con = QUERIES[name](spark, SF), duck(SF)
    assert types_differ(df, con, ORACLE[name]) == {}
    want = con.execute(ORACLE[name]).df()
    plain = lambda x: x.astype(object).where(pd.notna(x), None)
    ok, msg = frames_equal(plain(df.toPandas()), plain(want))
    assert ok, msg


def test_all_operators_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names
