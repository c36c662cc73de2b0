"""Every registered query of the library beside its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from lexweave.plans import registry

DATA = os.environ.get("LEXWEAVE_TEST_DATA", "/root/testdata/sf0.001")


def rows(df: pd.DataFrame) -> list:
    def show(v):
        return "~" if v is None or pd.isna(v) else (f"{float(v):.6g}" if isinstance(v, float) else str(v))

    return sorted(tuple(show(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DATA).toPandas()
    if name not in registry.oracle_sql():
        assert len(got)
        return
    want = duck.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
