"""Every registered core query with a SQL twin gives the same rows in DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

from taxaloom.plans import registry

Q, O = registry.queries(), registry.oracle_sql()


def canonical(df):
    df = df[sorted(df.columns)]

    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "∅"
        if isinstance(v, float):
            return str(int(v)) if v == int(v) else f"{v:.6g}"
        return str(v)

    return list(df.columns), sorted(map(tuple, df.map(one).values.tolist()))


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    return c


def test_every_oracle_has_a_query():
    assert set(O) <= set(Q)


@pytest.mark.parametrize("name", sorted(O))
def test_same_rows(spark, sf, con, name):
    assert canonical(Q[name](spark, sf).toPandas()) == canonical(con.execute(O[name]).df())


@pytest.mark.parametrize("name", sorted(set(Q) - set(O)))
def test_runs(spark, sf, name):
    assert Q[name](spark, sf).count() >= 0
