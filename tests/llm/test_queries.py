import os

import duckdb
import pytest

from taxaloom.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_runs(spark, sf, name):
    assert Q.QUERIES[name](spark, sf).count() >= 0


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_same_rows(spark, sf, name):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    got = Q.QUERIES[name](spark, sf).toPandas()
    want = con.execute(Q.ORACLE[name]).df()[list(got.columns)]
    canon = lambda d: sorted(map(tuple, d.astype(object).where(d.notna(), None).values.tolist()), key=str)
    assert canon(got) == canon(want)
