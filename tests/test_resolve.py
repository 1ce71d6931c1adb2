import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taxaloom.operators import ordering, resolve

owner = st.one_of(st.none(), st.sampled_from("ABCDE"))


def sequential(rows):
    claimed, out = set(), {}
    for o, direct, named, linked in rows:
        if direct is not None:
            c, s = direct, "direct"
        elif named is not None and named not in claimed:
            c, s = named, "named"
        elif linked is not None:
            c, s = linked, "linked"
        else:
            c, s = None, None
        if c is not None:
            claimed.add(c)
        out[o] = (c, s)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.none(), owner), owner, owner), min_size=1, max_size=9))
def test_claims_as_in_order(spark, triples):
    rows = [(i, *t) for i, t in enumerate(triples)]
    d = spark.createDataFrame(rows, "ord bigint, direct string, named string, linked string")
    assert {r.ord: (r.claim, r.source) for r in resolve.resolve_claims(d).collect()} == sequential(rows)


def test_many_claims_and_long_chains(spark):
    rng = random.Random(3)
    names = [f"n{i}" for i in range(120)]
    pick = lambda share: rng.choice(names) if rng.random() < share else None
    rows = [(i, pick(0.1), pick(0.8), pick(0.8)) for i in range(400)]
    # Each of these is moved by the one before, so that it moves the next.
    rows += [(1000, "c0", None, None)] + [(1001 + i, None, f"c{i}", f"c{i + 1}") for i in range(300)]
    d = spark.createDataFrame(rows, "ord bigint, direct string, named string, linked string")
    assert {r.ord: (r.claim, r.source) for r in resolve.resolve_claims(d).collect()} == sequential(rows)


def test_later_match_is_suppressed(spark):
    rows = spark.createDataFrame([(1, "X a", "owl"), (2, "Y b", "Owl"), (3, "Z c", None)], "ord bigint, name string, english string")
    checklist = spark.createDataFrame([(1, "P p", "OWL", "c1"), (2, "Z c", "Wren", "c2")], "ord bigint, name string, english string, code string")
    links = spark.createDataFrame([("Y b", "c2")], "name string, code string")
    got = {r.ord: (r.claim, r.source) for r in resolve.match_cascade(rows, checklist, links).collect()}
    assert got == {1: ("P p", "named"), 2: ("Z c", "linked"), 3: ("Z c", "direct")}


def test_fallbacks_and_titles(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    one, two = spark.createDataFrame([("a", "1")], "k string, v string"), spark.createDataFrame([("a", "9"), ("b", "2")], "k string, v string")
    got = {r.k: (r.v, r.matched_by) for r in resolve.fallback_lookup(rows, "k", [("one", one), ("two", two)], "v").collect()}
    assert got == {"a": ("1", "one"), "b": ("2", "two"), "c": (None, None)}
    t = spark.createDataFrame([("a_b",), ("q",)], "title string")
    n, r = spark.createDataFrame([("a_b", "a b")], "`from` string, `to` string"), spark.createDataFrame([("a b", "C")], "`from` string, `to` string")
    p = spark.createDataFrame([("C", 7)], "title string, page_id int")
    assert {x.title: x.page_id for x in resolve.follow_titles(t, n, r, p).collect()} == {"a_b": 7, "q": None}


def test_unknown_keys_raise(spark):
    import pytest

    k, known = spark.createDataFrame([("x",), ("y",)], "k string"), spark.createDataFrame([("x",)], "k string")
    with pytest.raises(ValueError, match="y"):
        resolve.require_known(k, known, "k")


def test_ids_continue_and_are_stable(spark):
    rows = spark.createDataFrame([("n3", 3), ("n1", 1), ("n2", 2), ("n1", 9)], "name string, ord bigint")
    known = spark.createDataFrame([("n2", 41), ("gone", 50)], "name string, number bigint")
    assert {r.name: r.number for r in ordering.assign_ids(rows, known, "name", "ord").collect()} == {"n2": 41, "n1": 51, "n3": 52}
    assert {r.name: r.number for r in ordering.reassign_ids(rows, "name").collect()} == {"n1": 1, "n2": 2, "n3": 3}


def test_global_rank_is_not_one_task(spark):
    d = ordering.global_rank(spark.range(1000).select((F.col("id") * 7 % 1000).alias("x")), [F.col("x")], parts=8)
    assert d.where("rank <> x + 1").count() == 0
