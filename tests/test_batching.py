import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taxaloom.functions import udf as U
from taxaloom.operators import batching as B
from taxaloom.operators import geometry as G


def sequential(items, fits):
    out, current, n = [], [], 0
    for x in items:
        if current and not fits([*current, x]):
            n, current = n + 1, []
        current.append(x)
        out.append(n)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 9), min_size=1, max_size=60), st.integers(1, 15), st.integers(1, 5), st.integers(1, 6))
def test_budget_batches_as_in_order(spark, sizes, budget, most, parts):
    fits = B.by_budget(budget, most)
    d = spark.createDataFrame([(i, "a" if i % 3 else "b", x) for i, x in enumerate(sizes)], "i bigint, g string, x bigint")
    got = {r.i: r.batch for r in B.greedy_batches(d, ["g"], "i", "x", fits, most, parts).collect()}
    for g in (0, 1):
        idx = [i for i in range(len(sizes)) if bool(i % 3) == bool(g)]
        assert [got[i] for i in idx] == sequential([sizes[i] for i in idx], fits)


def test_rendered_batches(spark):
    texts = ["One. " * k for k in (3, 50, 2, 2, 2, 200, 1)] + [None]

    def cut(t, most):
        t = t.strip()
        return t if len(t) <= most else t[: t[:most].rfind(". ") + 1]

    def fits(items):
        share = max(80, 480 // len(items) - 16)
        return len(items) <= 3 and len(U.encode_batch([cut(t, share) for t in items])) <= 480

    d = spark.createDataFrame(list(enumerate(texts)), "i bigint, t string")
    got = [r.batch for r in B.greedy_batches(d, [], "i", "t", B.Rendered(480, 3), 3, 3).orderBy("i").collect()]
    assert got == sequential([t or "" for t in texts], fits)
    assert B.greedy_batches(d.where("false"), [], "i", "t", B.Rendered(480, 3), 3).count() == 0


def test_boxes():
    boxes = np.array([[0, 0, 10, 10], [1, 1, 11, 11], [20, 20, 30, 30], [0, 0, 10, 10]], float)
    assert G.kept_boxes(boxes, np.array([0.5, 0.9, 0.4, 0.5])) == [1, 2]
    assert G.kept_boxes(np.zeros((0, 4)), np.zeros(0)) == []


def test_crops(spark):
    d = spark.createDataFrame([(300, 100, 250.0, 10.0, 290.0, 90.0), (100, 300, 10.0, 20.0, 90.0, 290.0), (150, 100, None, None, None, None), (300, 100, None, None, None, None)], "w int, h int, x1 double, y1 double, x2 double, y2 double")
    c = G.subject_crop(*[F.col(x) if isinstance(x, str) else x for x in ("w", "h", 1.5, "x1", "y1", "x2", "y2")])
    assert [tuple(r[0]) for r in d.select(c).collect()] == [(150, 0, 300, 100), (0, 20, 100, 86), (0, 0, 150, 100), (75, 0, 225, 100)]
    a = [tuple(r[0]) for r in d.limit(1).crossJoin(spark.range(1, 10)).orderBy("id").select(G.anchor_crop(F.col("w"), F.col("h"), 1.5, F.col("id"))).collect()]
    assert [x[0] for x in a] == [0, 75, 150] * 3
