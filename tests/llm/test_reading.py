import numpy as np

from taxaloom.llm import reading as R

EASY, HARD = ["The cat sat on the mat. It was big.", "I see a dog. It runs fast.", "The sun is hot. We play."], [
    "Phylogenetic reconstruction of mitochondrial lineages, notwithstanding heterogeneous substitution rates, remains controversial.",
    "Multivariate ordination of cranial measurements yielded overlapping clusters, precluding unequivocal taxonomic delimitation.",
    "Demographic projections presuppose density-dependent recruitment, contradicting prevailing hypotheses.",
]


def graded(n=60):
    rng = np.random.default_rng(0)
    texts, levels = [], []
    for i in range(n):
        pool = (EASY, HARD)[i % 2]
        texts.append(" ".join(rng.choice(pool, 4)))
        levels.append((1, 4)[i % 2])
    return texts, levels


def test_held_out_order_and_levels():
    t, y = graded(90)
    m = R.fit(t[:60], y[:60])
    got = [round(m.expected(m.score(x))) for x in t[60:]]
    assert got == y[60:]


def test_isotonic_as_by_definition():
    s, y = np.array([1.0, 2, 3, 4, 5]), np.array([1, 3, 2, 2, 5])
    at, fit = R.isotonic(s, y)
    assert list(np.round(fit, 4)) == [1, round(7 / 3, 4), 5] and list(at) == [1.5, 4.5]


def test_greater_part_decides():
    t, y = graded()
    m = R.fit(t, y)
    mostly_hard = " ".join([*HARD, HARD[0], EASY[0]])
    assert round(m.expected(m.score(mostly_hard))) == 4
    assert m.score("") == float("-inf") and round(m.expected(m.score(""))) == 1


def test_over_spark(spark):
    t, y = graded()
    docs = spark.createDataFrame([(i, x, "c") for i, x in enumerate(t)] + [(900, None, "c"), (901, "", "c"), (902, (HARD[0] + " ") * 3000, "c")], "doc_id bigint, text string, reading_level string")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)] + [(900, 2), (777, 3), (5, None)], "doc_id bigint, reading_level bigint")
    m = R.fit_on(docs, labels)
    got = {r.doc_id: r.reading_level for r in R.with_level(docs.select("doc_id", "text"), m).collect()}
    assert got[900] is None and got[901] == 1 and got[902] == 4 and sum(got[i] == v for i, v in enumerate(y)) >= 58
    none = R.fit_on(docs, labels.where("false"))
    assert none is None and R.with_level(docs.drop("reading_level"), none).where("reading_level is not null").count() == 0
    one = R.fit_on(docs, labels.where("reading_level = 4"))
    assert {r.reading_level for r in R.with_level(docs.where("doc_id < 5").drop("reading_level"), one).collect()} == {4}


def test_same_model_each_time(spark):
    t, y = graded()
    assert np.array_equal(R.fit(t, y).w, R.fit(t, y).w)
