from pyspark.sql import functions as F

from taxaloom.llm import quality
from taxaloom.llm.train_quality import annotate

PROSE = "The owl lives in old trees and it hunts for mice at night. Its call is often heard from the edge of the forest."


def verdicts(spark, texts):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.verdict for r in quality.assess(d).orderBy("i").collect()]


def test_prose_and_not(spark):
    bad = [
        "| Size | Weight |\n|---|---|\n" + "| 12 | 34 |\n" * 8,
        "\n".join(f"- in reed beds {i}" for i in range(12)),
        "Home > Search > Map > Login > Help > Share > Contact > Home > Map > Help > Print © 2019",
        "aGVsbG8gd29ybGQ" * 20,
        "= " * 120,
    ]
    good = [PROSE, PROSE.replace(". ", ".\n"), "- " + PROSE.replace(". ", ".\n- "), "owl of the northern woods", PROSE[:60]]
    assert "prose" not in verdicts(spark, bad)
    assert set(verdicts(spark, good)) == {"prose"}


def test_null_empty_and_very_long(spark):
    assert verdicts(spark, [None, "", " \n "]) == [None, "prose", "prose"]
    long = [PROSE + " ", "x\n", "word ", "|"]
    assert len(verdicts(spark, [t * 50_000 for t in long])) == 4
    assert verdicts(spark, []) == []


def test_statistics_by_hand(spark):
    d = spark.createDataFrame([("A cat, the dog.\nNo 12",)], "text string")
    r = quality.with_statistics(d).first()
    assert (r.word_count, r.line_count, r.longest_word) == (6, 2, 4) and r.punct_line_share == 0.5 and r.digit_ratio == round(2 / 21, 4)


def test_extra_columns_and_other_text_name(spark):
    d = spark.createDataFrame([(PROSE, 1, "z")], "body string, word_count int, verdict string")
    r = quality.assess(d, "body").first()
    assert r.verdict == "prose" and r.body == PROSE


def test_rules_as_sql_equal_rules_in_python(spark, sf):
    import numpy as np

    from taxaloom.llm.common import descriptions, load_model

    d = quality.assess(descriptions(spark.read.parquet(f"{sf}/species_records.parquet")).where("trim(text) <> ''")).toPandas()
    x = d[list(quality.FEATURES)].to_numpy(float)
    model = load_model("quality_rules.json")

    def apply(rules):
        out, free = np.full(len(x), rules[-1]["class"], dtype="U8"), np.ones(len(x), bool)
        for r in rules[:-1]:
            m = free & quality._covers(x, [(quality.FEATURES.index(f), op, v) for f, op, v in r["tests"]])
            out[m], free = r["class"], free & ~m
        return out

    want = np.where(apply(model["rules"]) == "prose", "prose", apply(model["kinds"]))
    assert (d["verdict"].to_numpy() == want).all() and (want != "prose").any()
    assert (np.array([annotate(t) != "prose" for t in d["text"]]) == (want != "prose")).mean() > 0.97


def test_induction_finds_a_planted_rule():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality.FEATURES)))
    y = np.where((x[:, 2] > 0.7) & (x[:, 5] <= 0.4), "bad", "prose")
    rules = quality.induce(x, y, "prose", ["bad"])
    got = np.full(len(x), "prose", dtype="U8")
    for r in rules[:-1]:
        got[quality._covers(x, [(quality.FEATURES.index(f), op, v) for f, op, v in r["tests"]])] = "bad"
    assert (got == y).mean() > 0.98


def test_all_in_the_jvm(spark):
    d = quality.flagged(quality.assess(spark.createDataFrame([("a",)], "text string")))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and F is not None
