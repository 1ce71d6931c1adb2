import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaloom.llm import mixing as M


def test_raking_meets_marginals():
    rng = np.random.default_rng(0)
    tokens = rng.integers(50, 100, 60).astype(float)
    s, la = np.repeat(np.arange(3), 20), np.tile(np.arange(4), 15)
    total = tokens.sum()
    want_s, want_l = total * np.array([0.5, 0.3, 0.2]), total * np.array([0.4, 0.3, 0.2, 0.1])
    use = M.rake(tokens, [s, la], [want_s, want_l], np.full(60, 9.0))
    assert np.allclose(np.bincount(s, tokens * use), want_s) and np.allclose(np.bincount(la, tokens * use), want_l, rtol=1e-3)
    capped = M.rake(tokens, [s, la], [want_s, want_l], np.full(60, 1.6))
    assert capped.max() <= 1.6 + 1e-9 and np.allclose(np.bincount(s, tokens * capped), want_s, rtol=1e-6)


def docs(spark, n=4000):
    rows = []
    for i in range(n):
        source = "big" if i % 3 else ("Small One", " small_one", "SMALL ONE")[i % 9 // 3] if i % 2 else "mid"
        rows.append((i, "the song and the call " * (1 + i % 7), ("en", "de", None)[i % 3 - 1], source))
    rows += [(n, None, "en", "big"), (n + 1, "", "en", "big"), (n + 2, "x", "en", None), (n + 3, "other", "en", "unused")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")


def test_mix(spark):
    t = spark.createDataFrame([("m", "big", 0.4, 1), ("m", "small_one", 0.4, 4), ("m", "mid", 0.1, 2), ("m", "absent", 0.1, 3), ("n", "absent", 1.0, 1)], "mix_name string, source string, target_share double, max_repeats int")
    p = M.prepare(docs(spark))
    mixed = M.mix(p, t)
    r = {x.source: x for x in M.shares(mixed, t).where("mix_name = 'm'").collect()}
    for s, share in (("big", 0.4 / 0.9), ("small_one", 0.4 / 0.9), ("mid", 0.1 / 0.9)):
        assert abs(r[s].actual_share - share) < 0.02 and r[s].most_repeats <= r[s].max_repeats
    assert r["absent"].actual_share == 0 and r["absent"].documents == 0
    assert mixed.groupBy("mix_name", "doc_id").count().where("count > 1").count() == 0
    assert mixed.where("doc_id >= 4000").count() == 0
    assert sorted(mixed.collect()) == sorted(M.mix(p, t).collect())


def test_empty(spark):
    t = spark.createDataFrame([("m", "big", 0.4, 1)], "mix_name string, source string, target_share double, max_repeats int")
    e = M.prepare(docs(spark).where("false"))
    assert M.mix(e, t).count() == 0 and M.shares(M.mix(e, t), t).first().actual_share == 0
    assert M.mix(M.prepare(docs(spark, 50)), t.where("false")).count() == 0


def test_tokens_as_by_the_tokenizer(spark):
    from tokenizers import Tokenizer

    texts = ["Hello world", "", None, "ä" * 5000, "<|endoftext|>"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [r.tokens for r in M.with_tokens(d).orderBy("i").collect()]
    k = Tokenizer.from_file(M.TOKENIZER.replace(".tiktoken", ".json"))
    k.encode_special_tokens = True
    assert got == [len(k.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_bounds(spark, monkeypatch):
    monkeypatch.setattr(M, "MOST_CELLS", 1)
    t = spark.createDataFrame([("m", "big", 0.4, 1), ("m", "mid", 0.4, 1)], "mix_name string, source string, target_share double, max_repeats int")
    with pytest.raises(ValueError):
        M.mix(M.prepare(docs(spark, 20)), t)


def test_size_asked_for_and_marginals(spark):
    t = spark.createDataFrame([("m", "big", 0.5, 1), ("m", "mid", 0.5, 2)], "mix_name string, source string, target_share double, max_repeats int")
    p = M.prepare(docs(spark).withColumn("t", F.when(F.col("doc_id") % 5 == 0, "a").otherwise("b")), topic="t")
    p.cache()
    small = M.mix(p, t, size=4000.0)
    r = {x.source: x for x in M.shares(small, t).collect()}
    assert abs(r["big"].tokens - 2000) < 60 and abs(r["mid"].tokens - 2000) < 60
    # A size beyond what a source has gives all of it, as often as is allowed.
    have = p.where("skey = 'mid'").agg({"tokens": "sum"}).first()[0]
    r = {x.source: x for x in M.shares(M.mix(p, t, size=5.0 * have), t).collect()}
    assert r["mid"].tokens == 2 * have and r["mid"].most_repeats == 2
    m = {(x.axis, x.category): x for x in M.marginals(M.mix(p, t), p, t).collect()}
    assert set(m) == {("lang", "en"), ("lang", "de"), ("lang", "und"), ("topic", "a"), ("topic", "b")}
    assert all(abs(x.wanted_share - x.actual_share) < 0.02 for (axis, _), x in m.items() if axis == "topic")
    p.unpersist()


def test_kept(spark):
    t = spark.createDataFrame([("m", "big", 0.5, 1), ("m", "mid", 0.4, 2), ("m", "absent", 0.1, 2)], "mix_name string, source string, target_share double, max_repeats int")
    mixed = M.mix(M.prepare(docs(spark, 600)), t)
    assert tuple(M.kept(mixed, M.shares(mixed, t)).first()) == ("m", True, True, True)
    often = mixed.withColumn("repeats", F.col("repeats") * 9)
    assert M.kept(often, M.shares(often, t)).first().repeats_kept is False
    twice = mixed.unionByName(mixed.where("skey = 'mid'"))
    r = M.kept(twice, M.shares(twice, t)).first()
    assert (r.each_once, r.shares_met) == (False, False)


def test_rare_categories_are_taken_together(spark, monkeypatch):
    monkeypatch.setattr(M, "MOST_CELLS", 8)
    t = spark.createDataFrame([("m", "big", 0.5, 1), ("m", "mid", 0.5, 1)], "mix_name string, source string, target_share double, max_repeats int")
    d = docs(spark, 400).withColumn("t", F.concat(F.lit("t"), (F.col("doc_id") % 20).cast("string")))
    got = M.mix(M.prepare(d, topic="t"), t)
    assert got.select("skey", "lang", "topic").distinct().count() <= 8 and got.where("topic = 'other'").count() > 0
    assert {x.source: round(x.actual_share, 1) for x in M.shares(got, t).collect()} == {"big": 0.5, "mid": 0.5}


def test_many_cells_stay_apart(spark):
    t = spark.createDataFrame([("m", "a", 0.6, 2), ("m", "b", 0.4, 1)], "mix_name string, source string, target_share double, max_repeats int")
    p = spark.range(210_000).selectExpr("id as doc_id", "if(id % 2 = 0, 'a', 'b') as skey", "'en' as lang", "concat('t', id) as topic", "20 + id % 7 as tokens")
    got = M.mix(p, t)
    assert got.where("topic != concat('t', doc_id)").count() == 0 and got.count() > 100_000
    assert all(abs(x.actual_share - x.target_share) < 1e-3 for x in M.shares(got, t).collect())


def test_sampling_runs_on_through_a_large_source(spark):
    t = spark.createDataFrame([("m", "a", 0.5, 1), ("m", "b", 0.5, 3)], "mix_name string, source string, target_share double, max_repeats int")
    p = spark.range(63_000).selectExpr("id as doc_id", "if(id % 3 > 0, 'a', 'b') as skey", "if(id % 5 = 0, 'de', 'en') as lang", "concat('t', id % 7) as topic", "100 + id as tokens")
    got = M.mix(p, t)
    d = p.join(got.select("doc_id", "repeats"), "doc_id", "left").fillna(0, "repeats").toPandas().sort_values(["skey", "lang", "topic", "tokens"])
    # Within a cell of equal uses, any two runs of as many documents in order are used as often, but for one.
    for _, c in d.groupby(["skey", "lang", "topic"]):
        total = c["repeats"].cumsum().to_numpy()
        for k in (10, 100, 1000):
            runs = total[k:] - total[:-k]
            assert len(runs) == 0 or runs.max() - runs.min() <= 1


def test_same_results_by_any_plan(spark, monkeypatch):
    t = spark.createDataFrame([("m", "big", 0.5, 1), ("m", "mid", 0.3, 2), ("n", "mid", 1.0, 3)], "mix_name string, source string, target_share double, max_repeats int")
    p = M.prepare(docs(spark, 900).withColumn("t", F.concat(F.lit("t"), (F.col("doc_id") % 20).cast("string"))), topic="t")
    p.cache()
    whole = sorted(M.mix(p, t, size=9000.0).collect())
    monkeypatch.setattr(M, "BLOCK", 7)
    monkeypatch.setattr(M, "BROADCAST_CELLS", 0)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    try:
        assert sorted(M.mix(p.repartition(5), t, size=9000.0).collect()) == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        p.unpersist()
