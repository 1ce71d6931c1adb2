import pytest

from taxaloom.operators import catalog as C
from taxaloom.operators import merge, quality
from taxaloom.plans.common import records

SCHEMA = "ord bigint, scientific_name string, common_name string, common_name_alt string, taxon_group string, common_names map<string,string>, descriptions map<string,string>, scientific_name_aliases array<string>, birdnet_id string, ebird_code string, xc_name string, inat_id bigint, observations_count bigint, image_url string, description_source string, record_type string, wikipedia_urls map<string,string>"


def rec(o, sci, com, alt=None, group="Aves", names=None, desc=None, al=None, bn=None, eb=None, xc=None, inat=None, obs=0, img=None, src=None, kind="species"):
    return (o, sci, com, alt, group, names, desc, al, bn, eb, xc, inat, obs, img, src, kind, None)


@pytest.fixture(scope="module")
def birds(spark):
    rows = [
        rec(1, "Parus major", "Great Tit", names={"de": "Kohlmeise"}, obs=2_000_000, eb="gretit1", inat=5, bn="BN00001", img="u", desc={"en": "w " * 90}, al=["Parus robustus"], src="wikipedia"),
        rec(2, "Turdus merula", "Blackbird", "Common Blackbird", al=["Great merula"], obs=None, inat=6),
        rec(3, "Rana bona", "Great Tit Frog", group="Amphibia", obs=10, xc="Rana altera"),
        rec(4, "Greatus titus", "Big Great Owl", obs=0, eb="PARUS"),
        rec(5, "Human", "Human", group=None, kind="sound_class", obs=1),
        rec(6, "Pica pica", "Élan Tit", obs=3, names={"fr": "great tit"}),
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


def found(d, q, **k):
    return {r.ord: int(r.score) for r in C.search(d, q, **k).collect()}


def test_search_tiers(birds):
    assert found(birds, "great tit") == {1: 202, 3: 160, 4: 30, 6: 30}
    assert found(birds, "great merula") == {2: 190}
    assert found(birds, "great") == {1: 162, 2: 150, 3: 160, 4: 140, 6: 30}
    assert found(birds, "parus robustus")[1] == 192
    assert found(birds, "gre ow") == {4: 90}
    assert found(birds, "titus") == {4: 110} and found(birds, "turd") == {2: 120} and found(birds, "itus") == {4: 60} and found(birds, "ackb") == {2: 70}
    assert found(birds, "elan")[6] == 160 and found(birds, "kohlmeise") == {1: 32}
    assert set(found(birds, "   ").values()) == {130, 132} and len(found(birds, "")) == 6
    assert found(birds, "great", group="amphibia") == {3: 160}


def test_sorting_with_nulls_and_ties(birds):
    order = lambda s: [r.ord for r in C.page(birds, s, 1, 10).collect()]
    assert order("observations_count") == [4, 5, 6, 3, 1, 2]
    assert order("-observations_count") == [2, 1, 3, 6, 5, 4]
    assert order("taxon_group") == [3, 1, 2, 4, 6, 5] and order("") == [1, 2, 3, 4, 5, 6] and order("nothing") == [1, 2, 3, 4, 5, 6]
    assert C.page(birds, "", 9, 10).count() == 0 and C.paging(0, 1, 50)["total_pages"] == 1 and C.paging(101, 1, 50)["total_pages"] == 3
    with pytest.raises(ValueError):
        C.page(birds, "", 1, 501)


def test_lookup(spark, birds):
    ids = spark.createDataFrame([("PARUS MAJOR",), ("parus robustus",), ("kohlmeise",), ("great tit",), ("bn00001",), ("GRETIT1",), ("rana altera",), ("6",), ("none",), (None,)], "i string")
    assert {r.identifier: r.ord for r in C.lookup(birds, ids, "i").collect()} == {"PARUS MAJOR": 1, "parus robustus": 1, "kohlmeise": 1, "great tit": 1, "bn00001": 1, "GRETIT1": 1, "rana altera": 3, "6": 2, "none": None}


def test_filters_and_projection(birds):
    ids = lambda d: sorted(r.ord for r in d.collect())
    assert ids(C.filters(birds, has_image="TRUE")) == [1] and ids(C.filters(birds, has_image="no")) == [2, 3, 4, 5, 6]
    assert ids(C.filters(birds, max_observations=0)) == [2, 4] and ids(C.filters(birds, description_source=" Wikipedia ,x")) == [1]
    assert C.project(birds, fields="scientific_name,zzz", exclude="scientific_name").columns == ["scientific_name"]
    assert "ord" not in C.project(birds, exclude="ord").columns
    assert C.project(birds, locale="fr").where("ord = 1").first().common_names == {}
    assert [r.scientific_name for r in C.suggest(birds, "g", 5).collect()] == []
    assert [r.common_name for r in C.suggest(birds, "parus", 1, "de").collect()] == ["Kohlmeise"]


def test_empty_catalog(spark):
    e = spark.createDataFrame([], SCHEMA)
    assert C.search(e, "x").count() == 0 and C.group_counts(e).count() == 0 and C.page(e).count() == 0 and C.lookup_index(e).count() == 0


def test_quality_and_audit(birds):
    d = quality.score(birds, ["inat_id", "ebird_code"], ["ebird_code", "xc_name"])
    got = {r.ord: (r.quality_score, set(r.quality_flags)) for r in d.collect()}
    assert got[1] == (30 + 2 + 20 + 6 + 5 + 5, {"few_localized_descriptions", "weak_external_ids"})
    assert got[5][0] == 5 and "missing_common_name" in got[5][1]
    k = {r.ord: r.drop_reasons for r in quality.drop_reasons(d, 20, {"Amphibia": 0}).collect()}
    assert k[1] == [] and k[5] == [] and k[3] == ["thin_record"] and k[2] == ["score_below_20", "thin_record"]
    a = quality.audit(birds, ["birdnet_id", "taxon_group"])
    n = {r.finding: r.n for r in a.collect()}
    assert n["missing_birdnet_id"] == 5 and n["missing_taxon_group"] == 1 and n["short_english"] == 4 and n["bad_scientific_name"] == 0
    assert quality.failed(a, ["missing_birdnet_id"]) and not quality.failed(a, ["bad_scientific_name"])


def test_alias_rules(spark):
    d = spark.createDataFrame([("A a", ["X x", "Y y", "B b"], ["X x"]), ("B b", ["x X", "Z z"], None)], "s string, a array<string>, m array<string>")
    got = {(r.s, r.alias) for r in merge.prune_aliases(d, "s", "a").collect()}
    assert got == {("A a", "Y y"), ("B b", "Z z")}
    assert ("A a", "X x") in {(r.s, r.alias) for r in merge.prune_aliases(d, "s", "a", "m").collect()}


def test_merges(spark):
    d = spark.createDataFrame([({"de": "w"}, "e", {"de": "l", "fr": ""}), (None, "", None), ({"en": "w"}, "e", {"en": "l"})], "b map<string,string>, e string, o map<string,string>")
    got = [(r.descriptions, r.description_sources, r.description_source) for r in merge.merge_descriptions(d, "b", "e", "o").collect()]
    assert got[0] == ({"de": "l", "en": "e"}, {"de": "llm", "en": "ebird"}, "ebird")
    assert got[1] == ({}, {}, "") and got[2] == ({"en": "l"}, {"en": "llm"}, "llm")


def test_pushdown_reaches_the_scan(spark, sf):
    d = C.filters(records(spark, sf), min_observations=5).select("rec_id", "observations_count")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "descriptions" not in plan


def test_pages_records_and_fields(spark):
    from taxaloom.operators import catalog as C

    cols = "ord bigint, scientific_name string, common_name string, common_name_alt string, birdnet_id string, ebird_code string, xc_name string, inat_id bigint, scientific_name_aliases array<string>, common_names map<string,string>, taxon_group string, observations_count bigint, image_url string, image_author string, _inner int"
    rows = [(i, f"Bubo x{i}", "Owl" if i else None, None, f"BN{i}", None, None, i, None, {"de": "Eule", "fr": "Hibou"}, "Aves", None if i == 2 else i % 2, "/a.jpg" if i else "", "Ann", 1) for i in range(5)]
    d = spark.createDataFrame(rows, cols)
    assert [r.ord for r in C.search_page(d, "owl", sort="observations_count").collect()] == [4, 1, 3, 2]
    assert len(C.search_page(d, "owl", size=1, number=2).collect()) == 1
    assert [r.scientific_name for r in C.species(d, "bn3", fields="scientific_name").collect()] == ["Bubo x3"] and C.species(d, "nobody").count() == 0
    assert C.species(d, "BN3", locale="fr").first().common_names == {"fr": "Hibou"}
    assert "ord" not in [r.field for r in C.field_list(d).collect()] and "_inner" not in [r.field for r in C.field_list(d).collect()]
    a = {r.birdnet_id: r.image for r in C.api_record(d, "/root").collect()}
    assert a["BN0"] is None and (a["BN1"].url, a["BN1"].author) == ("/root/a.jpg", "Ann")
    for bad in ({"size": 0}, {"size": 501}, {"number": 0}):
        try:
            C.search_page(d, "owl", **bad)
        except ValueError:
            continue
        raise AssertionError(bad)


def test_ranks_in_a_hot_group(spark):
    from pyspark.sql import functions as F

    from taxaloom.operators import ordering as O

    d = spark.range(0, 3000).select(F.when(F.col("id") % 7 == 0, "b").when(F.col("id") % 11 == 0, F.lit(None)).otherwise("a").alias("g"), F.col("id").alias("i"))
    got = O.rank_in_groups(d, ["g"], [F.col("i")], parts=9)
    seen = {}
    for r in sorted(got.collect(), key=lambda r: r.i):
        seen[r.g] = seen.get(r.g, 0) + 1
        assert r.rank == seen[r.g]
    assert O.chunks(d, [F.col("i")], 100, ["g"]).where("g = 'a'").agg(F.max("chunk")).first()[0] == (seen["a"] - 1) // 100
    assert O.chunks(d.where("false"), [F.col("i")], 100, ["g"]).count() == 0
