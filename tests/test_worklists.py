"""Worklists on small fixtures: empty tables, nulls, ties, limits."""

import pytest
from pyspark.sql import functions as F

from taxaloom.operators import worklists as W

INAT = "scientific_name string, inat_id bigint, taxon_group string, ebird_code string, wikipedia_url string, scientific_name_aliases array<string>, common_name string, observations_count bigint, sound_observations_count bigint, ord bigint"
LIST = "ord bigint, name string, code string, english string"
TEXTS = "scientific_name string, extract string, extracts map<string,string>, ord bigint"


@pytest.fixture()
def inat(spark):
    rows = [("Parus major", 1, "Aves", " gretit ", " u1 ", ["Parus aa", "PARUS AA", "x"], "Tit", 5, 2, 0), ("Rana bona", None, "Amphibia", "c9", "u2", None, "Frog", None, None, 1), ("Rana", 3, "Amphibia", "", "", None, None, 7, 0, 2), (None, 4, None, None, None, None, None, 1, 1, 3)]
    return spark.createDataFrame(rows, INAT)


@pytest.fixture()
def listed(spark):
    return spark.createDataFrame([(0, "Parus major", "other", "Great Tit"), (1, "Bubo albus", "bub1", "Owl"), (2, "Bubo albus", "bub2", "Owl"), (3, None, "x", None)], LIST)


def rows(d, *c):
    return sorted((tuple(r) for r in d.select(*c).collect()), key=str)


def test_species_lists(spark, inat, listed):
    manual = spark.createDataFrame([("Parus major", "Parus bb", 2), ("Parus major", "parus bad (x)", 3), ("Parus major", "Parus aa", 4)], "scientific_name string, alias string, line bigint")
    d = W.species_worklist(None, inat, listed, manual)
    assert rows(d, "scientific_name", "taxon_group", "scientific_name_aliases") == [("Bubo albus", "Aves", []), ("Parus major", "Aves", ["Parus aa", "Parus bb"]), ("Rana bona", "Amphibia", [])]
    assert rows(W.species_worklist(None, inat, listed, manual, "Amphibia"), "scientific_name") == [("Rana bona",)]
    assert rows(W.species_worklist(inat.where("ord = 1"), inat, listed, manual), "scientific_name") == [("Rana bona",)]
    assert rows(W.codes_by_species(inat, listed), "*") == [("Bubo albus", "bub1"), ("Parus major", "gretit")]
    assert rows(W.pages_by_species(inat), "*") == [("Parus major", "u1")]
    assert rows(W.ids_by_species(inat, listed), "*") == [("Bubo albus", None), ("Parus major", 1)]
    assert rows(W.observation_counts(inat), "*") == [("Parus major", 5), ("Rana bona", 0), ("Rana", 7)]
    assert W.over_thresholds(inat, 2).count() == 1 and W.over_thresholds(inat, 2, 7).count() == 2
    empty = inat.where("false")
    assert W.species_worklist(None, empty, listed.where("false"), manual).count() == 0 and W.codes_by_species(empty, listed.where("false")).count() == 0


def test_locales(spark):
    assert len(W.TAXONOMY_LOCALES) + len(W.RENAMED_LOCALES) == 63
    d = spark.createDataFrame([("zh_SIM",), ("pt_BR",), ("es_AR",), ("xx",), (None,)], "l string")
    assert [r[0] for r in d.select(W.canonical_locale("l")).collect()] == ["zh", "pt", "es_AR", None, None]
    assert W.target_locales("all", ["de", "en", "de"]) == ["de"] and W.target_locales(" fr, en ,fr", []) == ["fr"]
    n = spark.createDataFrame([("c", "en", "Owl", 0), ("c", "zh_SIM", "x", 1), ("c", "zh_SIM", "y", 2), ("c", "fr", "Owl", 3), ("c", "xx", "z", 4), ("d", "de", "Eule", 5), ("d", "fr", "", 6), (None, "fr", "q", 7)], "code string, locale string, name string, ord bigint")
    assert {r.code: r.names for r in W.names_by_code(n).collect()} == {"c": {"en": "Owl", "zh": "y"}, "d": {"de": "Eule"}}


def test_work(spark):
    long, short = "word " * 50, "word " * 3
    t = spark.createDataFrame([("A", None, {"en": long, "de": ""}, 0), ("B", long, None, 1), ("C", short, {}, 2), ("D", None, {"fr": short, "es": long}, 3), ("E", None, None, 4)], TEXTS)
    counts = spark.createDataFrame([("B", 9), ("A", None)], "scientific_name string, observations bigint")
    got = [(r.scientific_name, r.locale) for r in W.translation_work(t, ["de", "fr"], 40, counts).orderBy("turn").collect()]
    assert got == [("B", "de"), ("B", "fr"), ("A", "de"), ("A", "fr")]
    assert W.translation_work(t, [], 40).count() == 0 and W.translation_work(t.where("false"), ["de"], 1).count() == 0
    made = spark.createDataFrame([("A", {"fr": "x"}), ("D", {"es": "made"})], "scientific_name string, extracts map<string,string>")
    g = W.generation_work(t, made, ["de", "fr"], 20).orderBy("turn").collect()
    assert [(r.phase, r.scientific_name, r.locale, r.missing, r.sources) for r in g] == [
        (1, "A", "en", [], []), (2, "A", "en", ["de"], []), (2, "B", "en", ["de", "fr"], []), (2, "C", "en", ["de", "fr"], []), (3, "D", "en", [], ["es", "fr"]),
    ]
    assert [r.turn for r in W.generation_work(t, made, ["de"], 20, limit=2).orderBy("turn").collect()] == [1, 2]
    assert W.generation_work(t, made, ["de"], 20, fallback=False).where("phase = 3").count() == 0


def test_store(spark):
    t = spark.createDataFrame([("A", {"en": "a"}, None, None), ("B", None, None, None)], f"scientific_name string, extracts map<string,string>, extract_sources map<string,string>, translation map<string,{W.TRANSLATION}>")
    r = spark.createDataFrame([("A", "de", "old", "mt", "s", 0), ("A", "de", "new", "mt", "s", 1), ("N", "fr", "n", "llm", "p", 2)], "scientific_name string, locale string, text string, source string, service string, ord bigint")
    got = {x.scientific_name: x for x in W.store_translations(t, r).collect()}
    assert got["A"].extracts == {"en": "a", "de": "new"} and got["A"].extract_sources == {"de": "mt"} and tuple(got["A"].translation["de"]) == ("en", "s", "mt")
    assert got["B"].extracts == {} and got["N"].extracts == {"fr": "n"}


def test_steps_files_and_classes(spark):
    s = spark.createDataFrame([("A",), ("B",), ("C",), ("A",)], "scientific_name string")
    one = spark.createDataFrame([("A", ""), ("B", "b1"), ("A", None)], "scientific_name string, value string")
    syn = spark.createDataFrame([("A", "y", 1), ("A", "x", 0), ("C", "q", 0)], "scientific_name string, synonym string, pos int")
    known = spark.createDataFrame([("x", "vx"), ("y", "vy")], "name string, value string")
    assert rows(W.resolve_in_steps(s, [("one", one)], syn, known), "*") == [("A", "vx", "synonym", "x"), ("B", "b1", "one", None), ("C", None, None, None)]
    assert rows(W.resolve_in_steps(s, [("one", one)], None, known), "*") == [("A", None, None, None), ("B", "b1", "one", None), ("C", None, None, None)]
    i = spark.createDataFrame([("f", "A"), ("f", "B"), ("f", "A"), (None, "C"), ("g", "C")], "file string, scientific_name string")
    assert rows(W.by_file(i), "*") == [("f", ["A", "B"]), ("g", ["C"])] and rows(W.orphans(i, i.where("file = 'g'").select("file")), "*") == [("f",), (None,)]
    assert rows(W.fetched_only(s, s.where("scientific_name = 'A'").distinct(), "scientific_name"), "*") == [("A",), ("A",)]
    assert [tuple(r) for r in W.work_by_locale(spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "locale string"), 2).collect()] == [("b", 2), ("a", 1)]
    c = W.configured_classes(spark, [{"name": "Rain", "group": "Environment", "wikidata_qid": "Q1", "aliases": ["Rain fall", "RAIN FALL", "x/y"]}])
    labels = spark.createDataFrame([("Q1", "nb", "regn"), ("Q1", "de", "Regen")], "qid string, locale string, label string")
    r = W.sound_classes(c, labels, spark.createDataFrame([("Q1", "r.jpg")], "qid string, image string")).first()
    assert r.aliases == ["Rain fall"] and r.common_names == {"no": "regn", "de": "Regen"} and r.image_file == "r.jpg"
    with pytest.raises(ValueError):
        W.configured_classes(spark, [{"name": "Rain"}])
    with pytest.raises(ValueError):
        W.configured_classes(spark, [{"name": "Ra/in", "group": "g"}])
    assert F is not None
