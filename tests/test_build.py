"""The whole build over small keyed documents."""

import json

from taxaloom.plans import build
from taxaloom.sources import files
from taxaloom.sources.files import SCHEMAS, keyed_json


def sources(spark, tmp_path):
    def keyed(name, doc):
        p = tmp_path / f"{name}.json"
        p.write_text(json.dumps(doc))
        return keyed_json(spark, str(p), SCHEMAS[name])

    words = "word " * 90
    inat = {
        "Parus major": {"inat_id": 1, "taxon_group": "Aves", "preferred_common_name": "Tit", "common_names": {"nb": "kjøttmeis"}, "image_url": "i1", "image_license": "cc-by", "image_attribution": "(c) Ann, some rights reserved (CC BY)", "observations_count": 9},
        "Owlus novus": {"inat_id": 2, "taxon_group": "Aves", "preferred_common_name": "Fine Owl", "image_url": "i2", "image_license": "c"},
        "Linkus codus": {"inat_id": 3, "taxon_group": "Aves", "preferred_common_name": "Nothing"},
        "Avis ignota": {"inat_id": 4, "taxon_group": "Aves", "preferred_common_name": "Unknown"},
        "Rana bona": {"inat_id": 5, "taxon_group": "Amphibia", "preferred_common_name": "Frog"},
        "Rana mortua": {"inat_id": 6, "taxon_group": "Amphibia", "extinct": True},
        "Rana": {"inat_id": 7, "taxon_group": "Amphibia"},
        "Felis catus": {"inat_id": 8, "taxon_group": "Mammalia"},
    }
    p = tmp_path / "c.csv"
    p.write_text("Taxon_rank;Scientific_name;Species_code_Cornell_Lab;English_name_Clements_v2024;English_name_AviList\n" + "".join(f"species;{x}\n" for x in ("Parus major;gretit;Great Tit (C);Great Tit", "Owlus vetus;owl1;Fine Owl;Fine Owl", "Codus verus;cod1;Code Bird;Code Bird", "Extra avis;ext1;Extra;Extra")))
    return build.Sources(
        inat=keyed("inat", inat), checklist=files.checklist(spark, str(p)),
        ebird=keyed("ebird", {"Parus major": {"ebird_code": "gretit", "description": "Seen often.", "image_url": "e1", "image_attribution": "Great Tit - Bo / Macaulay Library"}, "Owlus novus": {"ebird_code": "owl1", "image_url": "e2", "image_attribution": "Owl - Cy / Macaulay Library"}}),
        wikidata=keyed("wikidata", {"Linkus codus": {"ebird_code": "cod1", "aliases": ["Linkus alter", "Parus major"]}, "Parus major": {"gbif_id": "7", "avibase_id": "av", "labels": {"de": "Kohlmeise"}, "aliases": ["Parus robustus", "Linkus alter"]}, "Rana bona": {"avibase_id": "no"}}),
        wikipedia=keyed("wikipedia", {"Parus major": {"extract": words, "extracts": {"de": words, "en": "other"}, "wikipedia_urls": {"en": "u"}}}),
        macaulay=keyed("macaulay", {"Parus major": {"ml_taxon_code": "ml1"}}), xc=keyed("xc", {"Parus major": {"xc_name": "Parus major"}}), observationorg=keyed("observationorg", {}),
        translate=keyed("translate", {"Parus major": {"extracts": {"fr": "f", "de": "d"}}}), sound_classes=keyed("sound_classes", {"Rain": {"taxon_group": "Environment", "image_url": "r"}}),
        ebird_names=spark.createDataFrame([("gretit", "en", "Great Tit"), ("gretit", "sv", "talgoxe"), ("gretit", "fr", "Great Tit")], "code string, locale string, name string"),
        overrides=spark.createDataFrame([("Rana bona", "o1", "Di", "own")], "scientific_name string, image_url string, image_author string, image_source string"),
        aliases=spark.createDataFrame([("Rana bona", "Rana melior")], "scientific_name string, alias string"), groups=["Aves", "Amphibia"],
    )


def test_build(spark, tmp_path):
    s = sources(spark, tmp_path)
    got = {r.scientific_name: r for r in build.records(s).collect()}
    assert set(got) == {"Parus major", "Owlus novus", "Linkus codus", "Rana bona", "Extra avis", "Rain"}
    assert {k: r.match_source for k, r in got.items()} == {"Parus major": "direct", "Owlus novus": "named", "Linkus codus": "linked", "Rana bona": "non_bird", "Extra avis": "checklist_only", "Rain": "sound_class"}
    t = got["Parus major"]
    assert (t.common_name, t.common_name_alt, t.ebird_code, t.avibase_id, t.ml_taxon_code) == ("Great Tit", "Great Tit (C)", "gretit", "av", "ml1")
    assert t.common_names == {"de": "Kohlmeise", "no": "kjøttmeis", "sv": "talgoxe", "en": "Great Tit"}
    assert t.description_sources == {"en": "wikipedia", "de": "llm", "fr": "llm"} and t.description_source == "wikipedia"
    assert t.scientific_name_aliases == ["Parus robustus"] and (t.image_url, t.image_author, t.image_source) == ("i1", "Ann", "inat")
    assert (got["Owlus novus"].image_url, got["Owlus novus"].image_author) == ("e2", "Cy")
    assert got["Rana bona"].avibase_id is None and got["Rana bona"].scientific_name_aliases == ["Rana melior"] and got["Rana bona"].image_author == "Di"
    assert got["Rain"].image_source == "sound_class" and got["Linkus codus"].scientific_name_aliases == []
    registry = spark.createDataFrame([("Rain", 7)], "scientific_name string, number bigint")
    out, new = build.finish(build.records(s), registry)
    ids = {r.scientific_name: r.birdnet_id for r in out.collect()}
    assert ids["Rain"] == "BN00007" and ids["Parus major"] == "BN00008" and "Linkus codus" not in ids
    assert new.count() == len(ids)
    reasons = {r.scientific_name: r.reason for r in build.included(s.inat, s.groups).collect()}
    assert reasons["Rana mortua"] == "extinct" and reasons["Rana"] == "not_species" and reasons["Felis catus"] == "group" and reasons["Parus major"] is None


def test_taxonomy_table_and_registry(spark, tmp_path):
    import pytest

    t, made = str(tmp_path / "taxonomy"), []

    def make():
        made.append(1)
        return spark.createDataFrame([("A", 1)], "scientific_name string, n int")

    with pytest.raises(FileNotFoundError):
        build.kept_taxonomy(spark, t, make, merge_only=True)
    assert build.kept_taxonomy(spark, t, make).count() == 1 and build.kept_taxonomy(spark, t, make, merge_only=True).count() == 1 and made == [1]
    r = str(tmp_path / "registry")
    ids = spark.createDataFrame([("A", 1), ("B", 2)], "scientific_name string, number bigint")
    assert build.read_registry(spark, r).count() == 0 and build.grow_registry(spark, r, ids) == 2 and build.grow_registry(spark, r, ids) == 0
    assert build.grow_registry(spark, r, ids.unionByName(spark.createDataFrame([("C", 3)], ids.schema))) == 1 and build.read_registry(spark, r).count() == 3
    d = spark.createDataFrame([("BN100000",), ("BN00007",), ("BN99999",)], "birdnet_id string")
    assert [x[0] for x in build.delivered(d).collect()] == ["BN00007", "BN100000", "BN99999"]
