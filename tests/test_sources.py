import json
import zipfile

import pytest
from pyspark.sql import functions as F

from taxaloom.sources import config, files, paged, sinks
from taxaloom.streaming import journal as J


def test_keyed_json_keeps_order(spark, tmp_path):
    p = tmp_path / "x.json"
    p.write_text(json.dumps({"B b": {"xc_name": "Q", "aliases": ["z"]}, "A a": None}))
    d = files.keyed_json(spark, str(p), files.SCHEMAS["xc"])
    assert [(r.ord, r.scientific_name, r.xc_name) for r in d.orderBy("ord").collect()] == [(0, "B b", "Q"), (1, "A a", None)]
    assert files.keyed_json(spark, str(tmp_path / "none"), files.SCHEMAS["xc"]).count() == 0
    with pytest.raises(FileNotFoundError, match="fetch"):
        files.keyed_json(spark, str(tmp_path / "none"), files.SCHEMAS["xc"], required=True, hint="fetch it first")


def test_every_schema_parses(spark, tmp_path):
    p = tmp_path / "x.json"
    p.write_text('{"A a": {}}')
    for s in files.SCHEMAS.values():
        assert files.keyed_json(spark, str(p), s).count() == 1


def test_checked_tables(spark, tmp_path):
    head = "scientific_name,image_url,image_author,image_license,image_source,image_crop_anchor\n"

    def overrides(body):
        (tmp_path / "o.csv").write_text(head + body)
        return files.image_overrides(spark, str(tmp_path / "o.csv"))

    assert overrides("A a,,,,,5\nB b,u,v,w,x,\n").count() == 2
    for bad in (",,,,,5\n", "A a,u,,,,\n", "A a,,,,,0\n", "A a,,,,,x\n", "A a,,,,,1\nA a,,,,,2\n"):
        with pytest.raises(files.InvalidRows):
            overrides(bad)
    p = tmp_path / "a.csv"
    p.write_text("scientific_name,alias\nAa bb,Cc dd\nAa bb,Aa bb\nx,y\nAa bb,Cc dd\n")
    with pytest.raises(files.InvalidRows, match="line 3"):
        files.aliases(spark, str(p))
    assert files.aliases(spark, str(p), strict=False).count() == 1
    assert files.aliases(spark, str(tmp_path / "none"), strict=False).count() == 0
    p.write_text("scientific_name\nAa bb\n")
    with pytest.raises(files.InvalidRows, match="missing columns"):
        files.aliases(spark, str(p))
    p.write_text("scientific_name,taxon_group,source,reason,inat_id,gbif_id,common_name\nAa bb,Aves,s,r,12,,n\n")
    assert files.priority_species(spark, str(p)).first().inat_id == 12
    p.write_text("scientific_name,taxon_group,source,reason,inat_id,gbif_id,common_name\nAa bb,Aves,s,r,x,,n\n")
    with pytest.raises(files.InvalidRows):
        files.priority_species(spark, str(p))


def test_checklist(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("Taxon_rank;Scientific_name;Species_code_Cornell_Lab;English_name_Clements_v2024;English_name_AviList\nspecies; Aa bb ;c1;E;F\ngenus;Aa;;;\nspecies;Cc dd;;E;F\n")
    assert [(r.name, r.code, r.english) for r in files.checklist(spark, str(p)).collect()] == [("Aa bb", "c1", "F")]
    assert files.checklist(spark, str(tmp_path / "none")).count() == 0


CALLS = []


def pages(page, options):
    return [{"id": page * 10 + i, "n": 100 - page * 10 - i} for i in range(3)] if page <= 4 else []


def test_paged_source(spark, tmp_path):
    d = paged.read_pages(spark, "id bigint, n bigint", "tests.test_sources:pages", 6, pages_per_partition=2, cache=str(tmp_path / "cache"))
    assert sorted(r.id for r in d.collect()) == [p * 10 + i for p in range(1, 5) for i in range(3)]
    assert d.rdd.getNumPartitions() == 3 and len(list((tmp_path / "cache").iterdir())) >= 4
    cut = paged.read_pages(spark, "id bigint, n bigint", "tests.test_sources:pages", 4, pages_per_partition=4, stop_below_field="n", stop_below=80)
    assert cut.count() == 4


def test_whole_read_stops(spark):
    from taxaloom.session import checkpoint

    asked = []

    def keep(d):
        asked.append(1)
        return checkpoint(d)

    got = paged.read_until(spark, "id bigint, n bigint", "tests.test_sources:pages", 40, 2, "n", 75, keep, pages_per_partition=1)
    assert sorted(r.n for r in got.collect()) == [78, 79, 80, 88, 89, 90] and len(asked) == 2


def test_storage(spark, tmp_path):
    from taxaloom.sources import storage

    f = str(tmp_path / "x.txt")
    assert not storage.exists(spark, f)
    storage.write_text(spark, f, "é1")
    storage.write_text(spark, f, "é2")
    assert storage.exists(spark, f) and storage.exists(spark, "file://" + f) and storage.read_text(spark, f) == "é2" and storage.size(spark, f) == 3
    d = spark.range(0, 1000, 1, 7).withColumn("s", F.concat(F.lit('a"\n'), F.col("id").cast("string")))
    assert sinks.write_json_array(d, f, "id", False) == 1000 and [r["id"] for r in json.load(open(f))] == list(range(1000)) and json.load(open(f))[3]["s"] == 'a"\n3'
    sinks.write_keyed_json(d, f, "s", "id")
    assert len(json.load(open(f))) == 1000
    assert sinks.write_json_array(d.where("false"), f, "id") == 0 and json.load(open(f)) == []
    sinks.write_keyed_json(d.where("false"), f, "s", "id")
    assert json.load(open(f)) == {} and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["x.txt"]


def test_documents_beyond_a_task_raise(spark, tmp_path, monkeypatch):
    p = tmp_path / "a.json"
    p.write_text('{"A": {"xc_name": "x"}}')
    assert files.keyed_json(spark, str(p), files.SCHEMAS["xc"]).count() == 1
    monkeypatch.setattr(files, "MOST_DOCUMENT", 5)
    with pytest.raises(ValueError):
        files.keyed_json(spark, str(p), files.SCHEMAS["xc"])
    q = tmp_path / "b.jsonl"
    q.write_text('{"ord": 0, "scientific_name": "A", "xc_name": "x"}\n')
    assert [r.xc_name for r in files.landed(spark, str(q), files.SCHEMAS["xc"]).collect()] == ["x"]


def test_retries():
    seen = []

    def call():
        seen.append(1)
        if len(seen) < 3:
            raise OSError
        return "ok"

    pauses = []
    assert paged.with_retries(call, 3, 1, pauses.append) == "ok" and pauses == [1, 2]
    with pytest.raises(ZeroDivisionError):
        paged.with_retries(lambda: 1 / 0, 2, 0, pauses.append)


def test_config(tmp_path, monkeypatch):
    p = tmp_path / "c.yml"
    p.write_text('{"taxon_groups": {"Aves": {"min": 1}, "Off": {"enabled": false}}, "a": {"b": null}}')
    t = config.load(str(p))
    assert config.get(t, "taxon_groups.Aves.min") == 1 and config.get(t, "a.b", 3) == 3 and config.get(t, "q.r") is None
    assert list(config.groups(t)) == ["Aves"] and config.url_prefix("x/") == "/x" and config.url_prefix(None) == ""
    (tmp_path / ".env").write_text('# c\nKEY="v"\n')
    monkeypatch.delenv("KEY", raising=False)
    assert config.env_value("KEY", str(tmp_path / ".env")) == "v" and config.env_value("NO", str(tmp_path / ".env")) is None


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([(2, "b", None, {"en": "x", "de": 'y"'}), (1, "a", ["p", "q"], {"en": "z"})], "ord bigint, s string, a array<string>, common_names map<string,string>")
    j, c, z = (str(tmp_path / n) for n in ("x.json", "x.csv", "x.zip"))
    assert sinks.write_json_array(d, j, "ord") == 2
    assert json.load(open(j))[1] == {"ord": 2, "s": "b", "a": None, "common_names": {"en": "x", "de": 'y"'}}
    sinks.write_csv(sinks.export_columns(d, ["ord", "a"]), c, "ord")
    assert open(c).read().splitlines() == ["ord,a,common_name_en,common_name_de", "1,p|q,z,", '2,,x,"y"""']
    sinks.write_zip(z, [j, c])
    assert sorted(zipfile.ZipFile(z).namelist()) == ["x.csv", "x.json"]
    sinks.write_keyed_json(d, j, "s")
    assert list(json.load(open(j))) == ["a", "b"]
    assert sinks.api_csv(d.where("false")) == "" and sinks.api_csv(d, "s,ord").startswith("s\r\n")


def test_journal_stream_is_exact(spark, tmp_path):
    src, state, ck = (str(tmp_path / n) for n in ("j", "s", "c"))
    (tmp_path / "j").mkdir()

    def put(name, *rows):
        (tmp_path / "j" / name).write_text("".join(r if isinstance(r, str) else json.dumps(r) + "\n" for r in rows))

    put("1.json", {"scientific_name": "A", "extracts": {"de": "one"}, "fallback": True, "written_at": "2025-01-01T00:00:00"}, "{broken\n", {"scientific_name": None, "extracts": {"de": "x"}})
    J.follow(spark, src, state, ck)
    put("2.json", {"scientific_name": "A", "extracts": {"de": "two", "fr": "three", "es": ""}, "written_at": "2025-01-02T00:00:00"}, {"scientific_name": "B", "extracts": {"pl": "p"}, "written_at": "2025-01-02T00:00:00"})
    J.follow(spark, src, state, ck)
    J.follow(spark, src, state, ck)
    got = {r.scientific_name: (r.extracts, r.fallback_locales) for r in J.read_state(spark, state).collect()}
    assert got == {"A": ({"de": "one", "fr": "three"}, ["de"]), "B": ({"pl": "p"}, [])}
    assert got == {r.scientific_name: (r.extracts, r.fallback_locales) for r in J.replay(spark, src).collect()}
    work = spark.createDataFrame([("A",), ("C",)], "scientific_name string")
    assert [r[0] for r in J.pending(work, J.read_state(spark, state), ["scientific_name"]).collect()] == ["C"]


def test_attempts(spark):
    s = spark.createDataFrame([("A", "de", 2, "short")], "scientific_name string, locale string, attempts int, last_status string")
    o = spark.createDataFrame([("A", "de", "short", 1), ("B", "fr", "ok", 1)], "scientific_name string, locale string, status string, checked_at int")
    got = {r.scientific_name: (r.attempts, r.last_status, r.open) for r in J.count_attempts(s, o, 3).collect()}
    assert got == {"A": (3, "short", False), "B": (1, "ok", False)} and F is not None
