import datetime as dt
import json

from pyspark.sql import functions as F

from taxaloom.functions import text as T
from taxaloom.sources import answers as A
from taxaloom.sources.files import SCHEMAS


def one(spark, expr, *values):
    names = [f"v{i}" for i in range(len(values))]
    return spark.createDataFrame([values], ", ".join(f"{n} string" for n in names)).select(expr).first()[0]


def test_taxon(spark):
    doc = {"id": 9, "extinct": None, "names": [
        {"name": "X", "locale": "en", "is_valid": False, "lexicon": "english"}, {"name": "Tit", "locale": "en", "is_valid": True, "lexicon": "english"}, {"name": "Second", "locale": "en", "is_valid": True},
        {"name": "GRTI", "locale": "en-x", "is_valid": True, "lexicon": "aou-4-letter-codes"}, {"name": "P m", "locale": "sci", "is_valid": True}, {"name": "u", "locale": "und", "is_valid": True}, {"name": "Meise", "locale": "de", "is_valid": True},
    ], "default_photo": {"url": "https://p/1/square.jpg", "license_code": "cc-by"}}
    r = one(spark, A.taxon("v0", F.lit("Aves"), F.lit(3)), json.dumps(doc))
    assert (r.inat_id, r.taxon_group, r.common_names, r.image_url, r.image_license, r.observations_count, r.extinct) == (9, "Aves", {"en": "Tit", "de": "Meise"}, "https://p/1/large.jpg", "cc-by", 0, False)
    broken = one(spark, A.taxon("v0", F.lit("Aves"), F.lit(0)), "{oops")
    assert broken.inat_id is None and broken.common_names == {} and broken.image_url == ""


def test_photo(spark):
    doc = {"results": [{"photos": [{"url": "a/medium.png", "license_code": None}, {"url": "b/medium.png", "license_code": "c"}]}, {}, {"photos": [{"url": "c/small.png", "license_code": "cc0", "attribution": "x"}]}]}
    r = one(spark, A.first_licensed_photo("v0"), json.dumps(doc))
    assert (r.url, r.attribution, r.license) == ("c/large.png", "x", "cc0")
    assert one(spark, A.first_licensed_photo("v0"), '{"results": []}') is None and one(spark, A.first_licensed_photo("v0"), None) is None


def test_lookups(spark):
    m, s = json.dumps({"species": "Aa bb"}), json.dumps({"results": [{"species": "cc DD"}, {"canonicalName": "Ee ff"}, {"species": "Ee ff"}, {"species": "Gg hh"}]})
    assert one(spark, A.synonyms("v0", "v1", "v2"), m, s, "gg HH") == ["Aa bb", "Ee ff"]
    assert one(spark, A.synonyms("v0", "v1", "v2"), None, None, "x") == []
    ml = json.dumps([{"code": "t-1,genus", "name": "X - Aa bb"}, {"code": "bad", "name": "Aa bb"}, {"code": "t-2,species", "name": "Tit - aa BB"}])
    assert one(spark, A.species_code("v0", "v1"), ml, "Aa bb") == "t-2" and one(spark, A.species_code("v0", "v1"), "[]", "Aa bb") is None
    xc = json.dumps({"recordings": [{"gen": "", "sp": "x"}, {"gen": "Aa", "sp": "bb"}, {"gen": "Cc", "sp": "dd"}]})
    assert one(spark, A.recording_name("v0"), xc) == "Aa bb" and one(spark, A.recording_name("v0", F.lit("dd")), xc) == "Cc dd" and one(spark, A.recording_name("v0", F.lit("zz")), xc) is None


def test_page_and_age(spark):
    html = '<meta property="og:image" content="https://c/asset/12/640"><meta property="og:image:alt" content="Owl - Bo"><meta property="og:description" content="D">'
    r = one(spark, A.code_page("v0"), html)
    assert tuple(r) == ("D", "https://c/asset/12", "12", "Owl - Bo")
    now = dt.datetime(2025, 1, 10)
    rows = [(now - d, now) for d in (dt.timedelta(days=3, hours=2), dt.timedelta(hours=5), dt.timedelta(minutes=12), dt.timedelta(seconds=40))]
    assert [x[0] for x in spark.createDataFrame(rows, "a timestamp, b timestamp").select(T.age_text("a", "b")).collect()] == ["3d", "5h", "12m", "40s"]


def test_sound_classes(spark):
    d = spark.createDataFrame([(0, "Rain", None, "Env", None, None, {"nb": "regn", "de": "R/x"}, ["Drops", "drops"], None, None), (1, "Bad (x)", "y", None, None, None, None, None, None, None)], f"ord int, scientific_name string, {SCHEMAS['sound_classes']}")
    r = A.sound_classes(d).collect()
    assert len(r) == 1 and r[0].common_names == {"no": "regn", "en": "Rain"} and r[0].common_name == "Rain" and r[0].common_name_aliases == ["Drops"]


def test_requests(spark):
    from taxaloom.sources import requests as R

    d = spark.createDataFrame([(f"T {i:03d}",) for i in range(120)] + [(None,), ("",), ("T 001",)], "t string")
    r = R.title_requests(d, "t").orderBy("chunk").collect()
    assert [len(x.request.split("|")) for x in r] == [50, 50, 20] and r[0].request.startswith("T 000|T 001|")
    assert R.file_requests(d, "t").orderBy("chunk").first().request.startswith("File:T_000|File:T_001")
    q = R.name_requests(spark.createDataFrame([('Aa "b"',), ("Cc dd",)], "t string"), "t", {"code": "P3444"}).first().request
    assert q == 'SELECT ?item ?name ?code WHERE { VALUES ?name { "Aa \\"b\\"" "Cc dd" } ?item wdt:P225 ?name . OPTIONAL { ?item wdt:P3444 ?code . } }'
    assert R.title_requests(d.where("false"), "t").count() == 0


def test_batch_answers(spark):
    def table(*docs):
        return spark.createDataFrame([(x if isinstance(x, str) or x is None else json.dumps(x),) for x in docs], "a string")

    b = {"results": {"bindings": [{"item": {"value": "http://e/Q1"}, "label": {"value": "Regen", "xml:lang": "de"}, "image": {"value": "http://f/My%20Rain.jpg"}}, {"item": {"value": "http://e/Q1"}, "label": {"value": "regn", "xml:lang": "nb"}}]}}
    labels, images = A.item_labels(table(b, "{broken", None), "a")
    assert {tuple(r) for r in labels.collect()} == {("Q1", "de", "Regen"), ("Q1", "no", "regn")} and [tuple(r) for r in images.collect()] == [("Q1", "My Rain.jpg")]
    one = {"query": {"normalized": [{"from": "a_b", "to": "a b"}], "redirects": [{"from": "a b", "to": "C"}], "pages": {"7": {"pageid": 7, "title": "C", "langlinks": [{"lang": "de", "url": "u"}]}, "-1": {"title": "x", "missing": ""}}}}
    more = {"query": {"pages": {"7": {"pageid": 7, "title": "C", "extract": "text", "langlinks": [{"lang": "fr", "url": "v"}]}}}}
    n, r, p = A.page_tables(table(one, more, "?"), "a")
    assert [tuple(x) for x in n.collect()] == [("a_b", "a b")] and [tuple(x) for x in r.collect()] == [("a b", "C")]
    got = p.collect()
    assert len(got) == 1 and (got[0].title, got[0].page_id, got[0].extract, got[0].urls) == ("C", 7, "text", {"de": "u", "fr": "v"})
    lic = lambda name, short, artist: {"title": f"File:{name}", "imageinfo": [{"extmetadata": {"LicenseShortName": {"value": short}, "Artist": {"value": artist}}}]}
    f = A.file_licences(table({"query": {"pages": {"1": lic("A b.jpg", "CC BY 4.0", "<a>Ann</a> "), "2": lic("c.jpg", "Fair use", "x"), "3": {"title": "File:d.jpg"}}}}), "a")
    assert [(x.file, x.attribution, x.license) for x in f.collect()] == [("A_b.jpg", "Ann", "CC BY 4.0")] and f.first().url.endswith("/A_b.jpg")
    csv = 'SCIENTIFIC_NAME,COMMON_NAME,SPECIES_CODE\r\nParus major,"Tit, Great ""x""",gretit\r\nNo code,Name,\r\n'
    assert [tuple(x) for x in one_of(spark, A.taxonomy_names("v0"), csv)] == [("gretit", 'Tit, Great "x"')] and one_of(spark, A.taxonomy_names("v0"), "") == []
    assert one_of(spark, A.first_title("v0"), '{"query": {"search": [{"title": "Owl"}]}}') == "Owl" and one_of(spark, A.first_title("v0"), '{"query": {"search": []}}') is None


one_of = one


def test_tasks(spark):
    from taxaloom.functions import tasks

    rows = [{"name": "A", "locales": ["de", "fr"], "texts": {"en": "x"}}]
    assert json.loads(tasks.request("translate", rows).splitlines()[-1]) == {"name": "A", "languages": ["de", "fr"], "texts": {"en": "x"}}
    assert tasks.read('```\n{"A": {"de": " ja ", "pl": "no", "fr": ""}, "B": {"de": "x"},}\n```', rows) == [("A", "de", "ja")] and tasks.read(None, rows) == [] and tasks.read('{"A": "x"}', rows) == []

    def send(text):
        asked = [json.loads(x) for x in text.splitlines()[2:]]
        if any(r["name"] == "bad" for r in asked):
            raise OSError
        return json.dumps({r["name"]: {x: r["texts"]["en"].upper() for x in r["languages"]} for r in asked})

    d = spark.createDataFrame([("A", ["de"], {"en": "a"}, 0), ("B", ["de", "fr"], {"en": "b"}, 0), ("bad", ["de"], {"en": "c"}, 1), ("D", ["de"], {"en": "d"}, None)], "scientific_name string, locales array<string>, texts map<string,string>, batch int")
    assert {tuple(r) for r in tasks.run(d, "translate", send).collect()} == {("A", "de", "A"), ("B", "de", "B"), ("B", "fr", "B")}
    assert tasks.run(d.where("false"), "shorten", send).count() == 0
