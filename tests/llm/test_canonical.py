import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from taxaloom.llm import canonical

SCHEMA = "key bigint, scientific_name string, locale string, name string"


def forms(spark, names):
    d = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    return [r.form for r in canonical.with_form(d, "name", "form").orderBy("i").collect()]


def test_forms(spark):
    same = ["Öl Wren", "Öl Wren", "Öl Wren", "Ö​l W­ren", "Ｏ̈ｌ Ｗｒｅｎ", "Öl  Wren ", "Öl Wrеn"]
    assert set(forms(spark, same)) == {"Öl Wren"}
    assert forms(spark, ["ｶﾞｴﾙ", "ガエル", "ガエル"]) == ["ガエル"] * 3
    assert forms(spark, ["Ёж", "Еж", "ﬂügel", "a‑b", "a–b", None, "", "​"]) == ["Ëж", "Eж", "flügel", "a-b", "a–b", None, "", ""]


def test_all_compatibility_forms(spark):
    assert forms(spark, ["Ⅳ", "x⁴⁵ₓ", "5㎏", "ﬁnch", "Ｆｉｎｃｈ…", "ﷺ"[:1], "Ꮃren", "Օwl", "½", "한"]) == ["IV", "x45x", "5kg", "finch", "Finch...", unicodedata.normalize("NFKC", "ﷺ"), "Wren", "Owl", unicodedata.normalize("NFKC", "½"), "한"]
    rest = [chr(o) for o in range(0xA1, 0x30000) if unicodedata.category(chr(o))[0] not in "ZC" and unicodedata.normalize("NFKC", chr(o)) != chr(o)]
    got = forms(spark, rest)
    want = [unicodedata.normalize("NFC", " ".join("".join(canonical.LOOKALIKES.get(c, c) for c in unicodedata.normalize("NFKC", x)).split())) for x in rest]
    wrong = [(x, g, w) for x, g, w in zip(rest, got, want) if g != w and not unicodedata.normalize("NFKC", x).startswith((" ", "\u3099", "\u309a")) and x not in canonical.LOOKALIKES]
    assert len(wrong) < 10, wrong[:20]


def test_classes(spark):
    rows = [(3, "S s", "en", "Owl"), (1, "S s", "en", "Оwl"), (2, "S s", "en", "Owl"), (4, "S s", "de", "Owl"), (5, "S s", "en", "owl"), (6, "S s", "en", None)]
    assert sorted(map(tuple, canonical.same_look_classes(spark.createDataFrame(rows, SCHEMA)).collect())) == [(1, 1, "Оwl"), (1, 2, "Owl"), (1, 3, "Owl")]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abAé é и й е́ о‍ｶ ﾞ’'x", max_size=12), min_size=1, max_size=20))
def test_idempotent_and_composed(spark, names):
    once = forms(spark, names)
    assert forms(spark, once) == once
    assert all(unicodedata.is_normalized("NFC", f) for f in once)


def brute(rows):
    from taxaloom.llm.canonical import LOOKALIKES

    def form(s):
        s = "".join(c for c in unicodedata.normalize("NFKC", s) if unicodedata.category(c) != "Cf" and not 0xFE00 <= ord(c) <= 0xFE0F)
        return unicodedata.normalize("NFC", " ".join("".join(LOOKALIKES.get(c, c) for c in s).split()))

    return {(min(a[0], b[0]), max(a[0], b[0])) for a in rows for b in rows if a[0] < b[0] and None not in a and None not in b and a[1:3] == b[1:3] and a[3] != b[3] and form(a[3]) == form(b[3]) != ""}


def test_pairs_as_by_brute_force(spark, sf):
    rows = [(r.name_id, r.scientific_name, r.locale, r.common_name) for r in spark.read.parquet(f"{sf}/name_rows.parquet").collect()]
    d = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert {tuple(r) for r in canonical.same_look_pairs(d).collect()} == want and want


def test_hot_group_ties_nulls_and_empty(spark):
    rows = [(i, "S s", "en", "Owl" if i % 2 else "Оwl") for i in range(60)] + [(100, None, "en", "Owl"), (101, "S s", None, "Owl"), (102, "S s", "en", None), (103, "S s", "en", ""), (104, "S s", "en", "owl")]
    d = spark.createDataFrame(rows, SCHEMA)
    got = canonical.same_look_pairs(d)
    assert got.count() == 900 and got.where("key_a >= key_b").count() == 0
    assert canonical.same_look_pairs(d.where("false")).count() == 0


def test_extra_columns(spark):
    d = spark.createDataFrame([("Оwl", "x", 1.5, None)], "name string, form string, batch double, `select` string")
    r = canonical.with_form(d, "name", "form").first()
    assert r.form == "Owl" and r.batch == 1.5 and r["select"] is None
    assert forms(spark, ["Ａ" * 100_000]) == ["A" * 100_000]
