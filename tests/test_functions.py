import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taxaloom.functions import maps, providers
from taxaloom.functions import passages as P
from taxaloom.functions import text as T
from taxaloom.functions import udf as U


def values(spark, rows, expr, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema).select(expr).collect()]


def test_names(spark):
    rows = ["Turdus merula", " Turdus merula ", "Turdus", "turdus merula", "Turdus merula nigra", "T m", "Turdus (x) merula", None, ""]
    assert values(spark, rows, T.is_binomial("x")) == [True, True, False, False, False, False, False, False, False]
    assert values(spark, ["Owl", "A  b", "x/y", " ", None, "tab\tx"], T.is_clean_common_name("x")) == [True, False, False, False, False, True]


def count_words(t):
    return len(re.findall(r"\b[\w'-]+\b", t)) + len(re.findall("[㐀-䶿一-鿿぀-ヿ가-힯]", t))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab '-_ éжß中ひ한9.,", max_size=20), min_size=1, max_size=30))
def test_word_count_as_in_python(spark, texts):
    assert values(spark, texts, T.word_count("x")) == [count_words(t) for t in texts]


def test_strip_and_space(spark):
    assert values(spark, ["  a\t", None, " x \n y "], T.strip("x")) == ["a", None, "x \n y"]
    assert values(spark, ["  a\t", None, " x \n y "], T.normalize_space("x")) == ["a", "", "x y"]


def test_html_and_codes(spark):
    html = """<meta property="og:description" content="A bird"><meta content='u' property='og:image'>"""
    assert values(spark, [html, "<p>"], T.meta_tag("x", "description")) == ["A bird", None]
    assert values(spark, [html], T.meta_tag("x", "image")) == ["u"]
    assert values(spark, ["https://c/asset/123/640", "https://c"], T.asset_id("x")) == ["123", None]
    assert values(spark, ["https://c/asset/123/640"], T.asset_url("x")) == ["https://c/asset/123/1800"]
    assert values(spark, ["virrai2", "virrai", "abc1", "x12"], T.code_variants("x")) == [["virrai2", "virrai1", "virrai"], ["virrai"], ["abc1", "abc"], ["x12", "x1", "x"]]
    assert values(spark, ["<b>x &amp; y</b>", None], U.decode_entities("x")) == ["x & y", None]


def test_addresses(spark):
    from urllib.parse import quote

    rows = ["a b~c*d+é", "plain", "%"]
    assert values(spark, rows, T.url_quote("x")) == [quote(r, safe="") for r in rows]
    assert values(spark, ["https://en.w/wiki/A_b%C3%A9?x", "https://en.w/"], T.page_title("x")) == ["A bé", None]
    assert values(spark, ["nb", "pt-BR", "zh_CN", "en"], T.normalize_locale("x")) == ["no", "pt", "zh-cn", "en"]
    assert values(spark, [7, 123456], T.record_id("x"), "x int") == ["BN00007", "BN123456"]


def test_authors(spark):
    rows = [("(c) Ann Lee, some rights reserved (CC BY-NC)", "inat"), ("Owl - Bo Ek / Macaulay Library ML1", "ebird"), ("(c) x, uploaded by Cy Do", "inat"), ("Di <b>🐦 [w]", "wiki"), (None, "inat"), ("", None)]
    assert values(spark, rows, T.image_author("x", "s"), "x string, s string") == ["Ann Lee", "Bo Ek", "Cy Do", "Di b", "", ""]


def test_folding_keeps_letters_without_marks(spark):
    assert values(spark, ["Élan", "й", "ß", "İ", None], U.normalise("x")) == ["elan", "и", "ß", "i", ""]


def test_descriptions(spark):
    para = "word " * 50
    text = f"{para}\n\n{para}\n\nReferences\n\nx"
    chosen = lambda *a: values(spark, [text, "", None, "References", "Referencesx y"], P.selected_description("x", *a))
    assert [count_words(t) for t in chosen(40, 45)] == [50, 0, 0, 0, 2]
    assert [count_words(t) for t in chosen(40, 80)] == [100, 0, 0, 0, 2]
    # Fewer paragraphs than asked for, of more than twice the words: leading sentences until there are enough.
    assert values(spark, ["A b c. D e f! G h i? J.\r\rsee also"], P.selected_description("x", 1, 4, 2, 2)) == ["A b c. D e f!"]
    assert values(spark, ["A b c. D e f! G h i."], P.selected_description("x", 1, 5, 2, 2)) == ["A b c. D e f! G h i."]


def test_ended_texts(spark):
    rows = ["One two. Three four five", "abcdefghijkl mnop", "abcdefghijklmnopq", " short ", None, "A! bcdefgh. ijklmnop", "Né. 😀😀 aa bb cc dd"]
    assert values(spark, rows, P.ended_at_sentence("x", 12)) == ["One two.", "abcdefghijkl", "abcdefghijkl", "short", "", "A! bcdefgh.", "Né. 😀😀 aa"]
    assert values(spark, ["x" * 9], P.ended_at_sentence("x", 0)) == ["x" * 9]
    assert values(spark, ["One two three four", "One two. Three four", "aaaaaaaaaaaaaaaa", None, "x"], P.ended_with_ellipsis("x", 12)) == ["One two…", "One two.", "aaaaaaaaaaaa…", "", "x"]


def test_repair():
    assert U.repair_json('```json\n{"a": "b",}\n```') == {"a": "b"}
    assert U.repair_json('x {"a": {"b": "c"} y') == {"a": {"b": "c"}}
    assert U.repair_json('{"a": "b", "c": oops, "d": "e"}') == {"a": "b", "d": "e"}
    assert U.repair_json("nothing") == {} and U.repair_json(None) == {} and U.repair_json("} {") == {}
    assert U.repair_json('{"a": "x, }", "b": [1, 2,],}') == {"a": "x, }", "b": [1, 2]}
    assert U.repair_json('{"a": "q\\"u\\n", "b": oops}') == {"a": 'q"u\n'}


def test_markers():
    assert U.decode_batch(U.encode_batch(["a", "b"]), 2) == ["a", "b"]
    assert U.decode_batch("[[[2]]] a [[[1]]] b", 2) is None and U.decode_batch("[[[1]]] a", 2) is None and U.decode_batch("[[[1]]] ", 1) is None


def test_maps(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    d = spark.createDataFrame([({"a": "1", "b": ""}, {"a": "2", "c": "3"}), (None, {"a": ""})], "x map<string,string>, y map<string,string>")
    assert [r[0] for r in d.select(maps.overlay("x", "y")).collect()] == [{"a": "2", "b": "", "c": "3"}, {}]
    assert [r[0] for r in d.select(maps.fill("x", "y")).collect()] == [{"a": "1", "c": "3"}, {}]
    e = spark.createDataFrame([(["b", " a ", "B", None, "b", ""],), (None,)], "x array<string>")
    assert [r[0] for r in e.select(maps.ordered_distinct("x")).collect()] == [["b", "a", "B"], []]
    assert [r[0] for r in e.select(maps.ordered_distinct_ci("x")).collect()] == [["b", "a"], []]


def test_providers(spark):
    def flaky(texts, options):
        if len(texts) > 1:
            raise RuntimeError
        return None if texts[0] == "bad" else [texts[0].upper()]

    d = spark.createDataFrame([("a",), ("bad",), (None,), ("c",)], "x string").coalesce(1)
    assert [r.result for r in providers.apply(d, "x", flaky, size=3).collect()] == ["A", None, None, "C"]
    assert providers.through_markers(str.upper)(["a", "b"], {}) == ["A", "B"]
    with pytest.raises(KeyError):
        providers.provider("none")
    assert F is not None and U.human_size(2048) == "2.0 KB" and U.human_size(5) == "5 B"
