import numpy as np

from taxaloom.llm import langid

TEXTS = {
    "en": "The birds live in small groups near the river and eat seeds.", "de": "Die Vögel leben in kleinen Gruppen am Fluss und fressen Samen.",
    "fr": "Les oiseaux vivent en petits groupes près de la rivière et mangent des graines.", "es": "Las aves viven en pequeños grupos cerca del río y comen semillas.",
    "ru": "Птицы живут небольшими группами у реки и питаются семенами.", "ja": "この鳥は川の近くで小さな群れを作り、種子を食べる。", "pl": "Ptaki żyją w niewielkich grupach w pobliżu rzeki i żywią się nasionami.",
}


def test_held_out_accuracy():
    from taxaloom.llm.common import load_model

    assert load_model("langid.json")["accuracy"] > 0.98


def test_texts_of_no_template():
    got = {k: [s[2] for s in langid.judge([t])[0]] for k, t in TEXTS.items()}
    assert sum(v == [k] for k, v in got.items()) >= 6, got


def test_what_is_in_no_language():
    got = langid.judge(["Help » Home » Contact » Species » Home » Help » Print » Share » Contact", "xq;zkw vbnt qpl;r wxzt kjq bvc mnbw", "Size | Weight | Wings\nKolberg | 117 | 33.9"])
    assert all(s[2] is None for t in got for s in t), got


def test_short_segments_are_judged(spark):
    assert [len(langid.segments(t)[0][2].split()) for t in ("Le loup.", "Kleiner Vogel.")] == [2, 2]
    assert len(langid.judge(["Le loup. Kleiner Vogel. A fox."])[0]) == 3
    d = spark.createDataFrame([(1, "en", "The bird eats seeds. Les oiseaux mangent des graines. The bird is small.")], "rec_id bigint, locale string, text string")
    assert [r.lang for r in langid.other_languages(d, ["rec_id", "locale"]).collect()] == ["fr"]


def test_segments_and_windows():
    s = langid.segments("One is here in the woods. “Zwei sind da drüben im Wald.” Three are over there by the river (vier).")
    assert len(s) == 2 and "zwei" not in s[0][2] and "vier" not in s[1][2]
    assert langid.segments(None) == [] and langid.segments("12 34. 5!") == []
    w = langid.windows("word " * 1000)
    assert all(len(x) <= langid.WINDOW for x in w) and b"".join(x[: langid.STRIDE] for x in w[:-1]) + w[-1] == b" " + b"word " * 1000 + b" "
    m = langid.to_matrix([b"abc", b""])
    assert m.shape == (2, langid.WINDOW) and m[0, 3:].sum() == 0
    s = langid.net().scores(np.zeros((3, langid.WINDOW), np.uint8))
    assert s.shape == (3, len(langid.LANGS) + 1) and np.allclose(langid.softmax(s).sum(1), 1)


def test_other_languages(spark):
    mixed = TEXTS["en"] + " " + TEXTS["ru"] + " " + TEXTS["en"]
    rows = [(1, "en", TEXTS["en"]), (2, "de", TEXTS["ru"]), (3, "und", TEXTS["fr"]), (4, "en-gb", TEXTS["en"]), (5, "en", mixed), (6, "en", None), (7, "en", ""), (8, "xx", "12"), (5, "en", mixed)]
    d = spark.createDataFrame(rows, "rec_id bigint, locale string, text string")
    got = langid.other_languages(d, ["rec_id", "locale"])
    assert {(r.rec_id, r.lang) for r in got.collect()} == {(2, "ru"), (3, "fr"), (5, "ru")} and got.count() == 4
    assert langid.other_languages(d.where("false"), ["rec_id", "locale"]).count() == 0
    top = {r.rec_id: r.lang for r in langid.document_languages(d.dropDuplicates(), ["rec_id"]).collect()}
    assert top[5] == "en" and top[2] == "ru" and top[6] is None and top[8] is None


def test_long_text_is_read_to_its_end(spark):
    d = spark.createDataFrame([(1, "en", (TEXTS["en"] + " ") * 1500 + TEXTS["ru"], "extra")], "rec_id bigint, locale string, text string, segments string")
    assert [r.lang for r in langid.other_languages(d, ["rec_id"]).collect()] == ["ru"]
