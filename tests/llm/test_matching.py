import datetime as dt
import itertools
import random

from pyspark.sql import functions as F

from taxaloom.llm import matching as M
from taxaloom.session import checkpoint

REC = "rec_id bigint, scientific_name string, common_name string, common_name_alt string, common_names map<string,string>, scientific_name_aliases array<string>, xc_name string, taxon_group string, received_at timestamp, unit string"
XC = "xc_id bigint, xc_name string, english_name string, local_name string, local_locale string, group_label string, sid string"
T = dt.datetime(2025, 1, 1)


def rec(i, sci, com, group="Aves", names=None, al=None):
    return (i, sci, com, None, names, al, None, group, T, "extra")


def tables(spark):
    r = [
        rec(1, "Parus major", "Great Tit", names={"de": "Kohlmeise"}), rec(2, "Parus major", None), rec(3, "Turdus merula", "Common Blackbird", al=["Merula vulgaris"]),
        rec(4, "Rana bona", "Marsh Frog", "Amphibia"), rec(5, "Pica pica", "Marsh Frog"), rec(6, None, "Nobody"), rec(7, "Bubo alba", "White Owl"),
    ]
    x = [
        (101, "parus_major", "Tit, Great", None, None, "BIRDS", "e"), (102, "Parsu major (L., 1758)", None, "Kohlmeise", "de", "Bird", "e"), (103, "Merula vulgaris", "COMMON BLACKBIRD", None, None, None, "e"),
        (104, "R. bona", "Marsh Frog", None, None, "frogs", "e"), (105, "Novus ignotus", "Great Tit", None, None, "birds", "e"), (106, None, None, None, None, None, "e"), (107, "Bubo albus minor", "Wite Owl", None, None, "birds", "e"),
        (108, "Parus minor", None, None, None, "birds", "e"), (109, "", "", "", "", "", "e"), (101 + 100, "parus_major", "Tit, Great", None, None, "BIRDS", "e"),
    ]
    return spark.createDataFrame(r, REC), spark.createDataFrame(x, XC)


def test_match(spark):
    r, x = tables(spark)
    got = M.match(r, x)
    pairs = {(a.rec_id, a.xc_id) for a in got.collect()}
    assert pairs == {(1, 101), (2, 101), (1, 201), (2, 201), (1, 102), (2, 102), (3, 103), (4, 104), (7, 107)}
    assert got.where("confidence < 0.65 or confidence > 1").count() == 0 and got.count() == len(pairs)


def test_empty(spark):
    r, x = tables(spark)
    assert M.match(r.where("false"), x).count() == 0 and M.match(r, x.where("false")).count() == 0


def test_folding(spark):
    d = spark.createDataFrame([("Ｇｒｅаt  Tit-é​",), ("Owl, Barn",), (None,), ("",)], "n string")
    assert [r[0] for r in d.select(M.english("n")).collect()] == ["great tit e", "barn owl", None, None]
    s = spark.createDataFrame([("PARUS_MAJOR minor (L., 1758)",), ("P. major",)], "n string")
    assert [r[0] for r in s.select(M.scientific("n")).collect()] == ["parus major", "p major"]


def test_auction_takes_the_greatest_total(spark):
    rows = [(1, 10, 0.9), (1, 20, 0.88), (2, 10, 0.95), (3, 20, 0.66), (3, 30, 0.66)]
    d = spark.createDataFrame(rows, "unit bigint, sid bigint, confidence double")
    got = {r.unit: r.sid for r in M.assign(d).where("role = 'assigned'").collect()}
    assert got == {1: 20, 2: 10, 3: 30}


def test_blocking_recall_against_all_pairs(spark, sf):
    r, x = spark.read.parquet(f"{sf}/species_records.parquet"), spark.read.parquet(f"{sf}/xc_species.parquet")
    s, (u, _) = checkpoint(M.species_units(r)), M.listing_units(x)
    u = checkpoint(u)
    every = M.compare(u.select("unit").crossJoin(s.select("sid")), s, u).where(F.col("confidence") >= M.LEAST).select("unit", "sid")
    near = M.compare(M.neighbours(s, u), s, u).where(F.col("confidence") >= M.LEAST).select("unit", "sid")
    want = {tuple(p) for p in every.collect()}
    assert want and len(want & {tuple(p) for p in near.collect()}) >= 0.99 * len(want)


def test_partitions_lose_no_neighbours(spark):
    r, x = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("species_records", "xc_species"))
    s, (u, _) = checkpoint(M.species_units(r)), M.listing_units(x)
    u = checkpoint(u)
    one = {tuple(p) for p in M.neighbours(s, u, buckets=1).collect()}
    assert one and {tuple(p) for p in M.neighbours(s, u, buckets=23).collect()} == one


def test_crowded_keys_are_ordered_by_name(spark, monkeypatch):
    monkeypatch.setattr(M, "CROWD", 10)
    names = [f"{g}us {e}us" for g in ("Ab", "Cd", "Ef", "Gh") for e in ("alb", "bor", "col", "dun", "erg")]
    s = checkpoint(M.species_units(spark.createDataFrame([rec(i, n, "Marsh Owl") for i, n in enumerate(names)], REC)))
    u = checkpoint(M.listing_units(spark.createDataFrame([(100 + i, n, "Marsh Owl", None, None, None, "e") for i, n in enumerate(names)], XC))[0])
    got = {tuple(p) for p in M.neighbours(s, u, window=1).collect()}
    assert {(100 + i, i) for i in range(20)} <= got and len(got) < 400


def test_classes_and_members(spark):
    r = spark.createDataFrame([rec(1, "Parus major", "Great Tit"), rec(2, "Parus major", "Great Tit"), rec(3, None, "x")], REC)
    x = spark.createDataFrame([(10, "Parus major", "Great Tit", None, None, "birds", "e"), (11, "Parus major", "Great Tit", None, None, "birds", "e")], XC)
    a, _ = M.match_classes(r, x)
    assert [(c.sid, c.unit) for c in a.collect()] == [(1, 10)]
    assert {tuple(m) for m in M.members(r, x).collect()} == {("record", 1, 1), ("record", 2, 1), ("listing", 10, 10), ("listing", 11, 10)}
    assert {(p.rec_id, p.xc_id) for p in M.match(r, x).collect()} == {(1, 10), (1, 11), (2, 10), (2, 11)}


def test_binomials_are_left_out_only_where_hopeless(spark):
    d = checkpoint(M.species_units(spark.createDataFrame([rec(1, "Parus major", "Great Tit"), rec(2, "Parus minor", "Small Tit"), rec(3, "Zus novus", None)], REC)))
    x = [("Parus major", "Other name"), ("Parus maior", "Great Tit"), ("Parus maior", "Other name"), ("Zus nova", "Any"), ("Parus minor", None), (None, "Small Tit")]
    u = checkpoint(M.listing_units(spark.createDataFrame([(10 + i, a, b, None, None, None, "e") for i, (a, b) in enumerate(x)], XC))[0])
    every = u.select("unit").crossJoin(d.select("sid"))
    full = {(r.unit, r.sid): r.confidence for r in M.compare(every, d, u, least=0).collect()}
    got = {(r.unit, r.sid): r.confidence for r in M.compare(every, d, u).collect()}
    assert {p: c for p, c in full.items() if c >= M.LEAST} == {p: c for p, c in got.items() if c >= M.LEAST} and len(full) == 18


WAR = [(1, 10, 0.9), (1, 20, 0.9), (2, 10, 0.9), (2, 20, 0.9), (3, 10, 0.9), (3, 20, 0.9), (3, 30, 0.66)]


def test_price_wars_are_fought_to_their_end(spark, monkeypatch):
    d = spark.createDataFrame(WAR, "unit bigint, sid bigint, confidence double")

    def assigned(**k):
        return {r.unit: r.sid for r in M.assign(d, **k).where("role = 'assigned'").collect()}

    got = assigned()
    assert got[3] == 30 and sorted(got) == [1, 2, 3] and sorted(got.values()) == [10, 20, 30]
    monkeypatch.setattr(M, "MOST_COMPONENT", 0)
    got = assigned(eps=0.02)
    assert got[3] == 30 and sorted(got) == [1, 2, 3] and sorted(got.values()) == [10, 20, 30]


def test_displacement_chain(spark):
    n = 40
    rows = [(i, i + 100, 0.9) for i in range(n)] + [(i, i + 101, 0.88) for i in range(n)] + [(n, 100, 0.95)]
    d = spark.createDataFrame(rows, "unit bigint, sid bigint, confidence double")
    got = {r.unit: r.sid for r in M.assign(d).where("role = 'assigned'").collect()}
    assert got == {**{i: i + 101 for i in range(n)}, n: 100}


def test_greatest_total_by_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        units, sids = range(rng.randint(1, 5)), range(rng.randint(1, 4))
        w = {(u, s): rng.choice([65, 66, 80, 90, 90, 95, 100]) for u in units for s in sids if rng.random() < 0.7}
        got = M.greatest_total([(u, s, x) for (u, s), x in w.items()])
        assert len(set(got.values())) == len(got) and all(p in w for p in got.items())
        want = max(sum(w[u, s] for u, s in enumerate(p) if s is not None and (u, s) in w) for p in itertools.permutations([*sids, *[None] * len(units)], len(units)))
        assert sum(w[p] for p in got.items()) == want


def test_components(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (300, 301)]
    random.Random(2).shuffle(pairs)
    got = {r.node: r.root for r in M.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 150: 100, 200: 100, 300: 300, 301: 300}


def test_crowded_keys_lose_no_pairs(spark):
    s = M.species_units(spark.createDataFrame([rec(i, f"{g}us ruficauda", "Marsh Owl") for i, g in enumerate("ABCDEFGHIJKLMNOPQRST", 1)] + [rec(30, "Zonus unicus", "Reed Hen")], REC))
    x = [(100 + i, f"Xenus strange{i}us", "Reed Hen", None, None, "birds", "e") for i in range(30)]
    x += [(200, "S. ruficauda", None, None, None, None, "e"), (201, "Nix nox", "Owl, Marsh", None, None, None, "e")]
    x += [(300 + i, None, f"Reed Hem{chr(97 + i)}", None, None, None, "e") for i in range(20)]
    u, _ = M.listing_units(spark.createDataFrame(x, XC))
    got = {tuple(p) for p in M.neighbours(checkpoint(s), checkpoint(u)).collect()}
    assert {(100 + i, 30) for i in range(30)} | {(300 + i, 30) for i in range(20)} <= got
    assert {(200, i) for i in range(1, 21)} | {(201, i) for i in range(1, 21)} <= got


def test_window_over_species_keys_by_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abc") for _ in range(4))
    english = [word() for _ in range(60)]
    s = checkpoint(M.species_units(spark.createDataFrame([rec(i, f"G{i}", e) for i, e in enumerate(english)], REC)))
    listed = [word() for _ in range(90)]
    u = checkpoint(M.listing_units(spark.createDataFrame([(1000 + i, None, e, None, None, None, "e") for i, e in enumerate(listed)], XC))[0])
    first = {e: 1000 + listed.index(e) for e in listed}
    want = set()
    for turn in (lambda w: w, lambda w: w[::-1]):
        places = sorted({turn(e) for e in english})
        for e, unit in first.items():
            k = turn(e)
            near = {*[p for p in places if p <= k][-4:], *[p for p in places if p >= k][:4]}
            want |= {(unit, i) for i, x in enumerate(english) if turn(x) in near}
    assert {tuple(p) for p in M.neighbours(s, u, window=3, buckets=1).collect()} == want
    assert {tuple(p) for p in M.neighbours(s, u, window=3, buckets=2).collect()} == want
