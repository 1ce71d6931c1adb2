"""Match records of two sources that share no identifier, by sorted neighbourhood.

Both sides are reduced to distinct units (species by scientific name, listings by their folded
names). Each unit is put under several composite sort keys (epithet and genus, genus and epithet,
English name forwards and backwards, local name by language, aliases as further names); in the
sorted order a sliding window over the distinct species keys brings each listing together with the
species around it, whatever number of rows a key has, and equal epithet stems are joined. Where more than
CROWD species share a key or a stem, the order within it goes by scientific name and the window
slides over that. Pairs are compared field by field, with a weighted mean as confidence, and listings and
species are assigned one to one so that the total confidence is greatest (`assign`). A listing that repeats an
assigned one (its best species is taken by a listing that fits it as well) follows it.

The sorted order is global: keys are range-partitioned, and each has its exact place among all species keys,
so that no neighbour is lost between partitions, at any size. A window is a join on places; no group is
held in memory.

Defined results: null or empty fields don't count in the mean; units without any name pair with
nothing; redelivered rows of either side all get their pair; empty tables give no pairs.
"""

from __future__ import annotations

import heapq
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from taxaloom.llm.canonical import LOOKALIKES, compatibility
from taxaloom.llm.common import checkpoint

WINDOW = 12
#: Species that may share a key before their scientific names order them within it.
CROWD = 64
LEAST = 0.65
#: Edges up to which a component of competing listings and species is solved in one task.
MOST_COMPONENT = 20_000
#: English names of a species: its common name, the other one, and that of its map.
ENGLISH = 3
#: Weights of the fields in the confidence.
WEIGHTS = {"sci": 3.0, "eng": 2.5, "loc": 2.0, "grp": 0.5}

#: Group labels of the listing source, by their letters, and the taxon groups they mean.
GROUPS = {
    "bird": "Aves", "birds": "Aves", "aves": "Aves", "insects": "Insecta", "insect": "Insecta", "grasshoppers": "Insecta", "orthopterasl": "Insecta", "orthoptera": "Insecta",
    "bats": "Mammalia", "bat": "Mammalia", "mammal": "Mammalia", "mammals": "Mammalia", "landmammals": "Mammalia", "frogs": "Amphibia", "amphibians": "Amphibia", "amphibian": "Amphibia", "reptiles": "Reptilia", "reptile": "Reptilia",
}


def _fold_table() -> tuple[str, str]:
    """Look-alikes, compatibility forms and accented Latin letters, each to one plain letter."""
    out = {**compatibility(), **LOOKALIKES}
    for o in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(o))[0]
        if base != chr(o):
            out[chr(o)] = base
    for k, v in list(out.items()):
        out[k] = unicodedata.normalize("NFD", out.get(v, v))[0]
    return "".join(out), "".join(out.values())


_FROM, _TO = _fold_table()


def fold(c) -> Column:
    """Lower case letters and digits of a text with single blanks, accents and look-alikes taken away."""
    c = F.col(c) if isinstance(c, str) else c
    x = F.regexp_replace(c, r"[\p{Cf}\x{FE00}-\x{FE0F}]", "")
    x = F.regexp_replace(F.translate(x, _FROM, _TO), r"\p{M}", "")
    x = F.regexp_replace(F.replace(F.lower(x), F.lit("ß"), F.lit("ss")), r"[^\p{L}\p{N}]+", " ")
    return F.nullif(F.trim(x), F.lit(""))


def english(c: str) -> Column:
    """A folded English name, an inverted one ("Owl, Barn") turned round."""
    c = F.regexp_replace(F.col(c), r"^\s*([^,]+),\s*([^,]+)$", "$2 $1")
    return fold(c)


def scientific(c) -> Column:
    """Folded genus and epithet: authority, brackets and infraspecific names left out."""
    c = F.col(c) if isinstance(c, str) else c
    x = fold(F.regexp_replace(F.regexp_replace(c, r"\([^)]*\)?|,.*$", " "), "_", " "))
    return F.nullif(F.concat_ws(" ", F.slice(F.split(x, " "), 1, 2)), F.lit(""))


def stem(c: Column) -> Column:
    """An epithet without its gender ending."""
    return F.regexp_replace(c, r"(?<=...)(?:ensis|ensisi|ense|us|um|is|ei|a|e|i)$", "")


def _close(a: Column, b: Column, most: int, share: float) -> Column:
    """1 for equal, a little less for each edit, 0 beyond `most` edits or `share` of the length."""
    d = F.levenshtein(a, b, most)
    longest = F.greatest(F.length(a), F.length(b))
    # Edits are never fewer than the lengths differ by, so that most pairs need no comparison.
    far = F.abs(F.length(a) - F.length(b)) > F.least(F.lit(float(most)), share * longest)
    return F.when(a.isNull() | b.isNull(), None).when(far, 0.0).when((d >= 0) & (d <= share * longest), 1 - 0.05 * d).otherwise(0.0)


def _parts(x: Column) -> Column:
    """struct(full, genus, epithet, stem) of a folded binomial."""
    words = F.split(x, " ")
    epithet = F.get(words, 1)
    return F.when(x.isNotNull(), F.struct(x.alias("full"), F.element_at(words, 1).alias("genus"), epithet.alias("epithet"), stem(epithet).alias("stem")))


def _name_similarity(x: Column, s: Column) -> Column:
    """Similarity of two binomials (as `_parts`); an abbreviated genus says almost nothing by itself."""
    epithet = F.greatest(_close(x["stem"], s["stem"], 2, 0.26), _close(x["epithet"], s["epithet"], 2, 0.26))
    short = (F.length(x["genus"]) == 1) & (F.substring(s["genus"], 1, 1) == x["genus"])
    genus = F.when(short, 0.05).otherwise(_close(x["genus"], s["genus"], 2, 0.34))
    mean = 0.55 * F.coalesce(epithet, F.lit(0.0)) + 0.45 * F.coalesce(genus, F.lit(0.0))
    return F.when(x.isNull() | s.isNull(), None).when(x["full"] == s["full"], 1.0).otherwise(mean)


def species_of(records: DataFrame) -> DataFrame:
    return records.where(F.col("scientific_name").isNotNull() & (F.trim("scientific_name") != ""))


def species_units(records: DataFrame) -> DataFrame:
    """One row per scientific name: names, aliases, English and local names of its latest filled row."""
    d = species_of(records)
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("received_at", "rec_id"))).alias(c)
    g = d.groupBy("scientific_name").agg(*[latest(c) for c in ("common_name", "common_name_alt", "common_names", "scientific_name_aliases", "xc_name", "taxon_group")], F.min("rec_id").alias("sid"))
    names = F.array_distinct(
        F.filter(
            F.concat(F.array(scientific("scientific_name"), scientific("xc_name")), F.coalesce(F.transform("scientific_name_aliases", scientific), F.array().cast("array<string>"))),
            lambda x: x.isNotNull(),
        )
    )
    own = F.array_distinct(F.filter(F.array(english("common_name"), english("common_name_alt"), fold(F.element_at("common_names", F.lit("en")))), lambda x: x.isNotNull()))
    local = F.transform(F.map_entries("common_names"), lambda e: F.struct(e["key"].alias("locale"), fold(e["value"]).alias("name")))
    return g.select("sid", "scientific_name", names.alias("names"), F.transform(names, _parts).alias("binomials"), own.alias("english"), F.coalesce(local, F.array().cast("array<struct<locale:string,name:string>>")).alias("local"), F.col("taxon_group").alias("grp"))


def listing_units(listings: DataFrame, materialise=None) -> tuple[DataFrame, DataFrame]:
    """(units, xc_id -> unit): distinct folded listings, named by their least id, and the rows that share each."""
    pairs = F.create_map(*[F.lit(x) for kv in GROUPS.items() for x in kv])
    d = listings.select(
        "xc_id", scientific("xc_name").alias("x"), english("english_name").alias("e"),
        F.when(fold("local_name").isNotNull(), F.col("local_locale")).alias("ll"), fold("local_name").alias("l"),
        pairs[F.regexp_replace(F.lower("group_label"), "[^a-z]", "")].alias("grp"),
    )
    d = d.withColumn("_h", F.sha2(F.to_json(F.struct("x", "e", "ll", "l", "grp")), 256)).where("x is not null or e is not null or l is not null")
    if materialise:
        d = materialise(d)
    units = d.groupBy("_h").agg(F.min("xc_id").alias("unit"), *[F.first(c).alias(c) for c in ("x", "e", "ll", "l", "grp")])
    units = units.withColumn("binomial", _parts(F.col("x")))
    return units.drop("_h"), d.select("xc_id", "_h").join(units.select("_h", "unit"), "_h").select("xc_id", "unit")


def _keys(x: Column, e: Column) -> list[Column]:
    xs = F.split(x, " ")
    return [
        F.concat(F.lit("1"), stem(F.get(xs, 1)), F.lit(" "), F.element_at(xs, 1)),
        F.concat(F.lit("2"), x),
        F.concat(F.lit("3"), e),
        F.concat(F.lit("4"), F.reverse(e)),
    ]


def places(s: DataFrame, x: DataFrame, parts: int, keep) -> DataFrame:
    """(k, is_s, is_x, place): all keys, each with the number of distinct species keys up to it.

    s and x hold the keys of species and of listings in k. Keys are range-partitioned and counted in their
    partition; the sums of the partitions before (one number a partition) are added.
    """
    d = s.select("k", F.lit(1).alias("is_s"), F.lit(0).alias("is_x")).unionByName(x.select("k", F.lit(0).alias("is_s"), F.lit(1).alias("is_x")))
    d = d.groupBy("k").agg(F.max("is_s").alias("is_s"), F.max("is_x").alias("is_x"))
    d = keep(d.repartitionByRange(parts, "k").withColumn("_p", F.spark_partition_id()))
    before = d.groupBy("_p").agg(F.sum("is_s").alias("_n")).withColumn("_before", F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)))
    up_to = F.sum("is_s").over(Window.partitionBy("_p").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("_in", up_to).join(F.broadcast(before.select("_p", F.coalesce("_before", F.lit(0)).alias("_before"))), "_p")
    return d.select("k", "is_s", "is_x", (F.col("_in") + F.col("_before")).cast("bigint").alias("place"))


def neighbours(species: DataFrame, listings: DataFrame, window: int = WINDOW, buckets: int | None = None, materialise=None) -> DataFrame:
    """(unit, sid): pairs whose keys are equal or stand within `window` species keys of each other, and pairs of one epithet stem.

    The window slides over distinct species keys: however many rows share a key, it is one place, and
    listings take none. Of a key that more than CROWD species share, each species' is a place of its own.
    """
    keep = materialise or checkpoint
    sk = F.concat(
        F.flatten(F.transform("names", lambda n: F.array(*_keys(n, F.lit(None).cast("string"))[:2]))),
        F.flatten(F.transform("english", lambda e: F.array(*_keys(F.lit(None).cast("string"), e)[2:]))),
        F.transform("local", lambda p: F.concat(F.lit("5"), p["locale"], F.lit(" "), p["name"])),
    )
    s = species.select("sid", F.get("names", F.lit(0)).alias("_sci"), F.explode(F.array_distinct(sk)).alias("k")).where("k is not null")
    xk = F.array(*_keys(F.col("x"), F.col("e")), F.concat(F.lit("5"), F.col("ll"), F.lit(" "), F.col("l")))
    x = listings.select("unit", F.col("x").alias("_sci"), F.explode(xk).alias("k")).where("k is not null")
    crowded = s.groupBy("k").agg(F.count("*").alias("_n")).where(F.col("_n") > CROWD).select("k", F.lit(True).alias("_crowded"))
    own = F.when(F.col("_crowded"), F.concat_ws("\t", "k", "_sci")).otherwise(F.col("k"))
    s, x = (d.join(crowded, "k", "left").withColumn("k", own).drop("_crowded", "_sci") for d in (s, x))
    spark = species.sparkSession
    ranked = places(s, x, buckets or max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))), keep)
    kind = F.substring("k", 1, 1).alias("kind")
    sp = s.join(ranked.where("is_s = 1"), "k").select(kind, "place", "sid")
    around = F.sequence(F.col("place") - window, F.col("place") + window + 1 - F.col("is_s"))
    near = x.join(ranked.where("is_x = 1"), "k").select("unit", kind, F.explode(around).alias("place")).join(sp, ["kind", "place"]).select("unit", "sid")
    # An epithet may be shared by more species than a window holds, and an abbreviated genus sorts beside none of them.
    stems = species.select("sid", F.explode(F.array_distinct(F.transform("binomials", lambda b: b["stem"]))).alias("stem")).where("stem is not null")
    few = stems.groupBy("stem").agg(F.count("*").alias("_n")).where(F.col("_n") <= CROWD).select("stem")
    same = listings.select("unit", F.col("binomial.stem").alias("stem")).where("stem is not null").join(stems.join(few, "stem", "left_semi"), "stem").select("unit", "sid")
    return near.unionByName(same).distinct()


def compare(pairs: DataFrame, species: DataFrame, listings: DataFrame, least: float = LEAST) -> DataFrame:
    """The field similarities and the confidence of each pair; binomials only where a confidence of `least` is still possible."""
    # English names (three at most) and local names by locale are looked up, not searched, so that the cheap fields are compiled.
    looked_up = species.withColumnsRenamed({"grp": "sgrp"}).withColumn("_local", F.map_from_entries("local")).drop("local")
    d = pairs.join(listings, "unit").join(looked_up, "sid")
    eng = F.greatest(*[_close(F.col("e"), F.get("english", F.lit(i)), 4, 0.25) for i in range(ENGLISH)])
    loc = _close(F.col("l"), F.element_at("_local", F.col("ll")), 3, 0.2)
    grp = F.when(F.col("grp").isNull() | F.col("sgrp").isNull(), None).otherwise((F.col("grp") == F.col("sgrp")).cast("double"))
    # The cheap fields come first: where an English name differs and no local one agrees, binomials can't reach `least` by themselves.
    d = d.withColumn("_f", F.explode(F.array(F.struct(eng.alias("eng"), loc.alias("loc"), F.expr("array_contains(names, x)").alias("exact")))))
    eng, loc, exact = F.col("_f.eng"), F.col("_f.loc"), F.coalesce("_f.exact", F.lit(False))
    hopeless = (F.coalesce(eng, F.lit(1.0)) == 0) & (F.coalesce(loc, F.lit(0.0)) == 0) & ~exact if (WEIGHTS["sci"] + WEIGHTS["grp"]) / (WEIGHTS["sci"] + WEIGHTS["eng"] + WEIGHTS["grp"]) < least else F.lit(False)
    sci = F.when(hopeless, F.when(F.col("binomial").isNotNull() & (F.size("binomials") > 0), 0.0)).otherwise(F.array_max(F.transform("binomials", lambda n: _name_similarity(F.col("binomial"), n))))
    fields = F.struct(sci.alias("sci"), eng.alias("eng"), loc.alias("loc"), grp.alias("grp"), exact.alias("exact"))
    # Through a generator, so that a filter on the confidence doesn't evaluate the similarities again for each use.
    d = d.select("unit", "sid", F.inline(F.array(fields)))
    top = sum(F.coalesce(F.col(c), F.lit(0.0)) * w for c, w in WEIGHTS.items())
    under = sum(F.when(F.col(c).isNotNull(), w).otherwise(0.0) for c, w in WEIGHTS.items())
    mean = F.when(under > 0, top / under).otherwise(0.0)
    return d.withColumn("confidence", F.round(F.when(F.col("exact"), F.greatest(mean, F.lit(0.82) + 0.05 * mean)).otherwise(mean), 4))


def components(edges: DataFrame, materialise=None) -> DataFrame:
    """(node, root): the least node of the connected component of every node of (a, b) edges between different nodes.

    Alternating large and small stars, which needs rounds by the logarithm of the longest chain; no group is collected.
    """
    keep = materialise or checkpoint
    e = keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while not e.groupBy("u").count().where("count > 1").isEmpty() or not e.join(e.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        e = keep(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        down = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = keep(down.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def greatest_total(edges: list[tuple[int, int, int]]) -> dict[int, int]:
    """unit -> sid of a one-to-one assignment of the greatest total weight (positive whole numbers), by augmenting paths.

    `price` and `gain` are the dual values: gain[unit] + price[sid] is nowhere less than the weight.
    """
    of: dict[int, dict[int, int]] = {}
    for u, s, w in sorted(edges):
        of.setdefault(u, {})[s] = w
    price: dict[int, int] = {}
    gain: dict[int, int] = {}
    holder: dict[int, int] = {}
    held: dict[int, int] = {}
    for r in of:
        gain[r] = max(0, *(w - price.get(s, 0) for s, w in of[r].items()))
        reached: dict[int, int] = {}
        via: dict[int, int] = {}
        rows, heap, i, at, out, s = {r: 0}, [], r, 0, (gain[r], r), None
        while True:
            for x, w in of[i].items():
                if x not in reached:
                    heapq.heappush(heap, (at + gain[i] - w + price.get(x, 0), x, i))
            while heap and heap[0][1] in reached:
                heapq.heappop(heap)
            if not heap or heap[0][0] > out[0]:  # cheapest is that the unit out[1] goes without
                least, s = out[0], held.pop(out[1], None)
                break
            at, s, before = heapq.heappop(heap)
            reached[s], via[s] = at, before
            if s not in holder:
                least = at
                break
            i = holder[s]
            rows[i] = at
            out = min(out, (at + gain[i], i))
        for x, d in reached.items():
            price[x] = price.get(x, 0) + least - d
        for x, d in rows.items():
            gain[x] -= least - d
        while s is not None:
            i = via[s]
            holder[s] = i
            held[i], s = s, held.get(i)
    return held


@F.pandas_udf(ArrayType(StructType().add("unit", "long").add("sid", "long")))
def _solve(units: pd.Series, sids: pd.Series, weights: pd.Series) -> pd.Series:
    return pd.Series([[{"unit": u, "sid": s} for u, s in greatest_total([(int(a), int(b), int(c)) for a, b, c in zip(*z)]).items()] for z in zip(units, sids, weights)])


def _auction(g: DataFrame, eps: float, keep) -> DataFrame:
    """(unit, sid) of an auction over edges: rounds until no listing bids any more.

    In each round every free listing bids for the species with the best confidence less price; a species goes to its
    highest bid, whose amount becomes its price. A bid raises a price by eps at least and no one bids beyond the
    confidence, so the rounds end; the total is then within eps a listing of the greatest.
    """
    holders = keep(g.select("sid").distinct().select("sid", F.lit(None).cast("bigint").alias("unit"), F.lit(0.0).alias("price")))
    while True:
        free = g.join(holders.where("unit is not null").select("unit"), "unit", "left_anti").join(holders.select("sid", "price"), "sid")
        net = free.withColumn("net", F.col("confidence") - F.col("price")).where(F.col("net") > 0)
        bids = net.groupBy("unit").agg(F.max_by("sid", F.struct("net", "sid")).alias("sid"), F.sort_array(F.collect_list("net"), asc=False).alias("nets"), F.max_by("price", F.struct("net", "sid")).alias("price"))
        bids = bids.select("unit", "sid", (F.col("price") + F.col("nets")[0] - F.greatest(F.coalesce(F.get("nets", 1), F.lit(0.0)), F.lit(0.0)) + eps).alias("bid"))
        won = keep(bids.groupBy("sid").agg(F.max_by("unit", F.struct("bid", "unit")).alias("new"), F.max("bid").alias("bid")))
        if won.isEmpty():
            return holders.where("unit is not null").select("unit", "sid")
        holders = keep(holders.join(won, "sid", "left").select("sid", F.coalesce("new", "unit").alias("unit"), F.coalesce("bid", "price").alias("price")))


def assign(scored: DataFrame, least: float = LEAST, eps: float = 0.002, materialise=None) -> DataFrame:
    """(unit, sid, confidence, role): a one-to-one assignment of the greatest total, and what follows it.

    Listings and species that compete fall into connected components. One of up to MOST_COMPONENT
    edges is solved exactly in one task; a larger one by an auction over the cluster, which runs
    until no one bids and is within `eps` a listing of the greatest total. Free listings whose best
    species fits them nearly as well as its holder (within 0.35) then follow the holder.
    """
    keep = materialise or checkpoint
    e = keep(scored.where(F.col("confidence") >= least).select("unit", "sid", "confidence"))
    multi = e.groupBy("unit").agg(F.count("*").alias("n"), F.min("sid").alias("a")).where("n > 1")
    several = e.join(multi.select("unit", "a"), "unit")
    contested = several.select("sid").distinct()
    plain = e.join(multi, "unit", "left_anti")
    # Of the listings that fit one species only, none but the best can get it.
    best_plain = keep(plain.groupBy("sid").agg(F.max_by("unit", F.struct("confidence", "unit")).alias("unit"), F.max("confidence").alias("confidence")))
    g = keep(several.select("unit", "sid", "confidence").unionByName(best_plain.join(contested, "sid", "left_semi").select("unit", "sid", "confidence")))
    free_plain = best_plain.join(contested, "sid", "left_anti").select("unit", "sid", "confidence")
    primary = free_plain
    if not g.isEmpty():
        root = components(several.select("a", F.col("sid").alias("b")), keep)
        g = g.join(root.withColumnRenamed("node", "sid"), "sid")
        size = keep(g.groupBy("root").agg(F.count("*").alias("n")))
        small = g.join(size.where(F.col("n") <= MOST_COMPONENT).select("root"), "root", "left_semi")
        lists = small.groupBy("root").agg(F.collect_list(F.struct("unit", "sid", F.round(F.col("confidence") * 10_000).cast("bigint").alias("w"))).alias("x"))
        held = lists.select(F.inline(_solve("x.unit", "x.sid", "x.w")))
        large = size.where(F.col("n") > MOST_COMPONENT).select("root")
        if not large.isEmpty():
            held = held.unionByName(_auction(keep(g.join(large, "root", "left_semi").select("unit", "sid", "confidence")), eps, keep))
        primary = free_plain.unionByName(held.join(e, ["unit", "sid"]).select("unit", "sid", "confidence"))
    primary = keep(primary)
    rest = e.join(primary.select("unit"), "unit", "left_anti")
    best = rest.groupBy("unit").agg(F.max_by("sid", F.struct("confidence", "sid")).alias("sid"), F.max("confidence").alias("confidence"))
    follow = best.join(primary.select("sid", F.col("confidence").alias("_c")), "sid").where("confidence >= _c - 0.35").drop("_c")
    return primary.withColumn("role", F.lit("assigned")).unionByName(follow.select("unit", "sid", "confidence").withColumn("role", F.lit("repeated")))


def match_classes(records: DataFrame, listings: DataFrame, least: float = LEAST, materialise=None) -> tuple[DataFrame, DataFrame]:
    """((unit, sid, confidence, role, scientific_name) of matched classes, (xc_id, unit)): one row a class, not a pair of rows."""
    keep = materialise or checkpoint
    s = keep(species_units(records))
    x, rows = listing_units(listings, keep)
    x = keep(x)
    scored = compare(neighbours(s, x, materialise=keep), s, x, least)
    a = assign(scored, least, materialise=keep)
    return a.join(s.select("sid", "scientific_name"), "sid"), rows


def match(records: DataFrame, listings: DataFrame, least: float = LEAST, materialise=None) -> DataFrame:
    """(rec_id, xc_id, confidence, role) of all rows of matched species."""
    a, rows = match_classes(records, listings, least, materialise)
    return records.select("rec_id", "scientific_name").join(a, "scientific_name").join(rows, "unit").select("rec_id", "xc_id", "confidence", "role")


def members(records: DataFrame, listings: DataFrame, materialise=None) -> DataFrame:
    """(side, id, class_id): the species (`sid`) of each record and the unit of each listing, as in `match_classes`."""
    own = species_of(records).groupBy("scientific_name").agg(F.min("rec_id").alias("class_id"))
    of = records.select("rec_id", "scientific_name").join(own, "scientific_name").select(F.lit("record").alias("side"), F.col("rec_id").alias("id"), "class_id")
    _, rows = listing_units(listings, materialise)
    return of.unionByName(rows.select(F.lit("listing").alias("side"), F.col("xc_id").alias("id"), F.col("unit").alias("class_id")))
