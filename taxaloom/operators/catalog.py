"""The catalog: filters, sorting, paging, projection, lookup by any identifier and ranked search.

Records are a DataFrame with `ord` (the delivered order) and the columns of species_records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaloom.functions import maps
from taxaloom.functions.text import null_to_blank
from taxaloom.functions.udf import fold, normalise

YES = ("true", "1", "yes")
#: Columns put first in exports.
FIRST_COLUMNS = ("scientific_name", "common_name", "taxon_group", "observations_count", "inat_id", "ebird_code")


def _wanted(flag: str) -> bool:
    return flag.lower() in YES


def filters(df: DataFrame, group: str = "", has_image: str = "", has_description: str = "", description_source: str = "", min_observations: int | None = None, max_observations: int | None = None) -> DataFrame:
    """All given conditions hold; a null count is 0, an empty condition is none."""
    c: list[Column] = []
    if group:
        c.append(F.lower(null_to_blank("taxon_group")) == group.lower())
    if has_image:
        c.append((null_to_blank("image_url") != "") == F.lit(_wanted(has_image)))
    if has_description:
        c.append(maps.value("descriptions", "en").isNotNull() == F.lit(_wanted(has_description)))
    if description_source:
        c.append(F.lower(null_to_blank("description_source")).isin([s.strip().lower() for s in description_source.split(",") if s.strip()]))
    n = F.coalesce("observations_count", F.lit(0))
    if min_observations is not None:
        c.append(n >= min_observations)
    if max_observations is not None:
        c.append(n <= max_observations)
    return reduce(lambda d, x: d.where(x), c, df)


def sort_columns(df: DataFrame, sort: str) -> list[Column]:
    """Order by a field ('-' in front for descending), text without case; ties in delivered order.

    Ascending puts nulls last, descending first. An unknown or empty field leaves the order.
    """
    key = sort.lstrip("-").strip()
    if not key or key not in df.columns:
        return [F.col("ord").asc()]
    kind = dict(df.dtypes)[key]
    c = F.lower(key) if kind == "string" else F.col(key)
    return [c.desc_nulls_first() if sort.startswith("-") else c.asc_nulls_last(), F.col("ord").asc()]


def page(df: DataFrame, sort: str = "", number: int = 1, size: int = 50) -> DataFrame:
    """One page; Spark turns sort and limit into a top-k of offset + limit rows."""
    if not 1 <= size <= 500 or number < 1:
        raise ValueError("a page has 1 to 500 rows, and pages count from 1")
    return df.orderBy(*sort_columns(df, sort)).offset((number - 1) * size).limit(size)


def paging(total: int, number: int, size: int) -> dict:
    return {"total": total, "page": number, "per_page": size, "total_pages": max(1, -(-total // size))}


def project(df: DataFrame, fields: str = "", exclude: str = "", locale: str = "") -> DataFrame:
    """Trim the maps to one locale; keep `fields` or, if none are named, drop `exclude`."""
    if locale:
        for m in ("common_names", "descriptions", "wikipedia_urls"):
            if m in df.columns:
                df = df.withColumn(m, maps.keep_keys(m, [locale]))
    keep = [f.strip() for f in fields.split(",") if f.strip()]
    if keep:
        return df.select(*[f for f in keep if f in df.columns])
    return df.drop(*[f.strip() for f in exclude.split(",") if f.strip()])


def lookup_index(df: DataFrame) -> DataFrame:
    """(key, priority, ord): every identifier a record answers to.

    Priorities: name, alias, common name in any locale, record id, code, other source's name,
    numeric id. Of several records with a name or code the last counts; aliases and localized
    names give way to an earlier record; an English name replaces localized ones.
    """
    def rows(key: Column, priority: int, last: bool, tier: int = 0) -> DataFrame:
        return df.select(key.alias("key"), F.lit(priority).alias("priority"), F.lit(tier).alias("tier"), "ord", F.lit(last).alias("last"))

    low = lambda c: F.lower(F.nullif(F.col(c), F.lit("")))
    none = F.array().cast("array<string>")
    parts = [
        rows(low("scientific_name"), 1, True),
        rows(F.explode(F.transform(F.coalesce("scientific_name_aliases", none), lambda a: F.lower(a))), 2, False),
        rows(low("common_name"), 3, True),
        rows(F.explode(F.transform(F.coalesce(F.map_values("common_names"), none), lambda a: F.lower(F.nullif(a, F.lit(""))))), 3, False, 1),
        rows(F.lower(F.nullif("birdnet_id", F.lit(""))), 4, True),
        rows(low("ebird_code"), 5, True),
        rows(F.when(F.col("xc_name") != F.col("scientific_name"), low("xc_name")), 7, True),
        rows(F.col("inat_id").cast("string"), 8, True),
    ]
    d = reduce(DataFrame.unionByName, parts).where("key is not null and key <> ''")
    g = d.groupBy("key", "priority", "tier").agg(F.when(F.first("last"), F.max("ord")).otherwise(F.min("ord")).alias("ord"))
    return g.groupBy("key", "priority").agg(F.min_by("ord", "tier").alias("ord"))


def lookup(df: DataFrame, identifiers: DataFrame, column: str) -> DataFrame:
    """(identifier, ord): the record each identifier means, null where none."""
    i = identifiers.select(F.col(column).alias("identifier")).where("identifier is not null").distinct()
    x = i.join(lookup_index(df), F.lower("identifier") == F.col("key"), "left")
    return x.groupBy("identifier").agg(F.min_by("ord", "priority").alias("ord"))


def search_text(df: DataFrame) -> DataFrame:
    """Add the folded texts that search compares: name, common name, aliases and all together."""
    none = F.array().cast("array<string>")
    d = df.withColumns({
        "_sci": F.lower(null_to_blank("scientific_name")),
        "_com": normalise(null_to_blank("common_name")),
        "_al": F.split(normalise(F.array_join(F.filter(F.coalesce("scientific_name_aliases", none), lambda a: a != F.col("scientific_name")), "\n")), "\n"),
        "_names": normalise(F.array_join(F.coalesce(F.map_values("common_names"), none), " ")),
        "_own": normalise(F.concat_ws(" ", null_to_blank("scientific_name"), null_to_blank("common_name"), null_to_blank("common_name_alt"))),
    })
    return d.withColumn("_all", F.concat_ws(" ", "_own", F.array_join("_al", " "), "_names"))


def search(df: DataFrame, q: str, group: str = "") -> DataFrame:
    """Records in which every word of the query occurs, with `score`.

    The tiers are tried in a fixed order, alias beginnings before common name beginnings; the
    observation count adds up to 10 (a null counts as 0). An empty query returns all, unscored.
    """
    d = filters(df, group=group)
    if not q:
        return d.withColumn("score", F.lit(0.0))
    n = fold(q)
    terms = n.split()
    d = search_text(d)
    for t in terms:
        d = d.where(F.contains("_all", F.lit(t)))
    words = F.split("_com", r"\s+")
    has = lambda c, x: F.contains(c, F.lit(x))
    every = lambda f: reduce(lambda a, b: a & b, [f(t) for t in terms], F.lit(True))
    tier = (
        F.when((F.col("_com") == n) | (F.col("_sci") == n), 200)
        .when(F.array_contains("_al", F.lit(n)), 190)
        .when(F.exists("_al", lambda a: a.startswith(n + " ")), 150)
        .when(F.col("_com").startswith(n + " "), 160)
        .when(F.array_contains(words, F.lit(n)), 140)
        .when(every(lambda t: F.array_contains(words, F.lit(t))), 130)
        .when(F.col("_sci").startswith(n), 120)
        .when(F.array_contains(F.split("_sci", r"\s+"), F.lit(n)), 110)
        .when(every(lambda t: F.exists(words, lambda w: w.startswith(t))), 90)
        .when(has(F.col("_com"), n), 70)
        .when(has(F.col("_sci"), n), 60)
        .otherwise(30)
    )
    bonus = F.least(F.coalesce("observations_count", F.lit(0)) / 1_000_000, F.lit(10.0))
    return d.withColumn("score", tier + bonus).drop("_sci", "_com", "_al", "_names", "_own", "_all")


def search_page(df: DataFrame, q: str, group: str = "", sort: str = "", number: int = 1, size: int = 50, fields: str = "", exclude: str = "", locale: str = "") -> DataFrame:
    """A page of hits, projected: by score, or (where `sort` is given) by a field and then by score; ties in delivered order."""
    if not 1 <= size <= 500 or number < 1:
        raise ValueError("a page has 1 to 500 rows, and pages count from 1")
    d = search(df, q, group)
    order = [*(sort_columns(d, sort)[:-1] if sort else []), F.desc("score"), F.asc("ord")]
    return project(d.orderBy(*order).offset((number - 1) * size).limit(size), fields, exclude, locale)


def species(df: DataFrame, identifier: str, fields: str = "", exclude: str = "", locale: str = "") -> DataFrame:
    """The record that any of its identifiers means (no row for none), projected."""
    one = df.sparkSession.createDataFrame([(identifier,)], "i string")
    return project(df.join(F.broadcast(lookup(df, one, "i").select("ord")), "ord", "left_semi"), fields, exclude, locale)


def field_list(df: DataFrame) -> DataFrame:
    """(field): names of the fields that a record may have, in order; internal ones left out."""
    return df.sparkSession.createDataFrame([(c,) for c in sorted(df.columns) if c != "ord" and not c.startswith("_")], "field string")


def api_record(df: DataFrame, prefix: str = "") -> DataFrame:
    """Records with their image_* columns folded into one struct `image` (null without an address), which `prefix` comes before."""
    parts = [c for c in df.columns if c.startswith("image_")]
    url = F.when(F.col("image_url").startswith("/"), F.concat(F.lit(prefix), "image_url")).otherwise(F.col("image_url"))
    image = F.struct(*[(url if c == "image_url" else F.col(c)).alias(c.removeprefix("image_")) for c in parts])
    return df.withColumn("image", F.when(null_to_blank("image_url") != "", image)).drop(*parts, "ord")


def suggest(df: DataFrame, q: str, limit: int = 10, lang: str = "en") -> DataFrame:
    """The best hits of a query of two characters or more, with the name in the wanted language."""
    d = search(df, q) if len(q) >= 2 else df.limit(0).withColumn("score", F.lit(0.0))
    name = F.coalesce(maps.value("common_names", lang), F.col("common_name"))
    return d.orderBy(F.desc("score"), "ord").limit(max(1, min(20, limit))).select("scientific_name", name.alias("common_name"), F.round("score", 6).alias("score"))


def group_counts(df: DataFrame) -> DataFrame:
    g = F.coalesce(F.nullif("taxon_group", F.lit("")), F.lit("unknown"))
    return df.groupBy(g.alias("taxon_group")).agg(F.count("*").alias("n"))


def locales(df: DataFrame) -> DataFrame:
    """Distinct locales of the names other than English."""
    return df.select(F.explode(F.map_keys("common_names")).alias("locale")).distinct().where("locale <> 'en'")


def csv_cells(df: DataFrame, fields: str = "") -> DataFrame:
    """Columns as exported: named ones or first columns then the rest by name, maps and arrays as JSON, null as ''.

    Descriptions are never exported.
    """
    usable = [c for c in df.columns if c not in ("descriptions", "description", "ord")]
    keep = [f.strip() for f in fields.split(",") if f.strip() in usable] or [c for c in FIRST_COLUMNS if c in usable] + sorted(set(usable) - set(FIRST_COLUMNS))
    kinds = dict(df.dtypes)

    def cell(c: str) -> Column:
        x = F.to_json(c) if kinds[c].startswith(("map", "array", "struct")) else F.col(c).cast("string")
        return F.coalesce(x, F.lit("")).alias(c)

    return df.select(*[cell(c) for c in keep])


def rank_within(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group.

    Each task keeps no more than n rows of a group before the shuffle (Spark's group limit, up to 1,000), so that a hot
    group doesn't come to one task whole.
    """
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_k") <= n).drop("_k")
