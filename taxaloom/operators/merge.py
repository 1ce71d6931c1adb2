"""Multi-source merges with explicit precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.functions import maps


def pack(df: DataFrame, key: list[str], map_key: str, value: str, order: str, last: bool = True) -> DataFrame:
    """(key, m): long rows to a map per key; the last (or first) value of a map key in `order` counts."""
    pick = F.max_by if last else F.min_by
    d = df.where(F.col(map_key).isNotNull() & (F.col(value) != "")).groupBy(*key, map_key).agg(pick(value, order).alias("_v"))
    return d.groupBy(*key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(map_key, "_v")))).alias("m"))


def merge_descriptions(df: DataFrame, base: str, english: str, overlay: str, names: tuple[str, str, str] = ("wikipedia", "ebird", "llm")) -> DataFrame:
    """Add descriptions, description_sources and description_source.

    `base` (a map) counts first; `english` (text) fills English only; `overlay` (a map) replaces.
    The one source is English's, else that of the first locale in order.
    """
    fill = F.when(F.coalesce(F.col(english), F.lit("")) != "", F.create_map(F.lit("en"), F.col(english)))
    texts = maps.overlay(maps.fill(base, fill), overlay)
    b, o = maps.without_blank(base), maps.without_blank(overlay)
    source = F.transform_values(texts, lambda k, v: F.when(F.map_contains_key(o, k), names[2]).when(F.map_contains_key(b, k), names[0]).otherwise(names[1]))
    d = df.withColumns({"descriptions": texts, "description_sources": source})
    first = F.element_at("description_sources", F.get(F.array_sort(F.map_keys("description_sources")), F.lit(0)))
    return d.withColumn("description_source", F.coalesce(F.element_at("description_sources", F.lit("en")), first, F.lit("")))


def merge_names(df: DataFrame, base: str, translated: str, labels: str, authority: Column | None = None) -> Column:
    """Names by locale: labels only fill, translated ones replace, an authority's English replaces all."""
    layers = [translated]
    if authority is not None:
        layers.append(F.when(authority.isNotNull() & (authority != ""), F.create_map(F.lit("en"), authority)))
    return maps.fill(maps.overlay(base, *layers), labels)


def first_image(options: list[tuple[str, Column, Column]]) -> Column:
    """struct(url, source) of the first option (source, url, permitted) that has a permitted address."""
    return F.coalesce(*[F.when(F.coalesce(url != "", F.lit(False)) & permitted, F.struct(url.alias("url"), F.lit(name).alias("source"))) for name, url, permitted in options])


def prune_aliases(df: DataFrame, key: str, aliases: str, manual: str | None = None) -> DataFrame:
    """(key, alias, ord): aliases that are not a record's own name and that one record alone claims.

    Manual aliases need not be claimed only once. Claims are counted by lower case.
    """
    a = df.select(key, F.posexplode(aliases).alias("ord", "alias"), F.lit(False).alias("manual"))
    if manual:
        a = a.unionByName(df.select(key, F.posexplode(manual).alias("ord", "alias"), F.lit(True).alias("manual")))
    a = a.where("alias is not null and trim(alias) <> ''").withColumn("_l", F.lower("alias"))
    claims = a.where("not manual").groupBy("_l").agg(F.countDistinct(key).alias("_n"))
    own = df.select(F.lower(key).alias("_l")).distinct()
    kept = a.join(own, "_l", "left_anti").join(claims, "_l", "left").where("manual or _n = 1")
    return kept.groupBy(key, "alias").agg(F.min("ord").alias("ord"))


def override(df: DataFrame, overrides: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Non-blank override fields replace the record's."""
    o = overrides.select(key, *[F.col(f).alias(f"_o_{f}") for f in fields])
    d = df.join(o, key, "left")
    return d.withColumns({f: F.coalesce(F.nullif(F.col(f"_o_{f}"), F.lit("")), F.col(f)) for f in fields}).drop(*[f"_o_{f}" for f in fields])


def upsert(old: DataFrame, new: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Field-wise: a new value where there is one, else the old; keys of both sides."""
    o, n = old.select(*key, *[F.col(v).alias(f"_o_{v}") for v in values]), new.select(*key, *[F.col(v).alias(f"_n_{v}") for v in values])
    return o.join(n, key, "full_outer").select(*key, *[F.coalesce(f"_n_{v}", f"_o_{v}").alias(v) for v in values])


def merge_first_wins(old: Column, new: Column) -> Column:
    """Entries of an older map prevail."""
    return maps.fill(old, new)


def accept_refetched(words_old: Column, words_new: Column, identified: Column, least: int = 40) -> Column:
    """Whether a refetched text replaces the old one: about the species, long enough and not shorter."""
    return identified & (words_new >= F.greatest(F.lit(least), words_old))
