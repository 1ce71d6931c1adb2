"""Metadata quality: completeness scores, pruning, audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.functions import maps
from taxaloom.functions.text import is_clean_common_name, is_clean_scientific_name, null_to_blank, word_count

FLAGS = ("short_english_description", "missing_english_description", "few_localized_descriptions", "missing_image", "weak_external_ids", "missing_common_name")


def _given(c: str, kinds: dict[str, str]) -> Column:
    return (null_to_blank(c) != "") if kinds[c] == "string" else F.coalesce(F.col(c) != 0, F.lit(False))


def _count(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.cast("int") for c in conditions], F.lit(0))


def score(df: DataFrame, ids: list[str], external: list[str]) -> DataFrame:
    """Add quality_score (0 to 100), quality_flags and external_ids."""
    kinds = dict(df.dtypes)
    en = null_to_blank(maps.value("descriptions", "en"))
    words = word_count(en)
    rich = F.size(F.map_filter(maps._safe("descriptions"), lambda k, v: word_count(v) >= 40))
    image = null_to_blank("image_url") != ""
    known = _count([_given(c, kinds) for c in ids])
    outside = _count([_given(c, kinds) for c in external])
    named = (null_to_blank("common_name") != "") & (F.col("common_name") != null_to_blank("scientific_name"))
    seen = F.coalesce(F.col("observations_count") != 0, F.lit(False))
    total = (
        F.when(words >= 80, 30).when(words >= 40, 22).when(en != "", 10).otherwise(0)
        + F.least(F.lit(20), rich * 2) + F.when(image, 20).otherwise(0) + F.least(F.lit(20), known * 3)
        + F.when(named, 5).otherwise(0) + F.when(seen, 5).otherwise(0)
    )
    tests = [(en != "") & (words < 40), en == "", rich <= 1, ~image, outside < 2, ~named]
    flags = F.array_compact(F.array(*[F.when(t, name) for name, t in zip(FLAGS, tests)]))
    return df.withColumns({"quality_score": F.least(F.lit(100), total).cast("bigint"), "quality_flags": flags, "external_ids": outside.cast("bigint")})


def drop_reasons(df: DataFrame, least: int, by_group: dict[str, int], drop_thin: bool = True, most_external: int = 1) -> DataFrame:
    """Add drop_reasons (empty: keep). A threshold of 0 tests nothing; sound classes are always kept."""
    least_of = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in by_group.items() for x in kv]), F.col("taxon_group")) if by_group else F.lit(None).cast("int"), F.lit(least))
    low = (least_of > 0) & (F.col("quality_score") < least_of)
    thin = F.lit(drop_thin) & F.array_contains("quality_flags", "missing_image") & F.array_contains("quality_flags", "missing_english_description") & (F.col("external_ids") <= most_external)
    reasons = F.array_compact(F.array(F.when(low, F.concat(F.lit("score_below_"), least_of.cast("string"))), F.when(thin, "thin_record")))
    return df.withColumn("drop_reasons", F.when(F.col("record_type") == "sound_class", F.array().cast("array<string>")).otherwise(reasons))


def reason_counts(df: DataFrame) -> DataFrame:
    return df.select(F.explode("drop_reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def audit(df: DataFrame, required: list[str], least_words: int = 40) -> DataFrame:
    """(finding, n): gaps in required fields, short English texts and unclean names, in one pass.

    Sound classes need no binomial and no English text.
    """
    kinds = dict(df.dtypes)
    species = F.coalesce(F.col("record_type"), F.lit("species")) != "sound_class"
    tests = {f"missing_{c}": ~_given(c, kinds) for c in required}
    tests["short_english"] = species & (word_count(maps.value("descriptions", "en")) < least_words)
    tests["bad_scientific_name"] = species & ~is_clean_scientific_name("scientific_name")
    tests["bad_common_name"] = ~is_clean_common_name("common_name")
    tests["bad_alias"] = F.coalesce(F.exists("scientific_name_aliases", lambda a: ~is_clean_scientific_name(a)), F.lit(False)) & species
    one = df.agg(*[F.count_if(t).alias(n) for n, t in tests.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in tests)
    return one.select(F.expr(f"stack({len(tests)}, {pairs}) as (finding, n)"))


def failed(audited: DataFrame, gating: list[str]) -> bool:
    """Whether any gating finding occurs."""
    return not audited.where(F.col("finding").isin(gating) & (F.col("n") > 0)).isEmpty()


def alias_conflicts(df: DataFrame, key: str = "scientific_name") -> DataFrame:
    """(alias, owners): names that more than one species claims, as an alias or as its own name."""
    a = df.select(F.col(key).alias("owner"), F.explode("scientific_name_aliases").alias("alias"))
    own = df.select(F.col(key).alias("owner"), F.col(key).alias("alias"))
    d = a.unionByName(own).where("alias is not null and owner is not null").select(F.lower("alias").alias("alias"), F.lower("owner").alias("owner")).distinct()
    return d.groupBy("alias").agg(F.count("*").alias("owners")).where("owners > 1")


def description_status(words: Column, has_url: Column, least: int = 40) -> Column:
    return F.when(~has_url & (words == 0), "missing_url").when(words == 0, "missing_text").when(words < least, "short").otherwise("ok")


def description_audit(df: DataFrame, least: int = 40) -> DataFrame:
    """One row per record and locale: words and status of the description."""
    urls = maps.without_blank("wikipedia_urls")
    keys = F.array_union(F.map_keys(maps._safe("descriptions")), F.map_keys(urls))
    d = df.select("ord", "scientific_name", "descriptions", urls.alias("_u"), F.explode(keys).alias("locale"))
    w = word_count(F.element_at(maps._safe("descriptions"), F.col("locale")))
    return d.select("ord", "scientific_name", "locale", w.alias("words"), description_status(w, F.map_contains_key("_u", F.col("locale")), least).alias("status"))


def quality_report(df: DataFrame, least: int, by_group: dict[str, int]) -> DataFrame:
    """The eleven columns of the quality report, one row a record; `df` is scored and has its drop reasons."""
    th = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in by_group.items() for x in kv]), F.col("taxon_group")) if by_group else F.lit(None).cast("int"), F.lit(least))
    return df.select(
        "ord", F.when(F.size("drop_reasons") > 0, "drop").otherwise("keep").alias("action"), F.col("quality_score").alias("score"), null_to_blank("scientific_name").alias("scientific_name"),
        null_to_blank("common_name").alias("common_name"), null_to_blank("taxon_group").alias("taxon_group"), F.array_join("quality_flags", "|").alias("flags"), F.array_join("drop_reasons", "|").alias("drop_reasons"),
        F.when(F.coalesce("record_type", F.lit("")) == "sound_class", 0).otherwise(th).cast("bigint").alias("threshold"), F.col("external_ids").alias("external_id_count"),
        null_to_blank("description_source").alias("description_source"), F.when(null_to_blank("image_url") != "", "1").otherwise("0").alias("has_image"),
    )


def description_report(df: DataFrame, least: int = 40) -> DataFrame:
    """The ten columns of the description report, one row a record and locale."""
    a = description_audit(df, least).drop("scientific_name")
    pair = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(F.map_filter(maps._safe(m), lambda k, v: v.isNotNull()))), lambda e: F.concat_ws(":", e["key"], e["value"])), "|")
    r = df.select("ord", "scientific_name", "birdnet_id", "description_source", null_to_blank("taxon_group").alias("taxon_group"), maps._safe("description_sources").alias("_s"), null_to_blank(maps.value("wikipedia_urls", "en")).alias("wikipedia_en_url"),
                  F.array_join(maps.sorted_keys("descriptions"), "|").alias("available_description_locales"), pair("description_sources").alias("available_source_locales"))
    d = a.join(r, "ord")
    return d.select("ord", "scientific_name", "birdnet_id", "taxon_group", "locale", "status", "words", F.coalesce(F.nullif(F.element_at("_s", F.col("locale")), F.lit("")), F.when(F.col("locale") == "en", F.col("description_source")), F.lit("")).alias("source"), "wikipedia_en_url", "available_description_locales", "available_source_locales")


def audit_gaps(df: DataFrame, optional: list[str]) -> DataFrame:
    """(finding, n): records without an optional identifier, and without an image."""
    kinds = dict(df.dtypes)
    tests = {f"without_{c}": ~_given(c, kinds) for c in optional} | {"without_image": null_to_blank("image_url") == ""}
    one = df.agg(*[F.count_if(t).alias(n) for n, t in tests.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in tests)
    return one.select(F.expr(f"stack({len(tests)}, {pairs}) as (finding, n)"))


def audit_samples(df: DataFrame, required: list[str], most: int, least_words: int = 40) -> DataFrame:
    """(finding, scientific_name, words): the first `most` records of each finding, in delivered order."""
    from taxaloom.operators.catalog import rank_within

    kinds = dict(df.dtypes)
    species = F.coalesce(F.col("record_type"), F.lit("species")) != "sound_class"
    words = word_count(maps.value("descriptions", "en"))
    tests = {f"missing_{c}": ~_given(c, kinds) for c in required} | {
        "short_english": species & (words < least_words), "bad_scientific_name": species & ~is_clean_scientific_name("scientific_name"), "bad_common_name": ~is_clean_common_name("common_name"),
    }
    found = F.array_compact(F.array(*[F.when(t, n) for n, t in tests.items()]))
    d = df.select("ord", "scientific_name", words.alias("words"), F.explode(found).alias("finding"))
    return rank_within(d, ["finding"], [F.col("ord")], most).select("finding", "ord", "scientific_name", F.when(F.col("finding") == "short_english", F.col("words")).alias("words"))
