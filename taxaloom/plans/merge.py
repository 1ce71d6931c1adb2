"""Merge queries: descriptions, names, images, overrides, upserts, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.functions import maps
from taxaloom.functions.text import word_count
from taxaloom.operators import merge as M
from taxaloom.operators import ordering
from taxaloom.plans.common import RECORDS_SQL, documents, names, records, words_sql


def _layers(spark, sf):
    """Records with three layers of descriptions: own, an English text, and texts of one source as overlay."""
    d = documents(spark, sf).where("text is not null and trim(text) <> '' and scientific_name is not null and lang is not null")
    base = M.pack(d.where("lower(source) = 'wikipedia'"), ["scientific_name"], "lang", "text", "doc_id").withColumnRenamed("m", "wiki")
    over = M.pack(d.where("lower(source) = 'llm'"), ["scientific_name"], "lang", "text", "doc_id").withColumnRenamed("m", "llm")
    en = d.where("lower(source) = 'ebird' and lang = 'en'").groupBy("scientific_name").agg(F.min_by("text", "doc_id").alias("ebird"))
    r = records(spark, sf).select("rec_id", "scientific_name")
    for x in (base, over, en):
        r = r.join(x, "scientific_name", "left")
    return r


def description_merge(spark, sf):
    d = M.merge_descriptions(_layers(spark, sf), "wiki", "ebird", "llm")
    en = F.element_at("descriptions", F.lit("en"))
    return d.select("rec_id", "description_source", F.size("descriptions").cast("bigint").alias("locales"), F.coalesce(F.length(en), F.lit(0)).cast("bigint").alias("english_chars"), F.coalesce(F.element_at("description_sources", F.lit("de")), F.lit("")).alias("de_source"))


def name_merge(spark, sf):
    """Names of three sources: labels fill, translated replace, the record's own English prevails."""
    n = names(spark, sf).where("common_name <> ''")
    r = records(spark, sf).select("rec_id", "scientific_name", "common_name")
    for source, to in (("inat", "base"), ("ebird", "translated"), ("wikidata", "labels")):
        r = r.join(M.pack(n.where(F.col("name_source").startswith(source)), ["scientific_name"], "locale", "common_name", "name_id").withColumnRenamed("m", to), "scientific_name", "left")
    m = M.merge_names(r, "base", "translated", "labels", F.col("common_name"))
    d = r.withColumn("m", m)
    return d.select("rec_id", F.size("m").cast("bigint").alias("n"), *[F.element_at("m", F.lit(x)).alias(f"name_{x}") for x in ("en", "de", "fr", "es")])


def image_priority(spark, sf):
    """The first usable image: own id, then code, then page."""
    free = F.coalesce(F.col("observations_count"), F.lit(0)) >= 2
    page = F.get(F.map_values(maps.without_blank("wikipedia_urls")), F.lit(0))
    i = M.first_image([("inat", F.col("image_url"), free), ("ebird", F.nullif("ebird_code", F.lit("")), F.lit(True)), ("page", page.isNotNull().cast("string"), page.isNotNull()), ("observation", F.col("image_url"), F.lit(True))])
    return records(spark, sf).withColumn("i", i).select("rec_id", F.coalesce("i.source", F.lit("none")).alias("source"))


def image_source_counts(spark, sf):
    return image_priority(spark, sf).groupBy("source").agg(F.count("*").alias("n"))


def override_overlay(spark, sf):
    """English names of the names table override the records' where one source alone says so."""
    o = names(spark, sf).where("locale = 'en' and name_source = 'observationorg'").groupBy("scientific_name").agg(F.min("common_name").alias("common_name"))
    return M.override(records(spark, sf).select("rec_id", "scientific_name", "common_name"), o, "scientific_name", ["common_name"]).select("rec_id", "common_name")


def upsert_counts(spark, sf):
    """Word counts by species and language: those of newer texts where there are any."""
    d = documents(spark, sf).where("text is not null and scientific_name is not null and lang is not null").select("scientific_name", "lang", "doc_id", word_count("text").alias("words"))
    old = ordering.first_wins(d, ["scientific_name", "lang"], "doc_id", ["words"])
    new = ordering.last_wins(d.where("words >= 100"), ["scientific_name", "lang"], "doc_id", ["words"])
    return M.upsert(old, new, ["scientific_name", "lang"], ["words"])


def refetch_accepted(spark, sf):
    """Later texts of a species that would replace its first one."""
    d = documents(spark, sf).where("text is not null and scientific_name is not null and lang is not null").withColumn("words", word_count("text"))
    first = ordering.first_wins(d, ["scientific_name", "lang"], "doc_id", ["words"]).withColumnRenamed("words", "before")
    x = d.join(first, ["scientific_name", "lang"])
    return x.where(M.accept_refetched(F.col("before"), F.col("words"), F.contains(F.lower("text"), F.lower("scientific_name")))).groupBy("lang").agg(F.count("*").alias("n"))


def extract_merge(spark, sf):
    """Names by locale of two sources, the older's entries prevailing, as one line."""
    n = names(spark, sf).where("common_name <> ''")
    a = M.pack(n.where("name_source = 'inat'"), ["scientific_name"], "locale", "common_name", "name_id", last=False).withColumnRenamed("m", "old")
    b = M.pack(n.where("name_source = 'wikidata'"), ["scientific_name"], "locale", "common_name", "name_id", last=False).withColumnRenamed("m", "new")
    d = a.join(b, "scientific_name", "full_outer").withColumn("m", M.merge_first_wins(F.col("old"), F.col("new")))
    return d.select("scientific_name", F.array_join(F.transform(maps.sorted_keys("m"), lambda k: F.concat(k, F.lit("="), F.element_at("m", k))), "|").alias("names"))


def locale_pivot_csv(spark, sf):
    """The export: fixed columns and one name column for each of the most frequent locales."""
    r = records(spark, sf)
    tops = ordering.top_by_count(r.select("ord", F.explode(F.map_keys("common_names")).alias("locale")), "locale", "ord", 30)
    cols = sorted(x[0] for x in tops.collect())
    return r.select("rec_id", "scientific_name", F.array_join("scientific_name_aliases", "|").alias("aliases"), F.array_join(F.array(*[F.coalesce(F.element_at("common_names", F.lit(c)), F.lit("")) for c in cols]), "|").alias("names"))


QUERIES = {f.__name__: f for f in (description_merge, name_merge, image_priority, image_source_counts, override_overlay, upsert_counts, refetch_accepted, extract_merge, locale_pivot_csv)}

_R = RECORDS_SQL
_D = "(select * from documents where text is not null and trim(text) <> '' and scientific_name is not null and lang is not null)"
_IMG = f"(select rec_id, case when image_url is not null and coalesce(observations_count, 0) >= 2 then 'inat' when coalesce(ebird_code, '') <> '' then 'ebird' when len(list_filter(coalesce(map_values(wikipedia_urls), []), lambda x: x <> '')) > 0 then 'page' when image_url is not null then 'observation' else 'none' end as source from {_R})"
_N = "(select * from name_rows where common_name <> '')"
ORACLE = {
    "description_merge": f"""with w as (select scientific_name, lang, arg_max(text, doc_id) as t from {_D} where lower(source) = 'wikipedia' group by 1, 2), l as (select scientific_name, lang, arg_max(text, doc_id) as t from {_D} where lower(source) = 'llm' group by 1, 2),
        e as (select scientific_name, 'en' as lang, arg_min(text, doc_id) as t from {_D} where lower(source) = 'ebird' and lang = 'en' group by 1),
        a as (select *, 1 as p, 'llm' as s from l union all select *, 2, 'wikipedia' from w union all select *, 3, 'ebird' from e),
        m as (select scientific_name, lang, arg_min(t, p) as t, arg_min(s, p) as s from a group by 1, 2),
        g as (select scientific_name, count(*) as locales, max(case when lang = 'en' then length(t) end) as en, coalesce(max(case when lang = 'en' then s end), arg_min(s, lang)) as source, max(case when lang = 'de' then s end) as de from m group by 1)
        select rec_id, coalesce(source, '') as description_source, coalesce(locales, 0) as locales, coalesce(en, 0) as english_chars, coalesce(de, '') as de_source from species_records left join g using (scientific_name)""",
    "name_merge": f"""with a as (select scientific_name, locale, case when starts_with(name_source, 'ebird') then 2 when starts_with(name_source, 'inat') then 3 else 4 end as p, name_id, common_name from {_N} where name_source similar to '(inat|ebird|wikidata).*'),
        b as (select r.rec_id, locale, p, name_id, a.common_name from species_records r join a using (scientific_name) union all select rec_id, 'en', 1, 0, common_name from species_records where common_name <> ''),
        c as (select rec_id, locale, arg_max(common_name, name_id - p * 10000000000000::hugeint) as n from b group by 1, 2)
        select r.rec_id, count(locale) as n, {', '.join(f"max(case when locale = '{x}' then c.n end) as name_{x}" for x in ('en', 'de', 'fr', 'es'))} from species_records r left join c using (rec_id) group by 1""",
    "image_priority": f"select * from {_IMG}",
    "image_source_counts": f"select source, count(*) as n from {_IMG} group by 1",
    "override_overlay": "with o as (select scientific_name, min(common_name) as c from name_rows where locale = 'en' and name_source = 'observationorg' group by 1) select rec_id, coalesce(nullif(c, ''), common_name) as common_name from species_records left join o using (scientific_name)",
    "upsert_counts": f"""with d as (select scientific_name, lang, doc_id, {words_sql('text')} as words from documents where text is not null and scientific_name is not null and lang is not null)
        select scientific_name, lang, coalesce(arg_max(words, doc_id) filter (words >= 100), arg_min(words, doc_id)) as words from d group by 1, 2""",
    "refetch_accepted": f"""with d as (select *, {words_sql('text')} as words from documents where text is not null and scientific_name is not null and lang is not null),
        f as (select scientific_name, lang, arg_min(words, doc_id) as before from d group by 1, 2)
        select lang, count(*) as n from d join f using (scientific_name, lang) where contains(lower(text), lower(scientific_name)) and words >= greatest(40, before) group by 1""",
    "extract_merge": f"""with a as (select scientific_name, locale, arg_min(common_name, name_id + case name_source when 'inat' then 0 else 10000000000000 end) as n from {_N} where name_source in ('inat', 'wikidata') group by 1, 2)
        select scientific_name, string_agg(locale || '=' || n, '|' order by locale) as names from a group by 1""",
    "locale_pivot_csv": """with k as (select l, count(*) as n, min(rec_id) as f from (select rec_id, unnest(map_keys(common_names)) as l from species_records) group by 1 order by n desc, f, l limit 30)
        select rec_id, scientific_name, array_to_string(scientific_name_aliases, '|') as aliases, array_to_string(list_transform((select list(l order by l) from k), lambda x: coalesce(common_names[x], '')), '|') as names from species_records""",
}
