"""Aggregates: statistics, coverage, scores, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.functions import maps
from taxaloom.functions.text import word_count
from taxaloom.operators import quality as Q
from taxaloom.plans.common import EXTERNAL, IDS, RECORDS_SQL, checks, listings, records, words_sql


def build_stats(spark, sf):
    """Counters of the build in one pass."""
    r = records(spark, sf)
    return r.agg(
        F.count("*").alias("records"), F.countDistinct("scientific_name").alias("species"), F.count_if(F.col("record_type") == "sound_class").alias("sound_classes"),
        *[F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) != "").alias(f"with_{c}") for c in IDS],
        F.count_if(maps.value("descriptions", "en").isNotNull()).alias("with_english"),
    )


def locale_coverage(spark, sf):
    """Records with a name, and with a text, by locale."""
    r = records(spark, sf)
    n = r.select(F.explode(F.map_keys(maps.without_blank("common_names"))).alias("locale"), F.lit(1).alias("a"), F.lit(0).alias("b"))
    d = r.select(F.explode(F.map_keys(maps.without_blank("descriptions"))).alias("locale"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    return n.unionByName(d).groupBy("locale").agg(F.sum("a").alias("names"), F.sum("b").alias("texts"))


def description_source_counts(spark, sf):
    r = records(spark, sf)
    return r.groupBy(F.coalesce(F.nullif("description_source", F.lit("")), F.lit("none")).alias("source")).agg(F.count("*").alias("n"))


def source_prefix_counts(spark, sf):
    """Name sources with their suffixes cut off, as image sources are counted."""
    from taxaloom.plans.common import names

    return names(spark, sf).groupBy(F.substring_index("name_source", "_", 1).alias("source")).agg(F.count("*").alias("n"))


def inclusion_reasons(spark, sf):
    """The first reason that leaves a record out, counted."""
    reason = (
        F.when(F.col("inat_id").isNull(), "no_id").when(~F.coalesce(F.col("scientific_name").rlike("^[A-Z][A-Za-z.-]+ [a-z][A-Za-z.-]+$"), F.lit(False)), "no_species")
        .when(~F.coalesce(F.col("taxon_group").isin("Aves", "Mammalia", "Insecta"), F.lit(False)), "group").when((F.col("taxon_group") == "Aves") & (F.coalesce("ebird_code", F.lit("")) == ""), "unmatched").otherwise("kept")
    )
    return records(spark, sf).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def quality_scores(spark, sf):
    d = Q.score(records(spark, sf), IDS, EXTERNAL)
    return d.select("rec_id", "quality_score", F.array_join("quality_flags", "|").alias("flags"), "external_ids")


def _pruned(spark, sf):
    return Q.drop_reasons(Q.score(records(spark, sf), IDS, EXTERNAL), 40, {"Insecta": 55}, True, 1)


def quality_report(spark, sf):
    """Keep or drop, with reasons, for every record."""
    d = _pruned(spark, sf)
    return d.select("rec_id", F.when(F.size("drop_reasons") > 0, "drop").otherwise("keep").alias("action"), F.array_join("drop_reasons", "|").alias("reasons"))


def drop_reason_counts(spark, sf):
    return Q.reason_counts(_pruned(spark, sf))


def metadata_audit(spark, sf):
    return Q.audit(records(spark, sf), ["birdnet_id", "scientific_name", "common_name", "taxon_group", "description_source"])


def description_audit(spark, sf):
    """Words and status of every record and locale."""
    return Q.description_audit(records(spark, sf)).select(F.col("ord").alias("rec_id"), "locale", "words", "status")


def description_audit_counts(spark, sf):
    return Q.description_audit(records(spark, sf)).groupBy("locale", "status").agg(F.count("*").alias("n"))


def signature_groups(spark, sf):
    """Records by the set of target locales they lack, largest groups first."""
    targets = ["de", "fr", "es", "pl"]
    sig = F.filter(F.array(*[F.lit(x) for x in targets]), lambda x: F.coalesce(F.element_at("descriptions", x), F.lit("")) == "")
    d = records(spark, sf).select(F.array_join(sig, ",").alias("signature"), F.size(sig).cast("bigint").alias("locales"))
    return d.groupBy("signature", "locales").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("locales"), "signature")


def refetch_outcomes(spark, sf):
    """Outcomes of the checks of each locale, with the share that is fine."""
    d = checks(spark, sf).where("locale is not null")
    return d.groupBy("locale").agg(F.count("*").alias("n"), F.count_if(F.col("last_status") == "ok").alias("ok"), F.round(100 * F.count_if(F.col("last_status") == "ok") / F.greatest(F.lit(1), F.count("*")), 4).alias("percent"))


def match_rate(spark, sf):
    """Listings whose name a record has, by group label."""
    own = records(spark, sf).select(F.col("scientific_name").alias("xc_name")).distinct().withColumn("hit", F.lit(1))
    d = listings(spark, sf).join(own, "xc_name", "left")
    return d.groupBy(F.lower("group_label").alias("label")).agg(F.count("*").alias("n"), F.count("hit").alias("matched"), F.round(100 * F.count("hit") / F.greatest(F.lit(1), F.count("*")), 4).alias("percent"))


def longest_texts(spark, sf):
    """Words of the longest text by locale."""
    d = records(spark, sf).select(F.explode("descriptions").alias("locale", "text"))
    return d.groupBy("locale").agg(F.max(word_count("text")).alias("most"), F.sum(word_count("text")).alias("total"))


QUERIES = {f.__name__: f for f in (build_stats, locale_coverage, description_source_counts, source_prefix_counts, inclusion_reasons, quality_scores, quality_report, drop_reason_counts, metadata_audit, description_audit, description_audit_counts, signature_groups, refetch_outcomes, match_rate, longest_texts)}

_R = RECORDS_SQL
_W = words_sql
_B = "^[A-Z][A-Za-z.-]+ [a-z][A-Za-z.-]+$"
_X = r"[()\[\]{}/\\<>|]"
_given = lambda c: f"(coalesce({c}::varchar, '') not in ('', '0'))"
_SCORE = f"""(with t as (select *, coalesce(descriptions['en'], '') as en, {_W("descriptions['en']")} as w,
      len(list_filter(coalesce(map_values(descriptions), []), lambda x: {_W('x')} >= 40)) as rich,
      {' + '.join(f'{_given(c)}::int' for c in IDS)} as ids, {' + '.join(f'{_given(c)}::int' for c in EXTERNAL)} as external_ids,
      (coalesce(common_name, '') <> '' and common_name <> coalesce(scientific_name, '')) as named from {_R})
    select *, least(100, (case when w >= 80 then 30 when w >= 40 then 22 when en <> '' then 10 else 0 end) + least(20, rich * 2) + (case when image_url is not null then 20 else 0 end)
      + least(20, ids * 3) + (case when named then 5 else 0 end) + (case when coalesce(observations_count, 0) <> 0 then 5 else 0 end)) as quality_score,
      concat_ws('|', case when en <> '' and w < 40 then 'short_english_description' end, case when en = '' then 'missing_english_description' end, case when rich <= 1 then 'few_localized_descriptions' end,
        case when image_url is null then 'missing_image' end, case when external_ids < 2 then 'weak_external_ids' end, case when not named then 'missing_common_name' end) as flags from t)"""
_REASONS = f"""(select *, case when record_type = 'sound_class' then '' else concat_ws('|', case when quality_score < th then 'score_below_' || th end, case when image_url is null and en = '' and external_ids <= 1 then 'thin_record' end) end as reasons
    from (select *, case taxon_group when 'Insecta' then 55 else 40 end as th from {_SCORE}))"""
_AUDIT = f"""(with u as (select rec_id, descriptions, map_from_entries(list_filter(coalesce(map_entries(wikipedia_urls), []), lambda e: e.value <> '')) as urls from {_R}),
    k as (select rec_id, descriptions, urls, unnest(list_distinct(list_concat(coalesce(map_keys(descriptions), []), map_keys(urls)))) as locale from u),
    w as (select rec_id, locale, {_W('descriptions[locale]')} as words, list_contains(map_keys(urls), locale) as has_url from k)
    select rec_id, locale, words, case when not has_url and words = 0 then 'missing_url' when words = 0 then 'missing_text' when words < 40 then 'short' else 'ok' end as status from w)"""
ORACLE = {
    "build_stats": f"""select count(*) as records, count(distinct scientific_name) as species, count(*) filter (record_type = 'sound_class') as sound_classes,
        {', '.join(f"count(*) filter (coalesce({c}::varchar, '') <> '') as with_{c}" for c in IDS)}, count(*) filter (coalesce(descriptions['en'], '') <> '') as with_english from species_records""",
    "locale_coverage": """with a as (select e.key as locale, 1 as a, 0 as b from (select unnest(map_entries(common_names)) as e from species_records) where e.value <> '' union all select e.key, 0, 1 from (select unnest(map_entries(descriptions)) as e from species_records) where e.value <> '')
        select locale, sum(a)::bigint as names, sum(b)::bigint as texts from a group by 1""",
    "description_source_counts": "select coalesce(nullif(description_source, ''), 'none') as source, count(*) as n from species_records group by 1",
    "source_prefix_counts": "select split_part(name_source, '_', 1) as source, count(*) as n from name_rows group by 1",
    "inclusion_reasons": f"""select case when inat_id is null then 'no_id' when not coalesce(regexp_matches(scientific_name, '{_B}'), false) then 'no_species' when not coalesce(taxon_group in ('Aves', 'Mammalia', 'Insecta'), false) then 'group'
        when taxon_group = 'Aves' and coalesce(ebird_code, '') = '' then 'unmatched' else 'kept' end as reason, count(*) as n from species_records group by 1""",
    "quality_scores": f"select rec_id, quality_score::bigint as quality_score, flags, external_ids::bigint as external_ids from {_SCORE}",
    "quality_report": f"select rec_id, case when reasons <> '' then 'drop' else 'keep' end as action, reasons from {_REASONS}",
    "drop_reason_counts": f"select reason, count(*) as n from (select unnest(string_split(reasons, '|')) as reason from {_REASONS}) where reason <> '' group by 1",
    "metadata_audit": f"""with r as (select *, coalesce(record_type, 'species') <> 'sound_class' as sp from {_R})
        {' union all '.join(f"select 'missing_{c}' as finding, count(*) filter (coalesce({c}, '') = '') as n from r" for c in ("birdnet_id", "scientific_name", "common_name", "taxon_group", "description_source"))}
        union all select 'short_english', count(*) filter (sp and {_W("descriptions['en']")} < 40) from r
        union all select 'bad_scientific_name', count(*) filter (sp and not (coalesce(regexp_matches(trim(scientific_name), '{_B}'), false) and not regexp_matches(coalesce(scientific_name, ''), '{_X}'))) from r
        union all select 'bad_common_name', count(*) filter (not (trim(coalesce(common_name, '')) <> '' and not regexp_matches(coalesce(common_name, ''), '{_X}') and not regexp_matches(trim(coalesce(common_name, '')), '\\s{{2,}}'))) from r
        union all select 'bad_alias', count(*) filter (sp and len(list_filter(coalesce(scientific_name_aliases, []), lambda a: not (coalesce(regexp_matches(trim(a), '{_B}'), false) and not regexp_matches(coalesce(a, ''), '{_X}')))) > 0) from r""",
    "description_audit": f"select * from {_AUDIT}",
    "description_audit_counts": f"select locale, status, count(*) as n from {_AUDIT} group by 1, 2",
    "signature_groups": """select array_to_string(s, ',') as signature, len(s) as locales, count(*) as n from (select list_filter(['de', 'fr', 'es', 'pl'], lambda l: coalesce(descriptions[l], '') = '') as s from species_records) group by 1, 2""",
    "refetch_outcomes": "select locale, count(*) as n, count(*) filter (last_status = 'ok') as ok, round(100 * count(*) filter (last_status = 'ok') / greatest(1, count(*)), 4) as percent from wiki_quality where locale is not null group by 1",
    "match_rate": "select lower(group_label) as label, count(*) as n, count(*) filter (hit) as matched, round(100 * count(*) filter (hit) / greatest(1, count(*)), 4) as percent from (select group_label, coalesce(xc_name in (select scientific_name from species_records), false) as hit from xc_species) group by 1",
    "longest_texts": f"select e.key as locale, max({_W('e.value')}) as most, sum({_W('e.value')})::bigint as total from (select unnest(map_entries(descriptions)) as e from species_records) group by 1",
}
