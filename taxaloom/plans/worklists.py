"""Worklist queries over the driver's tables: records as the first source, listings as the checklist."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import worklists as W
from taxaloom.plans.common import SQL_BAD, SQL_BINOMIAL, checks, documents, listings, names, records, words_sql

LOCALES = ["de", "fr", "es", "pl", "ja"]
#: Fixed list of codes that stand for taxonomy locales in names_by_code.
_AS_TAXONOMY = {"pt": "pt_BR", "ja": "ja", "en": "en", "xx": "xx"}


def _first(spark, sf):
    return records(spark, sf).withColumns({"wikipedia_url": F.element_at("wikipedia_urls", F.lit("en")), "sound_observations_count": F.expr("observations_count % 1000")})


def _checklist(spark, sf):
    code = F.when(F.col("n_recordings") % 2 == 0, F.concat(F.lit("x"), F.col("xc_id").cast("string")))
    return listings(spark, sf).select(F.col("xc_id").alias("ord"), F.col("xc_name").alias("name"), code.alias("code"), F.col("english_name").alias("english"))


def _manual(spark, sf):
    return names(spark, sf).where("locale = 'en' and name_id % 3 = 0").select("scientific_name", F.col("common_name").alias("alias"), F.col("name_id").alias("line"))


def _texts(spark, sf):
    return records(spark, sf).select(F.concat_ws("#", "scientific_name", "rec_id").alias("scientific_name"), F.lit(None).cast("string").alias("extract"), F.col("descriptions").alias("extracts"), "ord", "observations_count")


def species_worklist(spark, sf):
    """All species to work on, of the records and the listings, with their aliases."""
    d = W.species_worklist(None, _first(spark, sf), _checklist(spark, sf), _manual(spark, sf))
    return d.select("scientific_name", "taxon_group", "ebird_code", F.array_join("scientific_name_aliases", "|").alias("aliases"))


def codes_by_species(spark, sf):
    return W.codes_by_species(_first(spark, sf), _checklist(spark, sf))


def pages_by_species(spark, sf):
    return W.pages_by_species(_first(spark, sf))


def ids_by_species(spark, sf):
    return W.ids_by_species(_first(spark, sf), _checklist(spark, sf))


def observation_counts(spark, sf):
    return W.observation_counts(_first(spark, sf))


def over_thresholds(spark, sf):
    return W.over_thresholds(_first(spark, sf), 500, 50_000).select("rec_id")


def fetched_only(spark, sf):
    """Checks of pages, of the species that are asked for alone."""
    return W.fetched_only(checks(spark, sf), records(spark, sf), "scientific_name").groupBy("scientific_name").agg(F.count("*").alias("n"))


def names_by_code(spark, sf):
    """Names by species (as the code) over the locales of the taxonomy service."""
    locale = F.coalesce(*[F.when(F.col("locale") == k, v) for k, v in _AS_TAXONOMY.items()], F.col("locale"))
    d = names(spark, sf).select(F.col("scientific_name").alias("code"), locale.alias("locale"), F.col("common_name").alias("name"), F.col("name_id").alias("ord"))
    return W.names_by_code(d).select("code", F.explode("names").alias("locale", "name"))


def owners_by_file(spark, sf):
    """Species of each English name, as if it were a file."""
    d = names(spark, sf).where("locale = 'en'").select(F.lower("common_name").alias("file"), "scientific_name")
    return W.by_file(d).select("file", F.array_join("owners", "|").alias("owners"))


def orphan_files(spark, sf):
    """Names of the checks' pages that no record's page has."""
    have = checks(spark, sf).where("page_title is not null").select(F.col("page_title").alias("file"))
    return W.orphans(have, records(spark, sf).select(F.col("scientific_name").alias("file")))


def translation_work(spark, sf):
    """Texts to translate, the species seen most often first."""
    t = _texts(spark, sf)
    counts = t.select("scientific_name", F.col("observations_count").alias("observations"))
    return W.translation_work(t, LOCALES, 40, counts).select("scientific_name", "locale", F.md5("english").alias("english"), "turn")


def generation_work(spark, sf):
    """Texts to shorten, translate or write, within one budget."""
    t = _texts(spark, sf)
    made = t.where("ord % 4 = 0").select("scientific_name", F.create_map(F.lit("de"), F.lit("x"), F.lit("fr"), F.lit("")).alias("extracts"))
    d = W.generation_work(t, made, LOCALES, 60, True, 2500)
    return d.select("phase", "scientific_name", "locale", F.array_join("missing", ",").alias("missing"), F.array_join("sources", ",").alias("sources"), "turn")


def work_by_locale(spark, sf):
    t = _texts(spark, sf)
    return W.work_by_locale(W.translation_work(t, LOCALES, 40), 3)


def stored_translations(spark, sf):
    """The newest text of each species and language put into the records' texts."""
    t = records(spark, sf).groupBy("scientific_name").agg(F.max_by("descriptions", "ord").alias("extracts"))
    t = t.withColumns({"extract_sources": F.lit(None).cast("map<string,string>"), "translation": F.lit(None).cast(f"map<string,{W.TRANSLATION}>")})
    r = documents(spark, sf).where("text is not null").select("scientific_name", F.col("lang").alias("locale"), "text", F.col("source"), F.lit("mt").alias("service"), F.col("doc_id").alias("ord"))
    d = W.store_translations(t, r).select("scientific_name", "extract_sources", "translation", F.explode("extracts").alias("locale", "text"))
    return d.select("scientific_name", "locale", F.md5("text").alias("text"), F.element_at("extract_sources", F.col("locale")).alias("source"), F.element_at("translation", F.col("locale"))["service"].alias("service"))


def resolved_in_steps(spark, sf):
    """Listed names by code, by page, by English name, then by a synonym."""
    r = records(spark, sf)
    species = r.select("scientific_name")
    code = r.select("scientific_name", F.col("ebird_code").alias("value")).where("rec_id % 3 = 0")
    page = r.select("scientific_name", F.col("gbif_id").alias("value")).where("rec_id % 2 = 0")
    english = listings(spark, sf).select(F.lower("english_name").alias("e"), F.col("xc_name").alias("value")).join(r.select(F.lower("common_name").alias("e"), "scientific_name"), "e").select("scientific_name", "value")
    synonyms = r.select("scientific_name", F.posexplode("scientific_name_aliases").alias("pos", "synonym"), "rec_id").withColumn("pos", F.struct("rec_id", "pos"))
    known = listings(spark, sf).select(F.col("xc_name").alias("name"), F.col("xc_id").cast("string").alias("value"))
    return W.resolve_in_steps(species, [("code", code), ("page", page), ("english", english)], synonyms, known)


QUERIES = {f.__name__: f for f in (species_worklist, codes_by_species, pages_by_species, ids_by_species, observation_counts, over_thresholds, fetched_only, names_by_code, owners_by_file, orphan_files, translation_work, generation_work, work_by_locale, stored_translations, resolved_in_steps)}



def _clean(c: str) -> str:
    return f"coalesce(regexp_matches(trim({c}), '{SQL_BINOMIAL}'), false) and not regexp_matches({c}, '{SQL_BAD}')"


_CHECK = "(select xc_id as ord, xc_name as name, case when n_recordings % 2 = 0 then 'x' || xc_id end as code, english_name as english from xc_species)"
_LAST = "(select * from species_records qualify row_number() over (partition by scientific_name order by rec_id desc) = 1)"
_LAST_ID = "(select * from species_records where inat_id is not null qualify row_number() over (partition by scientific_name order by rec_id desc) = 1)"
_T = "(select scientific_name || '#' || rec_id as scientific_name, descriptions as extracts, rec_id as ord, observations_count from species_records)"
_WORK = f"""(select scientific_name, l as locale, extracts['en'] as english, ord, i, coalesce(observations_count, 0) as seen from {_T}, (select unnest({LOCALES}) as l, generate_subscripts({LOCALES}, 1) as i)
    where {words_sql("extracts['en']")} >= 40 and coalesce(extracts[l], '') = '')"""
ORACLE = {
    "species_worklist": f"""with u as (select scientific_name, taxon_group, ebird_code, scientific_name_aliases as a, rec_id as ord, 1 as s from species_records union all select name, 'Aves', code, null, ord, 2 from {_CHECK}),
        f as (select * from u where {_clean('scientific_name')} qualify row_number() over (partition by scientific_name order by s, ord) = 1),
        al as (select scientific_name, 0 as s, unnest(a) as alias, generate_subscripts(a, 1) as p from f union all select scientific_name, 1, common_name, name_id from name_rows where locale = 'en' and name_id % 3 = 0 and {_clean('scientific_name')} and {_clean('common_name')}),
        c as (select scientific_name, trim(alias) as alias, s, p from al where {_clean('alias')} qualify row_number() over (partition by scientific_name, lower(trim(alias)) order by s, p) = 1),
        g as (select scientific_name, string_agg(alias, '|' order by s, p) as aliases from c group by 1)
        select scientific_name, taxon_group, ebird_code, coalesce(aliases, '') as aliases from f left join g using (scientific_name)""",
    "codes_by_species": f"""with o as (select scientific_name, trim(ebird_code) as ebird_code from {_LAST_ID} where trim(ebird_code) <> '')
        select * from o union all select name, arg_min(code, ord) from {_CHECK} where name <> '' and code <> '' and name not in (select scientific_name from o) group by 1""",
    "pages_by_species": f"select scientific_name, trim(wikipedia_urls['en']) as wikipedia_url from {_LAST_ID} where regexp_matches(trim(scientific_name), '{SQL_BINOMIAL}') and trim(wikipedia_urls['en']) <> ''",
    "ids_by_species": f"""with o as (select scientific_name, inat_id from {_LAST_ID} where regexp_matches(trim(scientific_name), '{SQL_BINOMIAL}'))
        select * from o union all select distinct name, null::bigint from {_CHECK} where name <> '' and name not in (select scientific_name from o)""",
    "observation_counts": f"select scientific_name, coalesce(observations_count, 0) as observations from {_LAST} where scientific_name is not null",
    "over_thresholds": "select rec_id from species_records where coalesce(observations_count % 1000, 0) >= 500 or coalesce(observations_count, 0) >= 50000",
    "fetched_only": "select scientific_name, count(*) as n from wiki_quality where scientific_name in (select scientific_name from species_records) group by 1",
    "names_by_code": f"""with n as (select scientific_name as code, locale, arg_max(common_name, name_id) as name from name_rows where common_name <> '' group by 1, 2),
        e as (select code, name as en from n where locale = 'en')
        select code, locale, name from n left join e using (code) where scientific_locale(locale) and (en is null or name <> en) union all select code, 'en', en from e""".replace(
        "scientific_locale(locale)", f"locale <> 'en' and locale in ({', '.join(repr(x) for x in [*W.TAXONOMY_LOCALES, 'pt'])})"
    ),
    "owners_by_file": "select lower(common_name) as file, string_agg(distinct scientific_name, '|' order by scientific_name) as owners from name_rows where locale = 'en' and common_name is not null and scientific_name is not null group by 1",
    "orphan_files": "select distinct page_title as file from wiki_quality where page_title is not null and page_title not in (select scientific_name from species_records)",
    "translation_work": f"select scientific_name, locale, md5(english) as english, row_number() over (order by seen desc, ord, i) as turn from {_WORK}",
    "generation_work": f"""with t as (select scientific_name, ord, map_from_entries([e for e in coalesce(map_entries(extracts), []) if e.value <> '']) as has, case when ord % 4 = 0 then ['de'] else [] end as made from {_T}),
        p as (select 1 as phase, scientific_name, ord, e.key as locale, '' as missing, '' as sources from (select *, unnest(map_entries(has)) as e from t) where not list_contains(made, e.key) and {words_sql('e.value')} > 60
          union all select 2, scientific_name, ord, 'en', array_to_string([x for x in {LOCALES} if not list_contains(map_keys(has), x) and not list_contains(made, x)], ','), '' from t where list_contains(map_keys(has), 'en')
          union all select 3, scientific_name, ord, 'en', '', array_to_string(list_sort([x for x in map_keys(has) if x <> 'en']), ',') from t where not list_contains(map_keys(has), 'en'))
        select * exclude (ord), row_number() over (order by phase, ord, locale) as turn from p where not (phase = 2 and missing = '') and not (phase = 3 and sources = '') qualify turn <= 2500""",
    "work_by_locale": f"select locale, count(*) as n from {_WORK} group by 1 order by 2 desc, 1 limit 3",
    "stored_translations": f"""with e as (select scientific_name, e.key as locale, e.value as text from (select scientific_name, unnest(map_entries(descriptions)) as e from (select scientific_name, arg_max(descriptions, rec_id) as descriptions from species_records where descriptions is not null group by 1))),
        r as (select scientific_name, lang as locale, arg_max(text, doc_id) as text, arg_max(coalesce(source, ''), doc_id) as source from documents where text is not null and scientific_name is not null and lang is not null group by 1, 2)
        select coalesce(r.scientific_name, e.scientific_name) as scientific_name, coalesce(r.locale, e.locale) as locale, md5(coalesce(r.text, e.text)) as text, nullif(r.source, '') as source, case when r.scientific_name is not null then 'mt' end as service
        from e full join r on e.scientific_name = r.scientific_name and e.locale = r.locale""",
    "resolved_in_steps": """with s as (select distinct scientific_name from species_records), a as (select scientific_name, min(ebird_code) as a from species_records where rec_id % 3 = 0 and ebird_code <> '' group by 1),
        b as (select scientific_name, min(gbif_id) as b from species_records where rec_id % 2 = 0 and gbif_id <> '' group by 1),
        c as (select scientific_name, min(x.xc_name) as c from species_records join xc_species x on lower(english_name) = lower(common_name) where x.xc_name <> '' group by 1),
        y as (select scientific_name, rec_id, unnest(scientific_name_aliases) as synonym, generate_subscripts(scientific_name_aliases, 1) as p from species_records),
        k as (select xc_name as name, min(xc_id::varchar) as value from xc_species where xc_name is not null group by 1),
        z as (select scientific_name, synonym, value from y join k on synonym = name qualify row_number() over (partition by scientific_name order by rec_id, p) = 1)
        select scientific_name, coalesce(a, b, c, value) as value, case when a is not null then 'code' when b is not null then 'page' when c is not null then 'english' when value is not null then 'synonym' end as step,
          case when coalesce(a, b, c) is null then synonym end as matched_name from s left join a using (scientific_name) left join b using (scientific_name) left join c using (scientific_name) left join z using (scientific_name)""",
}
