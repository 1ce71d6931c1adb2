"""Catalog queries: filter, sort, page, project, look up, search, suggest, export."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import catalog as C
from taxaloom.plans.common import RECORDS_SQL, listings, records


def catalog_filters(spark, sf):
    d = C.filters(records(spark, sf), group="aves", has_image="true", has_description="yes", description_source="Wikipedia, ebird", min_observations=1, max_observations=500)
    return d.select("rec_id", "scientific_name", "observations_count")


def catalog_sort_page(spark, sf):
    """Second page by observation count, most first: nulls lead."""
    return C.page(records(spark, sf), "-observations_count", 2, 50).select("rec_id", "observations_count")


def catalog_sort_text(spark, sf):
    """First page by common name: nulls last, case ignored."""
    return C.page(records(spark, sf), "common_name", 1, 100).select("rec_id", "common_name")


def catalog_projection(spark, sf):
    d = C.project(records(spark, sf), fields="rec_id,scientific_name,common_names", exclude="scientific_name", locale="de")
    return d.select("rec_id", "scientific_name", F.element_at("common_names", F.lit("de")).alias("name_de"), F.coalesce(F.size("common_names"), F.lit(0)).cast("bigint").alias("n"))


def species_lookup(spark, sf):
    """What the names of the other source's list mean in the catalog."""
    x = listings(spark, sf)
    ids = x.select(F.col("xc_name").alias("i")).unionByName(x.select(F.col("english_name").alias("i"))).unionByName(x.select(F.col("local_name").alias("i")))
    return C.lookup(records(spark, sf), ids.where("i <> ''"), "i")



def ranked_search(spark, sf):
    return C.search(records(spark, sf), "Owl").select("rec_id", F.round("score", 6).alias("score"))


def ranked_search_terms(spark, sf):
    return C.search(records(spark, sf), "hill b", group="Aves").select("rec_id", F.round("score", 6).alias("score"))


def suggest(spark, sf):
    return C.suggest(records(spark, sf), "wren", 20, "de")


def group_counts(spark, sf):
    return C.group_counts(records(spark, sf))


def locale_list(spark, sf):
    return C.locales(records(spark, sf))


def api_csv_cells(spark, sf):
    return C.csv_cells(records(spark, sf), "rec_id,scientific_name,scientific_name_aliases,observations_count,descriptions,common_name_alt")


def locale_first_records(spark, sf):
    """The three most observed records of each group."""
    d = records(spark, sf)
    return C.rank_within(d, ["taxon_group"], [F.desc_nulls_last("observations_count"), F.col("rec_id")], 3).select("taxon_group", "rec_id")


QUERIES = {f.__name__: f for f in (catalog_filters, catalog_sort_page, catalog_sort_text, catalog_projection, species_lookup, ranked_search, ranked_search_terms, suggest, group_counts, locale_list, api_csv_cells, locale_first_records)}

_R = RECORDS_SQL
_FOLD = "strip_accents(lower({0}))"


def _search_sql(q: str, group: str = "") -> str:
    """The scored records of a query, as SQL over folded columns."""
    n = q.lower()
    terms = n.split()
    f = _FOLD.format
    every = lambda test: " and ".join(test(t) for t in terms)
    return f"""(with t as (select *, lower(coalesce(scientific_name, '')) as sci, {f("coalesce(common_name, '')")} as com,
          list_transform(list_filter(coalesce(scientific_name_aliases, []), lambda a: a is not null and a <> scientific_name), lambda a: {f('a')}) as al,
          {f("concat_ws(' ', coalesce(scientific_name, ''), coalesce(common_name, ''), coalesce(common_name_alt, ''))")} as own,
          {f("coalesce(array_to_string(map_values(common_names), ' '), '')")} as locals from {_R}),
        u as (select *, concat_ws(' ', own, array_to_string(al, ' '), locals) as whole, regexp_split_to_array(com, '\\s+') as words from t {f"where lower(taxon_group) = '{group.lower()}'" if group else ''})
        select *, case when com = '{n}' or sci = '{n}' then 200 when list_contains(al, '{n}') then 190
          when len(list_filter(al, lambda a: starts_with(a, '{n} '))) > 0 then 150 when starts_with(com, '{n} ') then 160
          when list_contains(words, '{n}') then 140 when {every(lambda t: f"list_contains(words, '{t}')")} then 130
          when starts_with(sci, '{n}') then 120 when list_contains(regexp_split_to_array(sci, '\\s+'), '{n}') then 110
          when {every(lambda t: f"len(list_filter(words, lambda w: starts_with(w, '{t}'))) > 0")} then 90
          when contains(com, '{n}') then 70 when contains(sci, '{n}') then 60 else 30 end
          + least(coalesce(observations_count, 0) / 1000000, 10.0) as score from u where {every(lambda t: f"contains(whole, '{t}')")})"""


ORACLE = {
    "catalog_filters": f"""select rec_id, scientific_name, observations_count from {_R} where lower(taxon_group) = 'aves' and image_url <> '' and coalesce(descriptions['en'], '') <> ''
        and lower(description_source) in ('wikipedia', 'ebird') and coalesce(observations_count, 0) between 1 and 500""",
    "catalog_sort_page": f"select rec_id, observations_count from {_R} order by observations_count desc nulls first, ord limit 50 offset 50",
    "catalog_sort_text": f"select rec_id, common_name from {_R} order by lower(common_name) asc nulls last, ord limit 100",
    "catalog_projection": f"select rec_id, scientific_name, common_names['de'] as name_de, case when common_names['de'] is null then 0 else 1 end as n from {_R}",
    "species_lookup": f"""with r as (select * from {_R}), i as (select distinct i as identifier from (select xc_name as i from xc_species union all select english_name from xc_species union all select local_name from xc_species) where i <> ''),
        k as (
          select lower(scientific_name) as key, 1 as p, 0 as t, max(ord) as ord from r group by 1
          union all select lower(a), 2, 0, min(ord) from (select unnest(scientific_name_aliases) as a, ord from r) group by 1
          union all select lower(common_name), 3, 0, max(ord) from r group by 1
          union all select lower(a), 3, 1, min(ord) from (select unnest(map_values(common_names)) as a, ord from r) group by 1
          union all select lower(birdnet_id), 4, 0, max(ord) from r group by 1
          union all select lower(ebird_code), 5, 0, max(ord) from r group by 1
          union all select lower(xc_name), 7, 0, max(ord) from r where xc_name <> scientific_name group by 1
          union all select inat_id::varchar, 8, 0, max(ord) from r group by 1)
        select identifier, arg_min(k.ord, k.p * 10 + k.t) as ord from i left join (select * from k where key <> '') k on lower(identifier) = key group by 1""",
    "ranked_search": f"select rec_id, round(score, 6) as score from {_search_sql('Owl')}",
    "ranked_search_terms": f"select rec_id, round(score, 6) as score from {_search_sql('hill b', 'Aves')}",
    "suggest": f"select scientific_name, coalesce(nullif(common_names['de'], ''), common_name) as common_name, round(score, 6) as score from {_search_sql('wren')} order by score desc, ord limit 20",
    "group_counts": f"select coalesce(nullif(taxon_group, ''), 'unknown') as taxon_group, count(*) as n from {_R} group by 1",
    "locale_list": f"select distinct l as locale from (select unnest(map_keys(common_names)) as l from {_R}) where l <> 'en'",
    "api_csv_cells": f"""select rec_id::varchar as rec_id, coalesce(scientific_name, '') as scientific_name, coalesce(to_json(scientific_name_aliases)::varchar, '') as scientific_name_aliases,
        coalesce(observations_count::varchar, '') as observations_count, coalesce(common_name_alt, '') as common_name_alt from {_R}""",
    "locale_first_records": f"select taxon_group, rec_id from (select taxon_group, rec_id, row_number() over (partition by taxon_group order by observations_count desc nulls last, rec_id) as k from {_R}) where k <= 3",
}
