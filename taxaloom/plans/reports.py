"""Full reports, single records, and the build's first stages over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import catalog as C
from taxaloom.operators import geometry as G
from taxaloom.operators import quality as Q
from taxaloom.plans import build
from taxaloom.plans.aggregates import _AUDIT, _REASONS
from taxaloom.plans.catalog import ORACLE as _CATALOG
from taxaloom.plans.common import EXTERNAL, IDS, RECORDS_SQL, SQL_BAD, SQL_BINOMIAL, listings, records, words_sql
from taxaloom.session import table

REQUIRED = ["birdnet_id", "common_name", "taxon_group", "description_source"]
GROUPS = ["Aves", "Mammalia", "Insecta"]


def quality_report_full(spark, sf):
    """All eleven columns of the quality report."""
    by_group = {"Insecta": 55}
    d = Q.drop_reasons(Q.score(records(spark, sf), IDS, EXTERNAL), 40, by_group, True, 1)
    return Q.quality_report(d, 40, by_group)


def description_report(spark, sf):
    """All ten columns of the description report."""
    return Q.description_report(records(spark, sf))


def audit_gaps(spark, sf):
    return Q.audit_gaps(records(spark, sf), EXTERNAL)


def audit_samples(spark, sf):
    """The first 15 records of each finding."""
    return Q.audit_samples(records(spark, sf), REQUIRED, 15)


def search_sorted_page(spark, sf):
    """The second page of hits, sorted by a field after they were found."""
    return C.search_page(records(spark, sf), "owl", sort="-observations_count", number=2, size=5, fields="rec_id,observations_count")


def species_record(spark, sf):
    """One record by its English name in any case, with its names in one language."""
    d = records(spark, sf)
    d = C.species(d, "COMMON OWL", fields="rec_id,scientific_name,common_names", locale="de").unionByName(C.species(d, "BN00007", fields="rec_id,scientific_name,common_names", locale="de"))
    return d.select("rec_id", "scientific_name", F.size("common_names").cast("bigint").alias("names"))


def subjects(spark, sf):
    """The subject of each label's image, from boxes made of embeddings."""
    e = lambda i: F.get("embedding", F.lit(i)).cast("double")
    x, y = 300 + 200 * e(0), 300 + 200 * e(1)
    d = table(spark, sf, "embeddings").select(
        F.col("label").alias("image"), "vec_id", x.alias("x1"), y.alias("y1"), (x + 90).alias("x2"), (y + 70).alias("y2"), (0.3 + F.abs(e(2)) / 10).alias("score"), F.pmod("vec_id", F.lit(40)).alias("class_id"),
        F.lit(0.5).alias("scale"), F.lit(20).alias("pad_x"), F.lit(40).alias("pad_y"), F.lit(900).alias("w"), F.lit(700).alias("h"),
    )
    return G.subjects(d, "image", "vec_id")


def _sources(spark, sf):
    r = records(spark, sf)
    latest = r.join(r.groupBy("scientific_name").agg(F.max("rec_id").alias("rec_id")), ["scientific_name", "rec_id"])
    photo = F.lit(None).cast("struct<url:string,attribution:string,license:string>")
    inat = latest.select("ord", "scientific_name", "inat_id", "taxon_group", F.col("common_name").alias("preferred_common_name"), "common_names", F.coalesce(F.col("observations_count") % 50 == 0, F.lit(False)).alias("extinct"),
                         "observations_count", "image_url", F.lit("(c) Ann").alias("image_attribution"), F.lit("cc-by").alias("image_license"), photo.alias("obs_photo"))
    x = listings(spark, sf).where("xc_name <> ''")
    checklist = x.select(F.col("xc_id").alias("ord"), F.col("xc_name").alias("name"), F.concat(F.lit("x"), F.col("xc_id").cast("string")).alias("code"), F.col("english_name").alias("english"), F.col("english_name").alias("english_clements"))
    code = x.groupBy(F.lower("english_name").alias("_e")).agg(F.concat(F.lit("x"), F.max("xc_id").cast("string")).alias("ebird_code"))
    linked = latest.drop("ebird_code").where("rec_id % 2 = 0").join(code, F.lower(F.coalesce(F.nullif("common_name_alt", F.lit("")), "common_name")) == F.col("_e")).select("scientific_name", "ebird_code")
    none = F.lit(None).cast("string")
    wikidata = linked.select("scientific_name", "ebird_code", *[none.alias(c) for c in ("gbif_id", "ncbi_id", "avibase_id", "birdlife_id")], F.lit(None).cast("map<string,string>").alias("labels"),
                             F.lit(None).cast("struct<url:string,attribution:string,license:string,license_url:string>").alias("image"), F.lit(None).cast("array<string>").alias("aliases"))
    sound = latest.where("record_type = 'sound_class'").select("ord", "scientific_name", "taxon_group", "common_name", "common_names", "image_url")
    empty = lambda ddl: spark.createDataFrame([], ddl)
    found = "scientific_name string, {0} string, matched_name string, aliases array<string>"
    return build.Sources(
        inat=inat, checklist=checklist, wikidata=wikidata, sound_classes=sound, ebird=empty("ord int, scientific_name string, ebird_code string, description string, image_url string, image_attribution string"),
        wikipedia=latest.select("scientific_name", "wikipedia_urls", F.element_at("descriptions", F.lit("en")).alias("extract"), F.col("descriptions").alias("extracts")), macaulay=empty(found.format("ml_taxon_code")), xc=empty(found.format("xc_name")), observationorg=empty("scientific_name string, observationorg_id bigint, matched_name string, aliases array<string>"),
        translate=empty("scientific_name string, extracts map<string,string>"), ebird_names=empty("code string, locale string, name string"), overrides=empty("scientific_name string, image_url string, image_author string, image_source string"),
        aliases=empty("scientific_name string, alias string"), groups=GROUPS,
    )


def build_reasons(spark, sf):
    """Rows of the first source by the reason that leaves them out of the build."""
    s = _sources(spark, sf)
    return build.included(s.inat, s.groups).groupBy(F.coalesce("reason", F.lit("included")).alias("reason")).agg(F.count("*").alias("n"))


def build_taxonomy(spark, sf):
    """The build's taxonomy: matched species, unmatched ones of the checklist, sound classes."""
    return build.taxonomy(_sources(spark, sf)).select("scientific_name", "taxon_group", "record_type", "common_name", "ebird_code", "match_source")


def build_records(spark, sf):
    """The build's records with their texts, images and scores."""
    d = build.records(_sources(spark, sf))
    return d.select("scientific_name", "match_source", "image_source", "image_author", "description_source", F.size("descriptions").cast("bigint").alias("texts"), F.coalesce(F.element_at("common_names", F.lit("en")), F.lit("")).alias("english"), F.array_contains("quality_flags", "missing_image").alias("no_image"))


QUERIES = {f.__name__: f for f in (quality_report_full, description_report, audit_gaps, audit_samples, search_sorted_page, species_record, subjects, build_reasons, build_taxonomy, build_records)}

_R = RECORDS_SQL
_LATEST = f"(select * from {_R} qualify row_number() over (partition by scientific_name order by rec_id desc) = 1)"
_REASON = f"case when inat_id is null then 'no_id' when not coalesce(regexp_matches(trim(scientific_name), '{SQL_BINOMIAL}'), false) then 'not_species' when coalesce(observations_count % 50 = 0, false) then 'extinct' when not coalesce(taxon_group in ('Aves', 'Mammalia', 'Insecta'), false) then 'group' else 'included' end"
#: The claims of the build row by row, then its taxonomy.
_TAXONOMY = f"""with recursive i as (select *, {_REASON} as reason from {_LATEST}), c as (select xc_id as ord, xc_name as name, 'x' || xc_id as code, english_name as english from xc_species where xc_name <> ''),
    k as (select scientific_name as name, code from {_LATEST} r join (select lower(english_name) as e, 'x' || max(xc_id) as code from xc_species where xc_name <> '' group by 1) on lower(coalesce(nullif(common_name_alt, ''), common_name)) = e where rec_id % 2 = 0),
    e as (select lower(english) as e, arg_max(name, ord) as named from c where english is not null group by 1), b as (select * from i where reason = 'included' and taxon_group = 'Aves'),
    x as (select rec_id as ord, row_number() over (order by rec_id) as n, d.name as direct, e.named, c.name as linked from b left join (select distinct name from c) d on d.name = b.scientific_name
        left join e on e.e = lower(b.common_name) left join k on k.name = b.scientific_name left join c on c.code = k.code),
    s as (select cast(0 as bigint) as n, cast(null as bigint) as ord, cast(null as varchar) as claim, cast(null as varchar) as source, cast([] as varchar[]) as claimed
      union all select x.n, x.ord, t.claim, t.source, case when t.claim is null then claimed else list_append(claimed, t.claim) end from s join x on x.n = s.n + 1,
        lateral (select case when direct is not null then direct when named is not null and not list_contains(claimed, named) then named else linked end as claim,
          case when direct is not null then 'direct' when named is not null and not list_contains(claimed, named) then 'named' when linked is not null then 'linked' end as source) t),
    o as (select name, arg_max(code, ord) as code, arg_max(coalesce(english, ''), ord) as english from c group by 1),
    d as (select scientific_name, taxon_group, 'species' as record_type, case when s.source in ('direct', 'named') then coalesce(nullif(o.english, ''), '') else coalesce(common_name, '') end as common_name, coalesce(o.code, '') as ebird_code, coalesce(s.source, 'non_bird') as match_source, s.claim
        from (select * from i where reason = 'included') i left join s on s.ord = i.rec_id and s.n > 0 left join o on o.name = s.claim where taxon_group <> 'Aves' or s.source is not null),
    m as (select name, arg_min(code, ord) as code, arg_min(coalesce(english, ''), ord) as english from c where name not in (select claim from d where claim is not null) and name not in (select scientific_name from d) group by 1),
    z as (select scientific_name, taxon_group, 'sound_class' as record_type, coalesce(common_name, scientific_name) as common_name, '' as ebird_code, 'sound_class' as match_source from {_LATEST} where record_type = 'sound_class'),
    u as (select * exclude (claim) from d union all select name, 'Aves', 'species', english, code, 'checklist_only' from m)
    select * from u where scientific_name not in (select scientific_name from z) union all select * from z"""
_REPORT_PAIRS = "array_to_string([e.key || ':' || e.value for e in list_sort(coalesce(map_entries(description_sources), [])) if e.value is not null], '|')"
_SEARCH = _CATALOG["ranked_search"]
ORACLE = {
    "quality_report_full": f"""select ord, case when reasons <> '' then 'drop' else 'keep' end as action, quality_score::bigint as score, coalesce(scientific_name, '') as scientific_name, coalesce(common_name, '') as common_name, coalesce(taxon_group, '') as taxon_group, flags, reasons as drop_reasons,
        case when record_type = 'sound_class' then 0 else th end::bigint as threshold, external_ids::bigint as external_id_count, coalesce(description_source, '') as description_source, case when image_url is not null then '1' else '0' end as has_image from {_REASONS}""",
    "description_report": f"""select r.rec_id as ord, scientific_name, birdnet_id, coalesce(taxon_group, '') as taxon_group, a.locale, a.status, a.words, coalesce(nullif(description_sources[a.locale], ''), case when a.locale = 'en' then description_source end, '') as source,
        coalesce(nullif(wikipedia_urls['en'], ''), '') as wikipedia_en_url, array_to_string(list_sort(coalesce(map_keys(descriptions), [])), '|') as available_description_locales, {_REPORT_PAIRS} as available_source_locales
        from {_AUDIT} a join species_records r on r.rec_id = a.rec_id""",
    "audit_gaps": f"select unnest([{', '.join(repr(f'without_{c}') for c in [*EXTERNAL, 'image'])}]) as finding, unnest([{', '.join(f'count(*) filter (coalesce({c}::varchar, {chr(39) * 2}) in ({chr(39) * 2}, {chr(39)}0{chr(39)}))' for c in [*EXTERNAL, 'image_url'])}]) as n from {_R}",
    "audit_samples": f"""with r as (select *, coalesce(record_type, 'species') <> 'sound_class' as sp, {words_sql("descriptions['en']")} as w from {_R}),
        f as ({' union all '.join(f"select 'missing_{c}' as finding, ord, scientific_name, null as words from r where coalesce({c}, '') = ''" for c in REQUIRED)}
          union all select 'short_english', ord, scientific_name, w from r where sp and w < 40
          union all select 'bad_scientific_name', ord, scientific_name, null from r where sp and not (coalesce(regexp_matches(trim(scientific_name), '{SQL_BINOMIAL}'), false) and not regexp_matches(coalesce(scientific_name, ''), '{SQL_BAD}'))
          union all select 'bad_common_name', ord, scientific_name, null from r where not (trim(coalesce(common_name, '')) <> '' and not regexp_matches(coalesce(common_name, ''), '{SQL_BAD}') and not regexp_matches(trim(coalesce(common_name, '')), '\\s{{2,}}')))
        select finding, ord, scientific_name, words::bigint as words from f qualify row_number() over (partition by finding order by ord) <= 15""",
    "search_sorted_page": f"select rec_id, observations_count from ({_SEARCH}) join {_R} r using (rec_id) order by observations_count desc nulls first, score desc, ord limit 5 offset 5",
    "species_record": f"""select rec_id, scientific_name, coalesce(len([k for k in map_keys(common_names) if k = 'de']), 0)::bigint as names from {_R} where ord = (select max(ord) from {_R} where lower(common_name) = 'common owl') or ord = (select max(ord) from {_R} where lower(birdnet_id) = 'bn00007')""",
    "subjects": """with b as (select label as image, vec_id, 300 + 200 * embedding[1]::double as x, 300 + 200 * embedding[2]::double as y, 0.3::double + abs(embedding[3]::double) / 10 as score, vec_id % 40 between 14 and 23 as animal from embeddings),
        t as (select * from b where score > 0.25::double qualify row_number() over (partition by image order by animal desc, score desc, vec_id) = 1),
        p as (select image, greatest(0, least(trunc((x - 20) / 0.5::double)::bigint, 900)) as x1, greatest(0, least(trunc((y - 40) / 0.5::double)::bigint, 700)) as y1, greatest(0, least(trunc((x + 70) / 0.5::double)::bigint, 900)) as x2, greatest(0, least(trunc((y + 30) / 0.5::double)::bigint, 700)) as y2 from t)
        select * from p where x2 - x1 >= 10 and y2 - y1 >= 10""",
    "build_reasons": f"select {_REASON} as reason, count(*) as n from {_LATEST} group by 1",
    "build_taxonomy": _TAXONOMY,
}
