"""Join queries: cascades, anti and full joins, aliases, fallbacks, title chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.functions import text as T
from taxaloom.operators import merge, ordering, quality, resolve
from taxaloom.plans.common import RECORDS_SQL, checks, documents, listings, names, records


def match_cascade(spark, sf):
    """Listings resolved against the records by name, English name, or code, claims in listing order."""
    r = records(spark, sf)
    rows = listings(spark, sf).select(F.col("xc_id").alias("ord"), F.col("xc_name").alias("name"), F.col("english_name").alias("english"))
    checklist = r.select("ord", F.col("scientific_name").alias("name"), F.col("common_name").alias("english"), F.nullif("ebird_code", F.lit("")).alias("code"))
    links = ordering.last_wins(r.where("xc_name <> '' and ebird_code <> ''"), ["xc_name"], "ord", ["ebird_code"]).select(F.col("xc_name").alias("name"), F.col("ebird_code").alias("code"))
    return resolve.match_cascade(rows, checklist, links)


def unmatched_append(spark, sf):
    """Species of the names table that no record has, and the records' species, once each."""
    own = records(spark, sf).select("scientific_name", F.lit("record").alias("origin"))
    other = names(spark, sf).select("scientific_name", F.lit("names").alias("origin"))
    return ordering.union_first_wins([own, other], ["scientific_name"], ["origin"])


def star_merge(spark, sf):
    """Records with their count of names, checks and documents, and the best listing of the same name."""
    r = records(spark, sf).select("rec_id", "scientific_name")
    n = names(spark, sf).groupBy("scientific_name").agg(F.count("*").alias("names"))
    c = checks(spark, sf).groupBy("scientific_name").agg(F.count("*").alias("checks"))
    d = documents(spark, sf).groupBy("scientific_name").agg(F.count("*").alias("documents"))
    x = listings(spark, sf).groupBy(F.col("xc_name").alias("scientific_name")).agg(F.min("xc_id").alias("xc_id"))
    for other in (n, c, d, x):
        r = r.join(other, "scientific_name", "left")
    return r.select("rec_id", *[F.coalesce(k, F.lit(0)).alias(k) for k in ("names", "checks", "documents")], "xc_id")


def unknown_override_keys(spark, sf):
    return resolve.unknown_keys(names(spark, sf), records(spark, sf), "scientific_name")


def alias_claims(spark, sf):
    """Aliases that one species alone claims and that are nobody's own name."""
    return merge.prune_aliases(records(spark, sf).dropDuplicates(["rec_id"]), "scientific_name", "scientific_name_aliases").select("scientific_name", "alias")


def alias_conflicts(spark, sf):
    """Names that several species claim; the other source's names count as aliases too."""
    d = records(spark, sf).select("scientific_name", F.array_append(F.coalesce("scientific_name_aliases", F.array().cast("array<string>")), F.col("common_name")).alias("scientific_name_aliases"))
    return quality.alias_conflicts(d)


def scope_full_outer(spark, sf):
    """Counts of names and checks of each species, of either table, and the larger of both."""
    n = names(spark, sf).groupBy("scientific_name").agg(F.count("*").alias("n_names"))
    c = checks(spark, sf).groupBy("scientific_name").agg(F.count("*").alias("n_checks"))
    d = n.join(c, "scientific_name", "full_outer")
    return d.select("scientific_name", "n_names", "n_checks", F.greatest(F.coalesce("n_names", F.lit(0)), F.coalesce("n_checks", F.lit(0))).alias("most"), F.coalesce("n_checks", "n_names").alias("preferred"))


def count_update(spark, sf):
    """Records with the recordings of a listing of their name; others keep their count."""
    x = listings(spark, sf).groupBy(F.col("xc_name").alias("scientific_name")).agg(F.max("n_recordings").alias("n"))
    d = records(spark, sf).join(x, "scientific_name", "left")
    return d.select("rec_id", F.coalesce("n", "observations_count").alias("n"), F.coalesce(F.col("n") != F.col("observations_count"), F.col("n").isNotNull() & F.col("observations_count").isNull()).alias("changed"))


def missing_names(spark, sf):
    """Listed names that no record has, in order."""
    return listings(spark, sf).select("xc_name").where("xc_name <> ''").distinct().join(records(spark, sf).select(F.col("scientific_name").alias("xc_name")), "xc_name", "left_anti").orderBy("xc_name")


def unambiguous_names(spark, sf):
    """English names that belong to one species alone."""
    return resolve.unambiguous(names(spark, sf).where("locale = 'en'").select(F.lower("common_name").alias("name"), "scientific_name"), "name", "scientific_name")


def fallback_lookup(spark, sf):
    """Listings resolved by name, then alias, then English name, else not."""
    r = records(spark, sf)
    rows = listings(spark, sf).select("xc_id", F.explode(F.array(F.struct(F.lit(1).alias("p"), F.col("xc_name").alias("k")), F.struct(F.lit(2).alias("p"), F.lower("english_name").alias("k")))).alias("q")).select("xc_id", "q.*").where("k <> ''")
    own = r.select(F.col("scientific_name").alias("k"), "scientific_name")
    alias = r.select(F.explode("scientific_name_aliases").alias("k"), "scientific_name")
    english = r.select(F.lower("common_name").alias("k"), "scientific_name")
    d = resolve.fallback_lookup(rows, "k", [("name", own), ("alias", alias), ("english", english)], "scientific_name")
    step = F.when(F.col("matched_by").isNotNull(), F.struct("p", "matched_by", "scientific_name"))
    return d.groupBy("xc_id").agg(F.min(step).alias("b")).select("xc_id", "b.matched_by", "b.scientific_name")


def title_chain(spark, sf):
    """Pages asked for in the checks, through normalisation and redirects (aliases) to records."""
    c = checks(spark, sf).where("page_title is not null").select(F.col("page_title").alias("title")).distinct()
    r = records(spark, sf)
    normalized = c.select(F.col("title").alias("from"), F.replace("title", F.lit("_"), F.lit(" ")).alias("to")).where("`from` <> `to`")
    redirects = r.select(F.explode("scientific_name_aliases").alias("from"), F.col("scientific_name").alias("to")).groupBy("from").agg(F.min("to").alias("to"))
    pages = r.groupBy(F.col("scientific_name").alias("title")).agg(F.min("rec_id").alias("page_id"))
    return resolve.follow_titles(c, normalized, redirects, pages)


def page_lookup(spark, sf):
    """Records by the title of their pages, whatever case and underscores."""
    r = records(spark, sf).select("rec_id", F.explode("wikipedia_urls").alias("locale", "url")).select("rec_id", "locale", T.page_key(T.page_title("url")).alias("page"))
    c = checks(spark, sf).where("page_title is not null").groupBy("locale", T.page_key("page_title").alias("page")).agg(F.count("*").alias("n"))
    return r.join(c, ["locale", "page"]).select("rec_id", "locale", "n")


#: Search terms of substring_match.
TERMS = ("owl", "wren", "marsh", "reed", "tail", "eared", "bush", "cricket", "plain", "hill", "rail", "shrew")


def substring_match(spark, sf):
    """Records whose English name holds a search term anywhere, by term; the terms are a fixed list."""
    terms = F.broadcast(spark.createDataFrame([(t,) for t in TERMS], "term string"))
    d = records(spark, sf).where("common_name is not null").select("rec_id", F.lower("common_name").alias("c"))
    return d.join(terms, F.contains("c", "term")).groupBy("term").agg(F.count("*").alias("records"))


def missing_locale_work(spark, sf):
    """Target locales in which a described species lacks a text."""
    d = records(spark, sf).where("descriptions['en'] <> ''").select("rec_id", "descriptions", F.explode(F.array(*[F.lit(x) for x in ("de", "fr", "es", "pl", "ja")])).alias("locale"))
    return d.where("coalesce(descriptions[locale], '') = ''").select("rec_id", "locale")


def identifier_gaps(spark, sf):
    """Records that lack an identifier or have nothing in the other tables."""
    r = records(spark, sf)
    known = names(spark, sf).select("scientific_name").distinct()
    gap = r.where("coalesce(ebird_code, '') = '' or gbif_id is null").select("rec_id")
    alone = r.join(known, "scientific_name", "left_anti").select("rec_id")
    return gap.union(alone).distinct()


QUERIES = {f.__name__: f for f in (match_cascade, unmatched_append, star_merge, unknown_override_keys, alias_claims, alias_conflicts, scope_full_outer, count_update, missing_names, unambiguous_names, fallback_lookup, title_chain, page_lookup, substring_match, missing_locale_work, identifier_gaps)}

_R = RECORDS_SQL
ORACLE = {
    # The rule row by row, with the list of what is claimed so far.
    "match_cascade": f"""with recursive r as (select ord, scientific_name as name, common_name as english, nullif(ebird_code, '') as code from {RECORDS_SQL}),
        k as (select xc_name as name, arg_max(ebird_code, rec_id) as code from species_records where xc_name <> '' and ebird_code <> '' group by 1),
        e as (select lower(english) as e, arg_max(name, ord) as named from r where english is not null group by 1), c as (select code, arg_max(name, ord) as linked from r where code is not null group by 1),
        x as (select x.xc_id as ord, row_number() over (order by x.xc_id) as i, n.name as direct, e.named, c.linked from xc_species x left join (select distinct name from r) n on n.name = x.xc_name
            left join e on e.e = lower(x.english_name) left join k on k.name = x.xc_name left join c on c.code = k.code),
        s as (select cast(0 as bigint) as i, cast(null as bigint) as ord, cast(null as varchar) as claim, cast(null as varchar) as source, cast([] as varchar[]) as claimed
          union all select x.i, x.ord, t.claim, t.source, case when t.claim is null then claimed else list_append(claimed, t.claim) end from s join x on x.i = s.i + 1,
            lateral (select case when direct is not null then direct when named is not null and not list_contains(claimed, named) then named else linked end as claim,
              case when direct is not null then 'direct' when named is not null and not list_contains(claimed, named) then 'named' when linked is not null then 'linked' end as source) t)
        select ord, claim, source from s where i > 0""",
    "unmatched_append": """select scientific_name, 'record' as origin from (select distinct scientific_name from species_records)
        union all select distinct scientific_name, 'names' from name_rows where scientific_name not in (select scientific_name from species_records)""",
    "star_merge": """with n as (select scientific_name, count(*) as names from name_rows group by 1), c as (select scientific_name, count(*) as checks from wiki_quality group by 1),
        d as (select scientific_name, count(*) as documents from documents group by 1), x as (select xc_name as scientific_name, min(xc_id) as xc_id from xc_species group by 1)
        select rec_id, coalesce(names, 0) as names, coalesce(checks, 0) as checks, coalesce(documents, 0) as documents, xc_id from species_records left join n using (scientific_name) left join c using (scientific_name) left join d using (scientific_name) left join x using (scientific_name)""",
    "unknown_override_keys": "select scientific_name from name_rows except select scientific_name from species_records",
    "alias_claims": """with a as (select scientific_name, unnest(scientific_name_aliases) as alias from species_records), b as (select * from a where trim(alias) <> ''),
        c as (select lower(alias) as l, count(distinct scientific_name) as n from b group by 1)
        select distinct scientific_name, alias from b join c on lower(alias) = l where n = 1 and l not in (select lower(scientific_name) from species_records)""",
    "alias_conflicts": """with a as (select lower(scientific_name) as owner, unnest(list_append(coalesce(scientific_name_aliases, []), common_name)) as alias from species_records union all select lower(scientific_name), scientific_name from species_records),
        b as (select distinct owner, lower(alias) as alias from a where alias is not null) select alias, count(*) as owners from b group by 1 having count(*) > 1""",
    "scope_full_outer": """with n as (select scientific_name, count(*) as n_names from name_rows group by 1), c as (select scientific_name, count(*) as n_checks from wiki_quality where scientific_name is not null group by 1
        union all select null, count(*) from wiki_quality where scientific_name is null having count(*) > 0)
        select coalesce(n.scientific_name, c.scientific_name) as scientific_name, n_names, n_checks, greatest(coalesce(n_names, 0), coalesce(n_checks, 0)) as most, coalesce(n_checks, n_names) as preferred from n full join c on n.scientific_name = c.scientific_name""",
    "count_update": """with x as (select xc_name as scientific_name, max(n_recordings) as n from xc_species group by 1)
        select rec_id, coalesce(n, observations_count) as n, coalesce(n <> observations_count, n is not null and observations_count is null) as changed from species_records left join x using (scientific_name)""",
    "missing_names": "select distinct xc_name from xc_species where xc_name <> '' and xc_name not in (select scientific_name from species_records) order by 1",
    "unambiguous_names": "select lower(common_name) as name, min(scientific_name) as scientific_name from name_rows where locale = 'en' and common_name is not null group by 1 having count(distinct scientific_name) = 1",
    "fallback_lookup": """with q as (select xc_id, 1 as p, xc_name as k from xc_species union all select xc_id, 2, lower(english_name) from xc_species),
        s as (select scientific_name as k, 1 as m, 'name' as matched_by, scientific_name from species_records union all select unnest(scientific_name_aliases), 2, 'alias', scientific_name from species_records union all select lower(common_name), 3, 'english', scientific_name from species_records),
        t as (select k, m, matched_by, min(scientific_name) as scientific_name from s where k is not null group by all),
        u as (select k, arg_min(matched_by, m) as matched_by, arg_min(scientific_name, m) as scientific_name from t group by 1)
        select xc_id, arg_min(matched_by, p) filter (matched_by is not null) as matched_by, arg_min(u.scientific_name, p) filter (matched_by is not null) as scientific_name from (select * from q where k <> '') q left join u using (k) group by 1""",
    "title_chain": """with c as (select distinct page_title as title from wiki_quality where page_title is not null),
        r as (select a as f, min(scientific_name) as t from (select unnest(scientific_name_aliases) as a, scientific_name from species_records) where a is not null group by 1),
        p as (select scientific_name as title, min(rec_id) as page_id from species_records group by 1)
        select c.title, page_id from c left join r on r.f = replace(c.title, '_', ' ') left join p on p.title = coalesce(r.t, replace(c.title, '_', ' '))""",
    "page_lookup": r"""with u as (select rec_id, unnest(map_entries(wikipedia_urls)) as e from species_records), r as (select rec_id, e.key as locale, lower(trim(replace(url_decode(regexp_extract(e.value, '/wiki/([^?#]+)', 1)), '_', ' '))) as page from u),
        c as (select locale, lower(replace(trim(page_title), '_', ' ')) as page, count(*) as n from wiki_quality where page_title is not null group by all)
        select rec_id, locale, n from r join c using (locale, page)""",
    "substring_match": f"""select term, count(*) as records from species_records join (select unnest({list(TERMS)}) as term) t on contains(lower(common_name), term) group by 1""",
    "missing_locale_work": "select rec_id, locale from species_records, (select unnest(['de', 'fr', 'es', 'pl', 'ja']) as locale) where coalesce(descriptions['en'], '') <> '' and coalesce(descriptions[locale], '') = ''",
    "identifier_gaps": """select rec_id from species_records where coalesce(ebird_code, '') = '' or gbif_id is null union select rec_id from species_records where scientific_name not in (select scientific_name from name_rows)""",
}
