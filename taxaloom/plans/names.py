"""Name cleaning, folding and counting."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.functions import maps
from taxaloom.functions import text as T
from taxaloom.functions.udf import normalise
from taxaloom.plans.common import SQL_BAD, SQL_BINOMIAL, listings, names, records


def clean_names(spark, sf):
    """Listings whose scientific or English name isn't clean, and which test fails."""
    d = listings(spark, sf).select("xc_id", T.is_binomial("xc_name").alias("binomial"), T.is_clean_scientific_name("xc_name").alias("clean_scientific"), T.is_clean_common_name("english_name").alias("clean_common"))
    return d.where("not (binomial and clean_scientific and clean_common)")


def ordered_aliases(spark, sf):
    """Clean aliases in delivered order, first occurrences only."""
    a = maps.ordered_distinct(F.concat(F.coalesce("scientific_name_aliases", F.array().cast("array<string>")), F.array("xc_name")), T.is_clean_scientific_name)
    d = records(spark, sf).select("rec_id", a.alias("a"))
    return d.where(F.size("a") > 0).select("rec_id", F.array_join("a", "|").alias("aliases"), F.size("a").cast("bigint").alias("n"))


def aliases_without_case(spark, sf):
    """Names of a record in any locale, first occurrences by lower case."""
    a = maps.ordered_distinct_ci(F.array("common_name", "common_name_alt", F.upper("common_name"), "xc_name"))
    return records(spark, sf).select("rec_id", F.array_join(a, "|").alias("names"))


def accent_fold(spark, sf):
    """Latin names without case and accents."""
    d = names(spark, sf).where(F.col("locale").isin("de", "fr", "es", "pt", "it", "sv") & F.col("common_name").rlike(r"^[\x20-\x7E\xC0-\xFF]+$"))
    return d.select("name_id", normalise("common_name").alias("folded"))


def accent_fold_all(spark, sf):
    """All names without case and accents. No SQL twin: DuckDB folds other letters than NFD does."""
    return names(spark, sf).select("name_id", normalise("common_name").alias("folded"))


def locale_normalized(spark, sf):
    """Names by normalised locale."""
    return names(spark, sf).groupBy(T.normalize_locale("locale").alias("locale")).agg(F.count("*").alias("n"))


def genus_counts(spark, sf):
    d = records(spark, sf).where(T.is_binomial("scientific_name"))
    return d.groupBy(T.genus("scientific_name").alias("genus")).agg(F.count("*").alias("rows"), F.countDistinct(T.epithet("scientific_name")).alias("epithets"))


def translated_only(spark, sf):
    """Names that differ from the English name of their species."""
    d = names(spark, sf).where("common_name <> ''")
    en = d.where("locale = 'en'").groupBy("scientific_name").agg(F.min("common_name").alias("english"))
    x = d.where("locale <> 'en'").join(en, "scientific_name", "left").where("english is null or common_name <> english")
    return x.groupBy("locale").agg(F.count("*").alias("n"))


def labels_kept(spark, sf):
    """Labels that are not the scientific name, of languages of two letters or more."""
    d = names(spark, sf).where("common_name <> '' and common_name <> scientific_name and length(locale) >= 2")
    return d.groupBy("scientific_name").agg(F.countDistinct("locale").alias("locales"))


QUERIES = {f.__name__: f for f in (clean_names, ordered_aliases, aliases_without_case, accent_fold, accent_fold_all, locale_normalized, genus_counts, translated_only, labels_kept)}

_B, _X = SQL_BINOMIAL, SQL_BAD
ORACLE = {
    "clean_names": rf"""with t as (select xc_id, coalesce(regexp_matches(trim(xc_name), '{_B}'), false) as binomial,
        coalesce(regexp_matches(trim(xc_name), '{_B}') and not regexp_matches(xc_name, '{_X}'), false) as clean_scientific,
        coalesce(trim(english_name) <> '' and not regexp_matches(english_name, '{_X}') and not regexp_matches(trim(english_name), '\s{{2,}}'), false) as clean_common from xc_species)
        select * from t where not (binomial and clean_scientific and clean_common)""",
    "ordered_aliases": f"""with a as (select rec_id, unnest(list_append(coalesce(scientific_name_aliases, []), xc_name)) as a, generate_subscripts(list_append(coalesce(scientific_name_aliases, []), xc_name), 1) as i from species_records),
        f as (select rec_id, trim(a) as a, min(i) as i from a where regexp_matches(trim(a), '{_B}') and not regexp_matches(a, '{_X}') group by all)
        select rec_id, string_agg(a, '|' order by i) as aliases, count(*) as n from f group by rec_id""",
    "aliases_without_case": """with a as (select rec_id, unnest([common_name, common_name_alt, upper(common_name), xc_name]) as a, unnest([1,2,3,4]) as i from species_records),
        f as (select rec_id, lower(trim(a)) as l, arg_min(trim(a), i) as a, min(i) as i from a where trim(a) <> '' group by all)
        select r.rec_id, coalesce(string_agg(a, '|' order by i), '') as names from species_records r left join f using (rec_id) group by r.rec_id""",
    "accent_fold": r"""select name_id, strip_accents(lower(common_name)) as folded from name_rows where locale in ('de','fr','es','pt','it','sv') and regexp_matches(common_name, '^[\x20-\x7E\x{C0}-\x{FF}]+$')""",
    "locale_normalized": """select case lower(replace(trim(locale), '_', '-')) when 'nb' then 'no' when 'pt-br' then 'pt' else lower(replace(trim(locale), '_', '-')) end as locale, count(*) as n from name_rows group by 1""",
    "genus_counts": f"""select split_part(trim(scientific_name), ' ', 1) as genus, count(*) as rows, count(distinct split_part(trim(scientific_name), ' ', 2)) as epithets from species_records where regexp_matches(trim(scientific_name), '{_B}') group by 1""",
    "translated_only": """with en as (select scientific_name, min(common_name) as english from name_rows where locale = 'en' and common_name <> '' group by 1)
        select locale, count(*) as n from name_rows d left join en using (scientific_name) where d.locale <> 'en' and common_name <> '' and (english is null or common_name <> english) group by 1""",
    "labels_kept": """select scientific_name, count(distinct locale) as locales from name_rows where common_name <> '' and common_name <> scientific_name and length(locale) >= 2 group by 1""",
}
