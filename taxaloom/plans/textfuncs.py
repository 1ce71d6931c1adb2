"""Scalar text functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.functions import passages as P
from taxaloom.functions import text as T
from taxaloom.functions import udf as U
from taxaloom.plans.common import documents, ellipsis_sql, names, records, sentence_sql, strip_sql, words_sql


def word_counts(spark, sf):
    return documents(spark, sf).select("doc_id", T.word_count("text").alias("words"))


def spaces_normalized(spark, sf):
    d = documents(spark, sf).where("text is not null").select("doc_id", T.normalize_space("text").alias("t"))
    return d.select("doc_id", F.length("t").cast("bigint").alias("n"), F.md5("t").alias("h"))


def species_identity(spark, sf):
    """Whether a document names its species."""
    d = documents(spark, sf).where("scientific_name is not null")
    return d.select("doc_id", T.contains_any_name("text", F.array("scientific_name")).alias("named"))


def url_titles(spark, sf):
    d = records(spark, sf).select("rec_id", F.explode("wikipedia_urls").alias("locale", "url"))
    return d.select("rec_id", "locale", T.page_title("url").alias("title"))


def media_urls(spark, sf):
    """Addresses and cache keys made of names."""
    return _media_urls(records(spark, sf).where(F.col("common_name").rlike("^[A-Za-z ]+$")))


def media_urls_all(spark, sf):
    """The same of all records. No SQL twin: DuckDB quotes addresses otherwise."""
    return _media_urls(records(spark, sf))


def _media_urls(d):
    return d.select("rec_id", T.commons_url(F.concat("common_name", F.lit(".jpg"))).alias("url"), T.cache_key("scientific_name").alias("key"))


def name_parts(spark, sf):
    return records(spark, sf).select("rec_id", T.genus("scientific_name").alias("genus"), T.epithet("scientific_name").alias("epithet"), F.replace("common_name", F.lit("-"), F.lit(" ")).alias("spaced"))


def code_variants(spark, sf):
    d = records(spark, sf).where("ebird_code <> ''").select("rec_id", T.code_variants(F.concat("ebird_code", F.when(F.col("rec_id") % 3 == 0, "2").otherwise(""))).alias("v"))
    return d.select("rec_id", F.array_join("v", "|").alias("variants"))


def tags_stripped(spark, sf):
    d = records(spark, sf).select("rec_id", F.explode("descriptions").alias("locale", "text")).where("text like '%<%'")
    return d.select("rec_id", "locale", F.md5(T.strip_tags("text")).alias("h"))


def author_lines(spark, sf):
    """Authors read from attribution lines made of names and sources."""
    return _author_lines(names(spark, sf).where(F.col("common_name").rlike("^[A-Za-z ]+$") & F.col("name_source").isNotNull()))


def author_lines_all(spark, sf):
    """The same of all names. No SQL twin: the rules of `image_author` apply to names with marks and brackets."""
    return _author_lines(names(spark, sf))


def _author_lines(d):
    line = F.when(F.col("name_source") == "inat", F.concat(F.lit("(c) "), "common_name", F.lit(", some rights reserved (CC BY-NC)"))).when(F.col("name_source") == "ebird", F.concat(F.lit("Photo - "), "common_name", F.lit(" / Macaulay Library ML1"))).otherwise(F.concat("common_name", F.lit(" [x], ")))
    return d.select("name_id", T.image_author(line, "name_source").alias("author"))


def selected_descriptions(spark, sf):
    """Concise descriptions: the first paragraphs up to enough words."""
    return documents(spark, sf).select("doc_id", P.selected_description("text", 40, 120).alias("description"))


def truncated_texts(spark, sf):
    """Texts cut for requests of 480 characters, at sentences."""
    d = documents(spark, sf).where("text is not null")
    return d.select("doc_id", P.ended_at_sentence("text", 480).alias("plain"), P.ended_with_ellipsis("text", 480).alias("marked"))


def file_names(spark, sf):
    d = records(spark, sf)
    part = U.file_name_part
    return d.select("rec_id", F.concat(part("scientific_name"), F.lit("_"), part("common_name"), F.lit("_"), F.rtrim(F.substring(part("common_name_alt"), 1, 60)), F.lit(".webp")).alias("file"))


QUERIES = {f.__name__: f for f in (word_counts, spaces_normalized, species_identity, url_titles, media_urls, media_urls_all, name_parts, code_variants, tags_stripped, author_lines, author_lines_all, selected_descriptions, truncated_texts, file_names)}

def _part_sql(c: str) -> str:
    return rf"case when coalesce({c}, '') = '' then 'unknown' else trim(regexp_replace(replace(replace(regexp_replace(nfc_normalize({c}), '\p{{C}}', '', 'g'), '/', ' '), '\', ' '), '[\s\p{{Z}}]+', ' ', 'g')) end"


ORACLE = {
    "truncated_texts": f"select doc_id, {sentence_sql(strip_sql('text'), 480)} as plain, {ellipsis_sql('text', 480)} as marked from documents where text is not null",
    # Paragraphs until 120 words, of at most three and none from a closing heading on.
    "selected_descriptions": rf"""with p as (select doc_id, [x for x in [trim(regexp_replace(y, '[\s\p{{Z}}\x{{85}}]+', ' ', 'g')) for y in regexp_split_to_array({strip_sql(r"replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10))")}, '\n\n+')] if x <> ''] as ps from documents),
        u as (select doc_id, unnest(ps) as p, generate_subscripts(ps, 1) as i from p),
        h as (select *, min(case when regexp_matches(p, '(?i)^(references|external links|further reading|see also)\b') then i else 1000000 end) over (partition by doc_id) as closing from u),
        w as (select *, coalesce(sum({words_sql('p')}) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as before from h where i < closing and i <= 3)
        select doc_id, coalesce(string_agg(p, chr(10) || chr(10) order by i) filter (i = 1 or before < 120), '') as description from (select doc_id from documents) left join w using (doc_id) group by 1""",
    "file_names": f"select rec_id, {_part_sql('scientific_name')} || '_' || {_part_sql('common_name')} || '_' || rtrim(substr({_part_sql('common_name_alt')}, 1, 60)) || '.webp' as file from species_records",
    "word_counts": f"select doc_id, {words_sql('text')} as words from documents",
    "spaces_normalized": r"select doc_id, length(t) as n, md5(t) as h from (select doc_id, trim(regexp_replace(text, '[\s\x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}\x{85}\x{2028}\x{2029}]+', ' ', 'g')) as t from documents where text is not null)",
    "species_identity": r"""select doc_id, coalesce(regexp_matches(lower(regexp_replace(text, '\s+', ' ', 'g')), '(^|[^\p{L}\p{N}_])' || lower(scientific_name) || '($|[^\p{L}\p{N}_])'), false) as named from documents where scientific_name is not null""",
    "url_titles": "select rec_id, e.key as locale, replace(url_decode(nullif(regexp_extract(e.value, '/wiki/([^?#]+)', 1), '')), '_', ' ') as title from (select rec_id, unnest(map_entries(wikipedia_urls)) as e from species_records)",
    "media_urls": "select rec_id, 'https://upload.wikimedia.org/wikipedia/commons/' || substr(md5(f), 1, 1) || '/' || substr(md5(f), 1, 2) || '/' || f as url, substr(sha256(scientific_name), 1, 16) as key from (select *, replace(common_name || '.jpg', ' ', '_') as f from species_records where regexp_matches(common_name, '^[A-Za-z ]+$'))",
    "name_parts": "select rec_id, split_part(trim(scientific_name), ' ', 1) as genus, nullif(split_part(trim(scientific_name), ' ', 2), '') as epithet, replace(common_name, '-', ' ') as spaced from species_records",
    "code_variants": r"""with c as (select rec_id, ebird_code || case when rec_id % 3 = 0 then '2' else '' end as c from species_records where ebird_code <> ''), p as (select *, regexp_extract(c, '^([a-z]+?)(\d+)$', 1) as b, try_cast(regexp_extract(c, '^([a-z]+?)(\d+)$', 2) as int) as v from c)
        select rec_id, concat_ws('|', c, case when v >= 2 then b || '1' end, case when v is not null then b end) as variants from p""",
    "tags_stripped": "select rec_id, e.key as locale, md5(regexp_replace(e.value, '<[^>]+>', '', 'g')) as h from (select rec_id, unnest(map_entries(descriptions)) as e from species_records) where e.value like '%<%'",
    "author_lines": "select name_id, trim(common_name) as author from name_rows where regexp_matches(common_name, '^[A-Za-z ]+$') and name_source is not null",
}
