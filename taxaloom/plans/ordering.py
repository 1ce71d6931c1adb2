"""Queries whose result depends on delivered order: indexes, ids, chunks, tops, journals."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.functions import text as T
from taxaloom.operators import ordering as O
from taxaloom.plans.common import RECORDS_SQL, checks, documents, listings, names, records
from taxaloom.session import table


def last_wins_index(spark, sf):
    """The last order of each customer."""
    return O.last_wins(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", ["o_orderkey", "o_totalprice"])


def first_wins_fill(spark, sf):
    """The first name of each species and locale."""
    return O.first_wins(names(spark, sf).where("common_name <> ''"), ["scientific_name", "locale"], "name_id", ["name_id", "common_name"])


def union_last_wins(spark, sf):
    """Species of records and listings; the listings' row replaces."""
    r = records(spark, sf).groupBy("scientific_name").agg(F.lit("record").alias("origin"))
    x = listings(spark, sf).where("xc_name is not null").groupBy(F.col("xc_name").alias("scientific_name")).agg(F.lit("listing").alias("origin"))
    return O.union_last_wins([r, x], ["scientific_name"], ["origin"])


def persistent_ids(spark, sf):
    """Ids of listed names: names that a record has keep its number, new ones continue in listing order."""
    known = records(spark, sf).select(F.col("scientific_name").alias("name"), F.substring("birdnet_id", 3, 20).cast("bigint").alias("number")).where("number is not null").groupBy("name").agg(F.min("number").alias("number"))
    rows = listings(spark, sf).where("xc_name <> ''").select(F.col("xc_name").alias("name"), F.col("xc_id").alias("ord"))
    d = O.assign_ids(rows, known, "name", "ord")
    return d.select("name", T.record_id("number").alias("id"))


def reassign_ids(spark, sf):
    """All record names numbered in code point order."""
    return O.reassign_ids(records(spark, sf).select("scientific_name"), "scientific_name").select("scientific_name", T.record_id("number").alias("id"))


def fixed_chunks(spark, sf):
    """Documents in requests of 50, in order of their id."""
    d = O.chunks(documents(spark, sf).select("doc_id"), [F.col("doc_id")], 50)
    return d.groupBy("chunk").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


def chunks_by_locale(spark, sf):
    """Names of each locale in requests of 30."""
    d = O.chunks(names(spark, sf).select("name_id", "locale"), [F.col("name_id")], 30, ["locale"])
    return d.groupBy("locale", "chunk").agg(F.count("*").alias("n"), F.min("name_id").alias("first"))


def top_locales(spark, sf):
    """The 30 locales with the most names, ties by first appearance."""
    return O.top_by_count(names(spark, sf), "locale", "name_id", 30)


def status_most_common(spark, sf):
    """Outcomes of checks by locale, most frequent first."""
    d = checks(spark, sf).where("locale is not null and last_status is not null")
    return O.top_by_count(d.withColumn("k", F.concat_ws(":", "locale", "last_status")).withColumn("ord", F.unix_micros(F.col("received_at").cast("timestamp"))), "k", "ord", 1000)


def first_accepted(spark, sf):
    """The first preferred name of each species and locale, else its first name."""
    d = names(spark, sf).where("common_name <> ''")
    order = F.struct(F.when(F.coalesce("preferred", F.lit(False)), 0).otherwise(1).alias("p"), F.col("name_id").alias("i"))
    return d.groupBy("scientific_name", "locale").agg(F.min_by("common_name", order).alias("common_name"))


def journal_replay(spark, sf):
    """The last checked status of each species and locale in the log, late and repeated rows included."""
    d = checks(spark, sf).where("scientific_name is not null and locale is not null")
    order = F.struct("last_checked", "received_at", "attempts", "last_status", "words")
    return d.groupBy("scientific_name", "locale").agg(F.max("attempts").alias("attempts"), F.max_by("last_status", order).alias("status"), F.max_by("words", order).alias("words"))


def retry_work(spark, sf):
    """Species and locales whose last check failed with attempts left."""
    return journal_replay(spark, sf).where("status <> 'ok' and attempts < 3").select("scientific_name", "locale", "attempts")


def latest_records(spark, sf):
    """The record delivered last of each species."""
    return records(spark, sf).groupBy("scientific_name").agg(F.max_by("rec_id", F.struct("received_at", "rec_id")).alias("rec_id"))


QUERIES = {f.__name__: f for f in (last_wins_index, first_wins_fill, union_last_wins, persistent_ids, reassign_ids, fixed_chunks, chunks_by_locale, top_locales, status_most_common, first_accepted, journal_replay, retry_work, latest_records)}

_R = RECORDS_SQL
_JOURNAL = """select scientific_name, locale, max(attempts) as attempts, last(last_status order by o) as status, last(words order by o) as words from (select *,
    row_number() over (partition by scientific_name, locale order by last_checked nulls first, received_at nulls first, attempts nulls first, last_status nulls first, words nulls first) as o from wiki_quality where scientific_name is not null and locale is not null) group by 1, 2"""
ORACLE = {
    "last_wins_index": "select o_custkey, max(o_orderkey) as o_orderkey, arg_max(o_totalprice, o_orderkey) as o_totalprice from orders group by 1",
    "first_wins_fill": "select scientific_name, locale, min(name_id) as name_id, arg_min(common_name, name_id) as common_name from name_rows where common_name <> '' group by 1, 2",
    "union_last_wins": "select scientific_name, case when max(k) = 1 then 'listing' else 'record' end as origin from (select scientific_name, 0 as k from species_records union all select xc_name, 1 from xc_species where xc_name is not null) group by 1",
    "persistent_ids": """with k as (select scientific_name as name, min(try_cast(substr(birdnet_id, 3) as bigint)) as n from species_records group by 1 having n is not null),
        f as (select xc_name as name, min(xc_id) as o from xc_species where xc_name <> '' and xc_name not in (select name from k) group by 1),
        a as (select name, n from k where name in (select xc_name from xc_species) union all select name, row_number() over (order by o, name) + (select max(n) from k) from f)
        select name, format('BN{:05d}', n) as id from a""",
    "reassign_ids": "select scientific_name, format('BN{:05d}', row_number() over (order by scientific_name)) as id from (select distinct scientific_name from species_records)",
    "fixed_chunks": "select chunk, count(*) as n, min(doc_id) as first, max(doc_id) as last from (select doc_id, (row_number() over (order by doc_id) - 1) // 50 as chunk from documents) group by 1",
    "chunks_by_locale": "select locale, chunk, count(*) as n, min(name_id) as first from (select name_id, locale, (row_number() over (partition by locale order by name_id) - 1) // 30 as chunk from name_rows) group by 1, 2",
    "top_locales": "select locale, count(*) as n from name_rows group by 1 order by n desc, min(name_id), locale limit 30",
    "status_most_common": "select concat(locale, ':', last_status) as k, count(*) as n from wiki_quality where locale is not null and last_status is not null group by 1",
    "first_accepted": "select scientific_name, locale, arg_min(common_name, (case when coalesce(preferred, false) then 0 else 1 end) * 10000000000000::hugeint + name_id) as common_name from name_rows where common_name <> '' group by 1, 2",
    "journal_replay": _JOURNAL,
    "retry_work": f"select scientific_name, locale, attempts from ({_JOURNAL}) where status <> 'ok' and attempts < 3",
    "latest_records": "select scientific_name, arg_max(rec_id, o) as rec_id from (select *, row_number() over (partition by scientific_name order by received_at nulls first, rec_id) as o from species_records) group by 1",
}
