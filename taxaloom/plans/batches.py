"""Request batches for translation and generation."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import batching as B
from taxaloom.plans.common import documents, ellipsis_sql, records, sentence_sql, strip_sql


def char_budget_batches(spark, sf):
    """Documents of each language in batches of at most 12 and 12,000 characters."""
    d = documents(spark, sf).where("lang is not null").select("doc_id", "lang", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n"))
    return B.greedy_batches(d, ["lang"], "doc_id", "n", B.by_budget(12_000, 12), 12).select("doc_id", "lang", "batch")


def locale_batches(spark, sf):
    """Documents of each language in batches of at most 3 and 480 rendered characters."""
    d = documents(spark, sf).where("lang is not null").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("t"))
    return B.greedy_batches(d, ["lang"], "doc_id", "t", B.Rendered(480, 3), 3).select("doc_id", "lang", "batch")


def signature_batches(spark, sf):
    """Described records in batches by the set of locales they lack."""
    en = "descriptions['en']"
    sig = F.filter(F.array(*[F.lit(x) for x in ("de", "fr", "es", "pl")]), lambda x: F.coalesce(F.element_at("descriptions", x), F.lit("")) == "")
    d = records(spark, sf).where(f"{en} <> ''").select("rec_id", sig.alias("sig"), F.expr(en).alias("text")).where(F.size("sig") > 0)
    return B.by_signature(d, "sig", "rec_id", "text", 12_000, 12, 1500).select("rec_id", F.array_join("sig", ",").alias("signature"), "batch", "group_size", "turn")


QUERIES = {f.__name__: f for f in (char_budget_batches, locale_batches, signature_batches)}

ORACLE = {
    # The running sum that restarts where it would exceed the budget, step by step.
    "char_budget_batches": """with recursive r as (select doc_id, lang, greatest(1, coalesce(length(text), 0)) as n, row_number() over (partition by lang order by doc_id) as i from documents where lang is not null),
        s as (select doc_id, lang, i, n as used, 1 as items, 0 as batch from r where i = 1
          union all select r.doc_id, r.lang, r.i, case when s.items >= 12 or s.used + r.n > 12000 then r.n else s.used + r.n end, case when s.items >= 12 or s.used + r.n > 12000 then 1 else s.items + 1 end, s.batch + case when s.items >= 12 or s.used + r.n > 12000 then 1 else 0 end
          from s join r on r.lang = s.lang and r.i = s.i + 1)
        select doc_id, lang, batch from s""",
    # The same with texts cut to the share of a batch of one, two or three; markers and gaps take 8, 18 and 28 characters.
    "locale_batches": f"""with recursive t as (select doc_id, lang, {strip_sql("coalesce(text, '')")} as t from documents where lang is not null),
        r as (select doc_id, lang, length({sentence_sql('t', 224)}) as l2, length({sentence_sql('t', 144)}) as l3, row_number() over (partition by lang order by doc_id) as i from t),
        s as (select doc_id, lang, i, l2, l3, 1 as items, 0 as batch from r where i = 1
          union all select r.doc_id, r.lang, r.i, case when fits then s.l2 + r.l2 else r.l2 end, case when fits then s.l3 + r.l3 else r.l3 end, case when fits then items + 1 else 1 end, batch + case when fits then 0 else 1 end
          from s join r on r.lang = s.lang and r.i = s.i + 1, lateral (select s.items = 1 and 18 + s.l2 + r.l2 <= 480 or s.items = 2 and 28 + s.l3 + r.l3 <= 480 as fits))
        select doc_id, lang, batch from s""",
    "signature_batches": f"""with recursive t as (select rec_id, descriptions['en'] as t, [x for x in ['de', 'fr', 'es', 'pl'] if coalesce(descriptions[x], '') = ''] as sig from species_records where descriptions['en'] <> ''),
        r as (select rec_id, array_to_string(sig, ',') as g, len(sig) as k, greatest(1, length({ellipsis_sql('t', 1500)})) as n, row_number() over (partition by array_to_string(sig, ',') order by rec_id) as i, count(*) over (partition by array_to_string(sig, ',')) as group_size from t where len(sig) > 0),
        s as (select rec_id, g, k, i, group_size, n as used, 1 as items, 0 as batch from r where i = 1
          union all select r.rec_id, r.g, r.k, r.i, r.group_size, case when s.items >= 12 or s.used + r.n > 12000 then r.n else s.used + r.n end, case when s.items >= 12 or s.used + r.n > 12000 then 1 else s.items + 1 end, s.batch + case when s.items >= 12 or s.used + r.n > 12000 then 1 else 0 end
          from s join r on r.g = s.g and r.i = s.i + 1)
        select rec_id, g as signature, batch, group_size, dense_rank() over (order by group_size desc, k desc, g, batch) as turn from s""",
}
