"""Queries over nested payloads (problem 2)."""

from __future__ import annotations

from taxaloom.operators import nested
from taxaloom.session import ensure, table


def _of(fn):
    return lambda spark, sf_dir: fn(table(ensure(spark), sf_dir, "raw_records"))


QUERIES = {
    "p2_found": _of(nested.children),
    "p2_descriptions": _of(nested.descriptions),
    "p2_paragraphs": _of(nested.paragraphs),
    "p2_common_names": _of(nested.common_names),
    "p2_wikipedia_urls": _of(nested.wikipedia_urls),
    "p2_aliases": _of(nested.scientific_name_aliases),
    "p2_rejects": _of(nested.rejects),
}

# The same children in SQL: json_each walks arrays and objects alike, in delivered order.
_RECORDS = """o as (select raw_id, payload::json as j from raw_records where json_valid(payload) and json_type(payload::json) = 'OBJECT'),
    r0 as (select raw_id, row_number() over (partition by raw_id order by e.id) as rk, e.value as rec, e.type as kind from o, json_each(o.j, '$.records') e where json_type(o.j, '$.records') = 'ARRAY'
      union all select raw_id, 1 + coalesce(json_array_length(j, '$.records'), 0), j->'$.record', 'OBJECT' from o where json_type(j, '$.record') = 'OBJECT'
      union all select raw_id, 1, j, 'OBJECT' from o where json_type(j, '$.record') is null and json_type(j, '$.records') is null),
    r as (select raw_id, rk, rec from r0 where kind = 'OBJECT')"""


def _entries(kind: str) -> str:
    c = f"json_type(rec, '$.{kind}')"
    return f"""select raw_id, rk, e.id as ek, case when {c} = 'ARRAY' then row_number() over (partition by raw_id, rk order by e.id) end as entry, case when {c} = 'ARRAY' then e.value->>'$.locale' else e.key end as locale, e.value as body
        from r, json_each(r.rec, '$.{kind}') e where {c} in ('ARRAY', 'OBJECT')"""


def _text(v: str, field: str) -> str:
    return f"case json_type({v}) when 'OBJECT' then {v}->>'$.{field}' when 'ARRAY' then null else {v}->>'$' end"


def _leaves(kind: str, inner: str, field: str) -> str:
    """Numbered texts of one kind: (raw_id, locale, pos, dpos, text); `inner` finds the list in a body."""
    return f"""select * from (select raw_id, rk as record, entry, locale, row_number() over (partition by raw_id, locale order by rk, ek, qk) as pos, dpos, {_text('v', field)} as text from (
        select raw_id, rk, ek, entry, locale, dpos, q.id as qk, q.value as v from (select *, {inner} as p from e) t, json_each(t.p) q where json_type(t.p) = 'ARRAY'
        union all select raw_id, rk, ek, entry, locale, dpos, 0, p from (select *, {inner} as p from e) t where json_type(t.p) is distinct from 'ARRAY')) where trim(text) <> ''"""


def _kind(kind: str, rest: str) -> str:
    return f"""with {_RECORDS}, e as (select *, row_number() over (partition by raw_id, locale order by rk, ek) as dpos from ({_entries(kind)}) where locale is not null) {rest}"""


_OBJECT = "json_type(body) = 'OBJECT'"
_DESCRIPTIONS = _kind(
    "descriptions",
    f"""select raw_id, rk as record, entry, locale, dpos as pos, body->>'$.source.kind' as source_kind, body->>'$.source.fetched' as fetched,
    (case json_type(body, '$.paragraphs') when 'ARRAY' then json_array_length(body, '$.paragraphs') when 'VARCHAR' then 1 else 0 end)::int as n_paragraphs from e
    where {_OBJECT} or trim({_text('body', 'x')}) <> ''""",
)
_PARAGRAPHS = _kind("descriptions", _leaves("descriptions", f"case when {_OBJECT} then body->'$.paragraphs' else body end", "text"))
_NAMES = _kind("common_names", _leaves("common_names", f"case when {_OBJECT} then body->'$.values' else body end", "name"))
_URLS = _kind("wikipedia_urls", _leaves("wikipedia_urls", f"case when {_OBJECT} then body->'$.url' else body end", "url"))
_ALIASES = f"""with {_RECORDS}, q as (select raw_id, rk, e.id as k, e.value as v from r, json_each(r.rec, '$.scientific_name_aliases') e where json_type(rec, '$.scientific_name_aliases') = 'ARRAY'
    union all select raw_id, rk, 0, rec->'$.scientific_name_aliases' from r where json_type(rec, '$.scientific_name_aliases') is distinct from 'ARRAY'),
    n as (select raw_id, rk as record, row_number() over (partition by raw_id order by rk, k) as pos, {_text('v', 'name')} as name, case when json_type(v) = 'OBJECT' then v->>'$.status' end as status from q)
    select * from n where trim(name) <> ''"""

ORACLE: dict[str, str] = {
    "p2_descriptions": _DESCRIPTIONS,
    "p2_paragraphs": f"select raw_id, record, entry, locale, pos, dpos as description_pos, text from ({_PARAGRAPHS})",
    "p2_common_names": f"select raw_id, record, entry, locale, pos, text as name from ({_NAMES})",
    "p2_wikipedia_urls": f"select raw_id, record, entry, locale, pos, text as url from ({_URLS})",
    "p2_aliases": _ALIASES,
    "p2_rejects": f"""with {_RECORDS} select raw_id, case when coalesce(trim(payload), '') = '' then 'empty' when not json_valid(payload) then 'broken' when json_type(payload::json) <> 'OBJECT' then 'no_object' else 'no_record' end as reason
        from raw_records where raw_id not in (select raw_id from r)""",
    "p2_found": f"""select raw_id, 'descriptions' as child_kind, locale, pos from ({_DESCRIPTIONS}) union all select raw_id, 'paragraphs', locale, pos from ({_PARAGRAPHS})
        union all select raw_id, 'common_names', locale, pos from ({_NAMES}) union all select raw_id, 'wikipedia_urls', locale, pos from ({_URLS})
        union all select raw_id, 'scientific_name_aliases', '', pos from ({_ALIASES})""",
}
