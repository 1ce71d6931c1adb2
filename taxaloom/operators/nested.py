"""Deeply nested JSON records to flat, linked tables.

One delivered payload holds a record (or a list of records) whose children come in varying
shapes: a list of objects with a `locale`, or an object keyed by locale; a single string, a
list of strings, or a list of objects around the string. The payload is parsed once to a
VARIANT; nested transforms then normalise every shape to arrays of structs that carry the ancestors'
key and indices, `flatten` joins the arrays of nested levels, and one `inline` per
target table emits its rows (`children`: one for all kinds). Everything is a projection: no shuffle, no Python.

Every row is linked by its key, `record` (the record's place in the payload, from 1) and `entry` (the
place of its entry in a list of entries, null in an object keyed by locale); paragraphs also by
`description_pos`, the `pos` of their description.

Defined results
* null, empty, broken or non-object payloads give no children and stand in `rejects` with the reason;
* a null, empty or blank element keeps its position and is no child;
* a description is a child if it is an object (even without paragraphs) or non-blank text;
* elements without a locale (where one is needed) have no address and are no children;
* positions count from 1 within payload, kind and locale, over all elements in delivered order;
* duplicate keys in one object make the payload unreadable, as for the strict JSON parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("descriptions", "paragraphs", "common_names", "wikipedia_urls", "scientific_name_aliases")

_ENTRY = "array<struct<record:bigint,entry:bigint,locale:string,body:variant>>"


def _get(v: str, path: str, kind: str) -> str:
    return f"try_variant_get({v}, '{path}', '{kind}')"


def records_expr(payload: str) -> Column:
    """The records of a payload with their places: each of `records`, `record`, or the bare object itself."""
    v = f"try_parse_json({payload})"
    many = f"coalesce({_get(v, '$.records', 'array<variant>')}, cast(array() as array<variant>))"
    one = f"coalesce({_get(v, '$.record', 'variant')}, case when {_get(v, '$.record', 'variant')} is null and {_get(v, '$.records', 'variant')} is null then {v} end)"
    return F.expr(f"filter(transform(concat({many}, array({one})), (r, i) -> struct(cast(i + 1 as bigint) as n, r as body)), r -> {_get('r.body', '$', 'map<string,variant>')} is not null)")


def _entries(kind: str) -> str:
    """Children of one kind of every record as (record, entry, locale, body), whichever container they came in."""
    return f"""flatten(transform(records, r -> cast(coalesce(
        transform({_get('r.body', f'$.{kind}', 'array<variant>')},
                  (e, i) -> struct(r.n as record, cast(i + 1 as bigint) as entry, {_get('e', '$.locale', 'string')} as locale, e as body)),
        transform(map_entries({_get('r.body', f'$.{kind}', 'map<string,variant>')}),
                  e -> struct(r.n as record, cast(null as bigint) as entry, e.key as locale, e.value as body)),
        array()) as {_ENTRY})))"""


def _numbered(entries: str, element: str) -> str:
    """Number the elements of an array within their locale; `element` is the struct made of (x, pos)."""
    return f"""flatten(transform(array_distinct(transform(filter({entries}, x -> x.locale is not null), x -> x.locale)),
        l -> transform(filter({entries}, x -> x.locale = l), (x, i) -> {element})))"""


def _text(body: str, field: str) -> str:
    """The text of an element that is an object around it or the text itself."""
    whole = _get(body, "$", "string")
    inner = _get(body, f"$.{field}", "string")
    return f"case when {_get(body, '$', 'map<string,variant>')} is not null then {inner} when {_get(body, '$', 'array<variant>')} is null then {whole} end"


def _blank(s: str) -> str:
    return rf"regexp_replace({s}, '(?U)^[\\s\\p{{Cf}}]+$', '') = ''"


_FILLED = f"x.text is not null and not ({_blank('x.text')})"


def _prepared(df: DataFrame, key: str, payload: str, *kinds: str) -> DataFrame:
    """The key and, of each kind, its entries (`_e_`) and their single values (`_l_`), as columns."""
    d = df.select(F.col(key), records_expr(f"`{payload}`").alias("records"))
    d = d.withColumns({f"_e_{k}": F.expr(_entries(k)) for k in kinds if k in _FIELDS})
    return d.withColumns({f"_l_{k}": F.expr(_leaves(k)) for k in kinds})


#: The list within an entry and the text within a value, by kind.
_FIELDS = {"descriptions": ("paragraphs", "text"), "common_names": ("values", "name"), "wikipedia_urls": ("url", "url")}


def _leaves(kind: str) -> str:
    """Each entry's list (or single value) flattened; of descriptions, each paragraph with its description's position."""
    if kind == "scientific_name_aliases":
        return f"""flatten(transform(records, r -> transform(coalesce({_get('r.body', f'$.{kind}', 'array<variant>')}, array({_get('r.body', f'$.{kind}', 'variant')})),
            (y, i) -> struct(r.n as record, cast(i + 1 as bigint) as entry, '' as locale, y as body))))"""
    inner = _get("x.body", f"$.{_FIELDS[kind][0]}", "variant")
    whole = f"case when {_get('x.body', '$', 'map<string,variant>')} is not null then {inner} else x.body end"
    source, link = f"_e_{kind}", ""
    if kind == "descriptions":
        source, link = _numbered(source, "struct(x.record as record, x.entry as entry, x.locale as locale, cast(i + 1 as bigint) as up, x.body as body)"), ", x.up as up"
    return f"""flatten(transform({source}, x -> transform(
        coalesce(try_variant_get({whole}, '$', 'array<variant>'), array({whole})),
        y -> struct(x.record as record, x.entry as entry, x.locale as locale{link}, y as body))))"""


def _values(kind: str, more: str = "") -> str:
    """The numbered values of a kind that are children, as structs with record, entry, locale, pos and text."""
    field = "name" if kind == "scientific_name_aliases" else _FIELDS[kind][1]
    row = f"struct(x.record as record, x.entry as entry, x.locale as locale, cast(i + 1 as bigint) as pos, {_text('x.body', field)} as text{more})"
    return f"filter({_numbered(f'_l_{kind}', row)}, x -> {_FILLED})"


def _descriptions() -> str:
    return f"""filter({_numbered('_e_descriptions', f"""struct(x.record as record, x.entry as entry, x.locale as locale, cast(i + 1 as bigint) as pos,
            {_get('x.body', '$.source.kind', 'string')} as source_kind, {_get('x.body', '$.source.fetched', 'string')} as fetched,
            coalesce(size({_get('x.body', '$.paragraphs', 'array<variant>')}), case when {_get('x.body', '$.paragraphs', 'string')} is not null then 1 else 0 end) as n_paragraphs,
            {_get('x.body', '$', 'map<string,variant>')} is not null as is_object, {_get('x.body', '$', 'string')} as text)""")}, x -> x.is_object or {_FILLED})"""


def descriptions(df: DataFrame, key: str = "raw_id", payload: str = "payload") -> DataFrame:
    """(key, record, entry, locale, pos, source_kind, fetched, n_paragraphs): one row per description."""
    d = _prepared(df, key, payload, "descriptions").select(key, F.expr(f"inline({_descriptions()})"))
    return d.drop("is_object", "text")


def paragraphs(df: DataFrame, key: str = "raw_id", payload: str = "payload") -> DataFrame:
    """(key, record, entry, locale, pos, description_pos, text): paragraphs linked to their description."""
    d = _prepared(df, key, payload, "descriptions").select(key, F.expr(f"inline({_values('descriptions', ', x.up as description_pos')})"))
    return d.select(key, "record", "entry", "locale", "pos", "description_pos", "text")


def _named(kind: str, to: str, df: DataFrame, key: str, payload: str) -> DataFrame:
    return _prepared(df, key, payload, kind).select(key, F.expr(f"inline({_values(kind)})")).withColumnRenamed("text", to)


def common_names(df: DataFrame, key: str = "raw_id", payload: str = "payload") -> DataFrame:
    """(key, record, entry, locale, pos, name): names by locale."""
    return _named("common_names", "name", df, key, payload)


def wikipedia_urls(df: DataFrame, key: str = "raw_id", payload: str = "payload") -> DataFrame:
    """(key, record, entry, locale, pos, url): page addresses by locale."""
    return _named("wikipedia_urls", "url", df, key, payload)


def scientific_name_aliases(df: DataFrame, key: str = "raw_id", payload: str = "payload") -> DataFrame:
    """(key, record, pos, name, status): aliases of the record, without a locale."""
    kind = "scientific_name_aliases"
    d = _prepared(df, key, payload, kind).select(key, F.expr(f"inline({_values(kind, f', {_get("x.body", "$.status", "string")} as status')})"))
    return d.select(key, "record", "pos", F.col("text").alias("name"), "status")


def children(df: DataFrame, key: str = "raw_id", payload: str = "payload") -> DataFrame:
    """(key, child_kind, locale, pos) of every child: the payload is parsed once and one inline emits all kinds."""
    d = _prepared(df, key, payload, "descriptions", "common_names", "wikipedia_urls", "scientific_name_aliases")
    arrays = {"descriptions": _descriptions(), "paragraphs": _values("descriptions"), **{k: _values(k) for k in KINDS[2:]}}
    rows = ", ".join(f"transform({a}, x -> struct('{k}' as child_kind, x.locale as locale, x.pos as pos))" for k, a in arrays.items())
    return d.select(key, F.expr(f"inline(concat({rows}))"))


def rejects(df: DataFrame, key: str = "raw_id", payload: str = "payload") -> DataFrame:
    """(key, reason) of payloads without a record: empty, broken, no_object or no_record."""
    v = F.expr(f"try_parse_json(`{payload}`)")
    reason = (
        F.when(F.coalesce(F.trim(payload), F.lit("")) == "", "empty").when(v.isNull(), "broken")
        .when(F.expr(f"try_variant_get(try_parse_json(`{payload}`), '$', 'map<string,variant>')").isNull(), "no_object")
        .when(F.size(records_expr(f"`{payload}`")) == 0, "no_record")
    )
    return df.select(key, reason.alias("reason")).where("reason is not null")
