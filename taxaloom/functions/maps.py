"""Map and array expressions: overlay, fill, ordered distinct, and their counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxaloom.functions.text import col, strip

MAP = "map<string,string>"


def _safe(m) -> Column:
    return F.coalesce(col(m), F.create_map().cast(MAP))


def without_blank(m) -> Column:
    """Entries whose value is null or '' taken out; a null map becomes empty."""
    return F.map_filter(_safe(m), lambda k, v: v.isNotNull() & (v != ""))


def overlay(base, *layers) -> Column:
    """Later layers replace the entries of earlier ones (needs the LAST_WIN policy)."""
    return F.map_concat(_safe(base), *[without_blank(x) for x in layers])


def fill(base, *layers) -> Column:
    """Later layers only add keys that no earlier one has."""
    return F.map_concat(*[without_blank(x) for x in reversed(layers)], without_blank(base))


def keep_keys(m, keys) -> Column:
    return F.map_filter(_safe(m), lambda k, v: k.isin(list(keys)))


def value(m, key: str) -> Column:
    """The value of a key, null where it is absent or ''."""
    return F.nullif(F.element_at(col(m), F.lit(key)), F.lit(""))


def sorted_keys(m) -> Column:
    return F.array_sort(F.map_keys(_safe(m)))


def ordered_distinct(a, valid=None) -> Column:
    """First occurrences of the stripped, valid elements, in order."""
    x = F.transform(F.coalesce(col(a), F.array().cast("array<string>")), lambda e: strip(e))
    return F.array_distinct(F.filter(x, lambda e: e.isNotNull() & (valid(e) if valid else e != "")))


def ordered_distinct_ci(a, valid=None) -> Column:
    """First occurrences by lower case."""
    x = F.transform(F.coalesce(col(a), F.array().cast("array<string>")), lambda e: strip(e))
    x = F.filter(x, lambda e: e.isNotNull() & (valid(e) if valid else e != ""))
    low = F.transform(x, lambda e: F.lower(e))
    return F.filter(x, lambda e, i: F.array_position(low, F.lower(e)) == i + 1)


def first_where(a, keep) -> Column:
    """The first element that passes, null where none does."""
    return F.get(F.filter(col(a), keep), F.lit(0))
