"""Requests of batch services: names or titles by fifties as the text of one request. What comes back is read by `answers`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.operators.ordering import chunks

#: Names or titles that one request may hold.
NAMES_A_QUERY, TITLES_A_QUERY = 150, 50


def batches(df: DataFrame, column: str, size: int, prefix: str = "", sep: str = "|") -> DataFrame:
    """(chunk, request): distinct values in order, `size` in each request, joined by `sep`; null and '' are left out."""
    d = df.select(F.col(column).alias("v")).where("v is not null and v <> ''").distinct()
    parts = chunks(d, [F.col("v")], size).groupBy("chunk").agg(F.sort_array(F.collect_list("v")).alias("v"))
    return parts.select("chunk", F.array_join(F.transform("v", lambda x: F.concat(F.lit(prefix), x)), sep).alias("request"))


def title_requests(df: DataFrame, column: str) -> DataFrame:
    """Page titles, fifty a request."""
    return batches(df, column, TITLES_A_QUERY)


def file_requests(df: DataFrame, column: str) -> DataFrame:
    """Media files by their page titles, blanks as underscores, fifty a request."""
    return batches(df.select(F.replace(column, F.lit(" "), F.lit("_")).alias("f")), "f", TITLES_A_QUERY, "File:")


def name_requests(df: DataFrame, column: str, properties: dict[str, str], labels: bool = False) -> DataFrame:
    """(chunk, request): queries for items by taxon name, each with the given properties ({variable: property}).

    Quotes and backslashes in names are escaped. With `labels` the items' labels come along, one row a language.
    """
    quoted = F.concat(F.lit('"'), F.regexp_replace(column, r'(["\\])', r"\\$1"), F.lit('"'))
    b = batches(df.where(F.col(column) != "").select(quoted.alias("q")), "q", NAMES_A_QUERY, sep=" ")
    wanted = " ".join(f"OPTIONAL {{ ?item wdt:{p} ?{v} . }}" for v, p in properties.items())
    variables = " ".join(f"?{v}" for v in properties)
    label = " OPTIONAL { ?item rdfs:label ?label . }" if labels else ""
    return b.select("chunk", F.concat(F.lit(f"SELECT ?item ?name {variables}{' ?label' if labels else ''} WHERE {{ VALUES ?name {{ "), "request", F.lit(f" }} ?item wdt:P225 ?name . {wanted}{label} }}")).alias("request"))
