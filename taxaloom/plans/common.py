"""Records as the catalog sees them, from the driver's tables, and the matching SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom.session import ensure, table

IDS = ["birdnet_id", "inat_id", "ebird_code", "gbif_id", "xc_name"]
EXTERNAL = ["ebird_code", "gbif_id", "xc_name"]
#: Word tokens and CJK characters as DuckDB counts them.
SQL_WORDS = r"(len(regexp_extract_all({0}, '[\p{{L}}\p{{N}}_](?:[\p{{L}}\p{{N}}_''-]*[\p{{L}}\p{{N}}_])?')) + len(regexp_extract_all({0}, '[\x{{3400}}-\x{{4dbf}}\x{{4e00}}-\x{{9fff}}\x{{3040}}-\x{{30ff}}\x{{ac00}}-\x{{d7af}}]')))"
SQL_BINOMIAL = "^[A-Z][A-Za-z.-]+ [a-z][A-Za-z.-]+$"
SQL_BAD = r"[()\[\]{}/\\<>|]"


def words_sql(expr: str) -> str:
    return SQL_WORDS.format(f"coalesce({expr}, '')")


def strip_sql(expr: str) -> str:
    return rf"regexp_replace({expr}, '^[\s\p{{Z}}\x{{85}}\x0b]+|[\s\p{{Z}}\x{{85}}\x0b]+$', '', 'g')"


def _last_sql(head: str, mark: str) -> str:
    """Characters before the last place of a mark."""
    q = mark.replace(".", r"\.").replace("?", r"\?").replace("\n", r"\n")
    return f"case when regexp_matches({head}, '(?s)^.*{q}') then length(regexp_extract({head}, '(?s)^(.*){q}', 1)) end"


def sentence_sql(text: str, most: int) -> str:
    """A text of at most `most` characters, to a sentence's or a word's end."""
    head, low = f"substr({text}, 1, {most})", most // 3
    at = ", ".join(f"case when {_last_sql(head, m)} >= {low} then {_last_sql(head, m)} + 1 end" for m in (". ", "! ", "? ", ".\n", "!\n", "?\n"))
    return f"case when length({text}) <= {most} then {text} else {strip_sql(f'substr({head}, 1, coalesce({at}, case when {_last_sql(head, chr(32))} >= {low} then {_last_sql(head, chr(32))} end, {most}))')} end"


def ellipsis_sql(text: str, most: int) -> str:
    """The same past the half, with an ellipsis after a word."""
    head = f"substr({text}, 1, {most})"
    at = ", ".join(f"case when {_last_sql(head, m)} > {most // 2} then {_last_sql(head, m)} + 1 end" for m in (". ", ".\n", "! ", "? "))
    return f"case when length({text}) <= {most} then {text} else coalesce(substr({head}, 1, coalesce({at})), substr({head}, 1, coalesce({_last_sql(head, ' ')}, {most})) || '…') end"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """species_records with `ord` and an image address for records with a numeric id."""
    d = table(ensure(spark), sf_dir, "species_records").withColumn("ord", F.col("rec_id"))
    return d.withColumn("image_url", F.when(F.col("inat_id").isNotNull(), F.concat(F.lit("https://img.example/"), F.col("inat_id").cast("string"))))


#: The same records in SQL.
RECORDS_SQL = "(select *, rec_id as ord, case when inat_id is not null then 'https://img.example/' || inat_id end as image_url from species_records)"


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(ensure(spark), sf_dir, "name_rows")


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(ensure(spark), sf_dir, "wiki_quality")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(ensure(spark), sf_dir, "xc_species")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(ensure(spark), sf_dir, "documents")
