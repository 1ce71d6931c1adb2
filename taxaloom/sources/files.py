"""File sources: keyed JSON documents, record lists, journals and checked CSV tables.

Missing optional files give empty tables with the right schema; missing required ones raise.
Delivered order is materialised as `ord` where it has a meaning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from taxaloom.functions.text import blank_to_null, is_binomial, null_to_blank, strip
from taxaloom.sources.storage import exists, size

MAP = "map<string,string>"
#: Record schemas of the keyed documents, as DDL.
SCHEMAS = {
    "inat": f"inat_id bigint, taxon_group string, iconic_taxon_name string, common_names {MAP}, wikipedia_url string, image_url string, image_attribution string, image_license string, observations_count bigint, sound_observations_count bigint, preferred_common_name string, extinct boolean, obs_photo struct<url:string,attribution:string,license:string>",
    "ebird": "ebird_code string, description string, image_url string, ml_asset_id string, image_attribution string, error string",
    "wikidata": f"ebird_code string, gbif_id string, ncbi_id string, avibase_id string, birdlife_id string, aliases array<string>, labels {MAP}, image struct<url:string,attribution:string,license:string,license_url:string>",
    "wikipedia": f"title string, extract string, description string, wikipedia_urls {MAP}, extracts {MAP}, image_url string, image_artist string, image_license string, error string, quality map<string,struct<attempts:int,last_checked:string,previous_status:string,last_status:string,page_title:string,words:bigint>>",
    "macaulay": "ml_taxon_code string, matched_name string, aliases array<string>",
    "xc": "xc_name string, matched_name string, aliases array<string>",
    "observationorg": "observationorg_id bigint, matched_name string, aliases array<string>",
    "translate": f"extracts {MAP}, fallback boolean, fallback_locales array<string>",
    "sound_classes": f"common_name string, taxon_group string, record_type string, wikidata_qid string, common_names {MAP}, common_name_aliases array<string>, scientific_name_aliases array<string>, image_url string",
}


#: Bytes of one keyed JSON document that a task reads at most; a larger source must come as JSON lines or Parquet.
MOST_DOCUMENT = 1 << 30


def keyed_json(spark: SparkSession, path: str, record: str, key: str = "scientific_name", required: bool = False, hint: str = "") -> DataFrame:
    """(ord, key, fields…) of a file that holds one object {key: record}; null records have null fields.

    One file is one row of text, so that its size is bound by a task's memory: beyond MOST_DOCUMENT bytes it raises, and
    the source is to be given as JSON lines or Parquet (`land`, `landed`), which any number of tasks read.
    """
    schema = StructType([StructField("ord", IntegerType()), StructField(key, StringType())])
    inner = spark.createDataFrame([], record).schema
    if not exists(spark, path):
        if required:
            raise FileNotFoundError(f"{path} is missing. {hint}".strip())
        return spark.createDataFrame([], StructType([*schema.fields, *inner.fields]))
    if (n := size(spark, path)) > MOST_DOCUMENT:
        raise ValueError(f"{path} has {n} bytes in one document; give it as JSON lines or Parquet")
    doc = spark.read.text(path, wholetext=True)
    entries = F.map_entries(F.from_json("value", f"map<string,struct<{_colons(record)}>>"))
    d = doc.select(F.posexplode(entries).alias("ord", "e"))
    return d.select("ord", F.col("e.key").alias(key), "e.value.*")


def _colons(ddl: str) -> str:
    """'a int, b map<..>' as the fields of a struct type."""
    out, depth, part = [], 0, ""
    for c in ddl + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            name, kind = part.strip().split(" ", 1)
            out.append(f"{name}:{kind}")
            part = ""
        else:
            part += c
    return ",".join(out)


def record_list(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Records of the first path that exists, a JSON list; raises where none does."""
    for p in paths:
        if exists(spark, p):
            return spark.read.schema(schema).json(p, multiLine=True)
    raise FileNotFoundError(f"none of {', '.join(paths)}")


def journal(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of an append-only journal; malformed lines are left out."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as strings, with `line` (the first data row is 2)."""
    d = spark.read.csv(path, header=True, sep=sep, multiLine=True, quote='"', escape='"')
    return d.withColumn("line", (F.monotonically_increasing_id() + 2).cast("bigint"))


def checklist(spark: SparkSession, path: str) -> DataFrame:
    """Species rows of the `;` checklist that have a name and a code; a missing file gives none."""
    cols = {"Scientific_name": "name", "Species_code_Cornell_Lab": "code", "English_name_Clements_v2024": "english_clements", "English_name_AviList": "english"}
    if not exists(spark, path):
        return spark.createDataFrame([], "ord bigint, name string, code string, english_clements string, english string")
    d = csv(spark, path, ";").where(strip("Taxon_rank") == "species")
    d = d.select(F.col("line").alias("ord"), *[blank_to_null(a).alias(b) for a, b in cols.items()])
    return d.where("name is not null and code is not null")


class InvalidRows(ValueError):
    """Rows of a checked table that break a rule, with their line numbers."""


def _check(d: DataFrame, rules: list[tuple[str, Column]], what: str) -> None:
    bad = reduce(DataFrame.unionByName, [d.where(test).select("line", F.lit(name).alias("rule")) for name, test in rules])
    rows = bad.orderBy("line", "rule").limit(20).collect()
    if rows:
        raise InvalidRows(f"{what}: " + "; ".join(f"line {r.line}: {r.rule}" for r in rows))


def _repeated(d: DataFrame, key: list[str]) -> DataFrame:
    return d.groupBy(*key).agg(F.count("*").alias("_n"), F.max("line").alias("line")).where("_n > 1")


def _require_columns(d: DataFrame, columns: list[str], what: str) -> None:
    if missing := [c for c in columns if c not in d.columns]:
        raise InvalidRows(f"{what}: missing columns {', '.join(missing)}")


def image_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Image and crop overrides, strictly checked: key given and unique, image fields all or none, anchor 1 to 9."""
    image = ["image_url", "image_author", "image_license", "image_source"]
    d = csv(spark, path)
    _require_columns(d, ["scientific_name", *image, "image_crop_anchor"], "overrides")
    d = d.select("line", *[null_to_blank(strip(c)).alias(c) for c in ["scientific_name", *image, "image_crop_anchor"]])
    given = reduce(lambda a, b: a + b, [(F.col(c) != "").cast("int") for c in image])
    anchor = F.col("image_crop_anchor").try_cast("int")
    _check(d, [("no scientific_name", F.col("scientific_name") == ""), ("image fields incomplete", (given > 0) & (given < len(image))), ("anchor not 1 to 9", (F.col("image_crop_anchor") != "") & ~F.coalesce(anchor.between(1, 9), F.lit(False)))], "overrides")
    twice = _repeated(d, ["scientific_name"]).orderBy("line").limit(20).collect()
    if twice:
        raise InvalidRows("overrides: " + "; ".join(f"line {r.line}: {r.scientific_name} twice" for r in twice))
    return d.withColumn("image_crop_anchor", anchor)


def aliases(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(scientific_name, alias, line): binomials on both sides, not the same, no pair twice.

    Not strict: rows that break a rule are left out, and a missing file gives none.
    """
    if not strict and not exists(spark, path):
        return spark.createDataFrame([], "scientific_name string, alias string, line bigint")
    d = csv(spark, path)
    _require_columns(d, ["scientific_name", "alias"], "aliases")
    d = d.select(strip("scientific_name").alias("scientific_name"), strip("alias").alias("alias"), "line")
    rules = [("scientific_name no binomial", ~is_binomial("scientific_name")), ("alias no binomial", ~is_binomial("alias")), ("alias of itself", F.coalesce(F.col("scientific_name") == F.col("alias"), F.lit(False)))]
    if not strict:
        good = reduce(lambda a, b: a & ~b[1], rules, F.lit(True))
        return d.where(good).groupBy("scientific_name", "alias").agg(F.min("line").alias("line"))
    _check(d, rules, "aliases")
    twice = _repeated(d, ["scientific_name", "alias"]).orderBy("line").limit(20).collect()
    if twice:
        raise InvalidRows("aliases: " + "; ".join(f"line {r.line}: pair twice" for r in twice))
    return d


def priority_species(spark: SparkSession, path: str) -> DataFrame:
    """Species to fetch in any case, strictly checked: binomial, group given, integer ids."""
    d = csv(spark, path)
    _require_columns(d, ["scientific_name", "taxon_group", "source", "reason", "inat_id", "gbif_id", "common_name"], "priority species")
    number = F.col("inat_id").try_cast("bigint")
    _check(d, [("no binomial", ~is_binomial("scientific_name")), ("no group", null_to_blank(strip("taxon_group")) == ""), ("inat_id no integer", (null_to_blank("inat_id") != "") & number.isNull())], "priority species")
    return d.withColumn("inat_id", number)


def landed(spark: SparkSession, path: str, record: str, key: str = "scientific_name") -> DataFrame:
    """(ord, key, fields…) of a source that was landed as Parquet, or as JSON lines with the key and `ord` in each."""
    schema = f"ord bigint, `{key}` string, {record}"
    return spark.read.schema(schema).json(path) if path.rstrip("/").endswith((".jsonl", ".json", ".ndjson")) else spark.read.schema(schema).parquet(path)


def land(d: DataFrame, path: str) -> None:
    """Write a source once as Parquet; the commit protocol makes the overwrite atomic."""
    d.write.mode("overwrite").parquet(path)
