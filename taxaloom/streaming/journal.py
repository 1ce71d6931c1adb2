"""An append-only journal of results as a stream merged into a state table.

The journal is a folder of JSON lines. Each micro-batch is reduced to one row per key and merged
into the state (Parquet, one folder per version, switched by a pointer file, in any file system that Spark reaches), earlier entries
prevailing per locale as in the batch replay. The stream's checkpoint makes restarts exact; a batch
that is delivered twice changes nothing, for the merge is idempotent.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom.functions import maps
from taxaloom.sources import storage

SCHEMA = "scientific_name string, extracts map<string,string>, fallback boolean, written_at timestamp"
STATE = "scientific_name string, extracts map<string,string>, fallback_locales array<string>"


def _pointer(folder: str) -> str:
    return f"{folder}/current.json"


def read_state(spark: SparkSession, folder: str) -> DataFrame:
    if not storage.exists(spark, _pointer(folder)):
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(f"{folder}/{json.loads(storage.read_text(spark, _pointer(folder)))['version']}")


def reduce_lines(lines: DataFrame) -> DataFrame:
    """One row per species: the first text of each locale, and the locales whose text was a fallback."""
    e = lines.where("scientific_name is not null").select("scientific_name", "written_at", F.coalesce("fallback", F.lit(False)).alias("fb"), F.explode("extracts").alias("locale", "text")).where("text <> ''")
    first = e.groupBy("scientific_name", "locale").agg(F.min_by(F.struct("text", "fb"), F.struct("written_at", "text")).alias("v"))
    return first.groupBy("scientific_name").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("locale", "v.text")))).alias("extracts"),
        F.array_sort(F.collect_list(F.when(F.col("v.fb"), F.col("locale")))).alias("fallback_locales"),
    )


def merge(state: DataFrame, new: DataFrame) -> DataFrame:
    """Earlier entries prevail; fallback marks follow the entries that were taken."""
    n = new.select("scientific_name", F.col("extracts").alias("_e"), F.col("fallback_locales").alias("_f"))
    d = state.withColumnsRenamed({"extracts": "_oe", "fallback_locales": "_of"}).join(n, "scientific_name", "full_outer")
    none = F.array().cast("array<string>")
    d = d.withColumn("_known", F.coalesce(F.map_keys("_oe"), none))
    taken = F.array_except(F.coalesce("_f", none), F.col("_known"))
    return d.select("scientific_name", maps.fill("_oe", "_e").alias("extracts"), F.array_sort(F.array_union(F.coalesce("_of", none), taken)).alias("fallback_locales"))


def write_state(df: DataFrame, folder: str, version: str) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/{version}")
    storage.write_text(df.sparkSession, _pointer(folder), json.dumps({"version": version}))


def replay(spark: SparkSession, journal: str) -> DataFrame:
    """The state that a whole journal gives, as a batch."""
    return reduce_lines(spark.read.schema(SCHEMA).option("mode", "DROPMALFORMED").json(journal))


def follow(spark: SparkSession, journal: str, state: str, checkpoint: str, once: bool = True):
    """Merge new journal files into the state; returns the query (ended, if `once`)."""
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")

    def step(batch: DataFrame, number: int) -> None:
        s = batch.sparkSession
        write_state(merge(read_state(s, state), reduce_lines(batch)), state, f"v{number:08d}")

    q = spark.readStream.schema(SCHEMA).option("mode", "DROPMALFORMED").json(journal).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    q = (q.trigger(availableNow=True) if once else q).start()
    if once:
        q.awaitTermination()
    return q


def pending(work: DataFrame, state: DataFrame, key: list[str]) -> DataFrame:
    """Work that the state doesn't have yet (a null result counts as done)."""
    return work.join(state.select(*key), key, "left_anti")


def count_attempts(state: DataFrame, outcomes: DataFrame, most: int) -> DataFrame:
    """(scientific_name, locale, attempts, last_status, open): attempts added up, open while below `most` and not ok."""
    n = outcomes.groupBy("scientific_name", "locale").agg(F.count("*").alias("_n"), F.max_by("status", "checked_at").alias("_s"))
    d = state.join(n, ["scientific_name", "locale"], "full_outer")
    a, s = F.coalesce("attempts", F.lit(0)) + F.coalesce("_n", F.lit(0)), F.coalesce("_s", "last_status")
    return d.select("scientific_name", "locale", a.cast("bigint").alias("attempts"), s.alias("last_status"), ((s != "ok") & (a < most)).alias("open"))
