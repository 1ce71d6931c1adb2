"""Operators whose result depends on the delivered order, which must be a column (`ord`).

All are aggregates or windows within a key; numbering over a whole table goes through range
partitions (`global_rank`), never through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_wins(df: DataFrame, key: list[str], ord_: str, values: list[str]) -> DataFrame:
    """The last row of each key (an index filled by assignment). Partial aggregation before the shuffle."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*values), F.col(ord_)).alias("_v")).select(*key, "_v.*")


def first_wins(df: DataFrame, key: list[str], ord_: str, values: list[str]) -> DataFrame:
    """The first row of each key (an index filled only where absent)."""
    return df.groupBy(*key).agg(F.min_by(F.struct(*values), F.col(ord_)).alias("_v")).select(*key, "_v.*")


def union_first_wins(parts: list[DataFrame], key: list[str], values: list[str]) -> DataFrame:
    """Union of sources in which an earlier source's row of a key prevails."""
    all_ = None
    for i, p in enumerate(parts):
        x = p.select(*key, *values, F.lit(i).alias("_rank"))
        all_ = x if all_ is None else all_.unionByName(x)
    return first_wins(all_, key, "_rank", values)


def union_last_wins(parts: list[DataFrame], key: list[str], values: list[str]) -> DataFrame:
    """Union of sources in which a later source's row of a key prevails."""
    return union_first_wins(list(reversed(parts)), key, values)


def global_rank(df: DataFrame, by: list[Column], to: str = "rank", parts: int | None = None) -> DataFrame:
    """Number all rows from 1 in an order that must be total.

    Rows are range-partitioned and numbered within their partition by a window; the partitions'
    sizes (one number each) are summed up and added. Nothing runs in a single task.
    """
    n = parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(n, *by).withColumn("_p", F.spark_partition_id())
    from taxaloom.session import checkpoint

    ranged = checkpoint(ranged)
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    offsets = sizes.withColumn("_off", F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))).select("_p", F.coalesce("_off", F.lit(0)).alias("_off"))
    w = Window.partitionBy("_p").orderBy(*by)
    return ranged.withColumn("_n_in_part", F.row_number().over(w)).join(F.broadcast(offsets), "_p").withColumn(to, (F.col("_n_in_part") + F.col("_off")).cast("bigint")).drop("_p", "_n_in_part", "_off")


def assign_ids(rows: DataFrame, known: DataFrame, key: str, ord_: str, to: str = "number") -> DataFrame:
    """(key, number): known keys keep theirs, new ones continue after the largest, in row order."""
    top = known.agg(F.coalesce(F.max(to), F.lit(0))).first()[0]
    fresh = rows.join(known, key, "left_anti").groupBy(key).agg(F.min(ord_).alias("_o"))
    ranked = global_rank(fresh, [F.col("_o"), F.col(key)], "_r")
    new = ranked.select(key, (F.col("_r") + F.lit(top)).cast("bigint").alias(to))
    return known.join(rows.select(key).distinct(), key, "left_semi").select(key, F.col(to).cast("bigint").alias(to)).unionByName(new)


def reassign_ids(rows: DataFrame, key: str, to: str = "number") -> DataFrame:
    """(key, number): ranks of the distinct keys in code point order."""
    return global_rank(rows.select(key).distinct(), [F.col(key)], to)


def rank_in_groups(df: DataFrame, groups: list[str], by: list[Column], to: str = "rank", parts: int | None = None) -> DataFrame:
    """Number the rows of each group from 1 in an order that must be total; null groups are groups.

    Rows are range-partitioned by group and order, so that a group of any size lies in several partitions; each numbers
    its own piece, and the sizes of the pieces before it (one number a group and partition) are added.
    """
    from taxaloom.session import checkpoint

    n = parts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    d = checkpoint(df.repartitionByRange(n, *groups, *by).withColumn("_p", F.spark_partition_id()))
    piece = Window.partitionBy("_p", *groups)
    before = d.groupBy("_p", *groups).agg(F.count("*").alias("_n"))
    before = before.withColumn("_off", F.coalesce(F.sum("_n").over(Window.partitionBy(*groups).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = before.select(F.col("_p").alias("_q"), *[F.col(g).alias(f"_g_{g}") for g in groups], "_off")
    same = [F.col("_p") == F.col("_q"), *[F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups]]
    ranked = d.withColumn("_i", F.row_number().over(piece.orderBy(*by))).join(before, same)
    return ranked.withColumn(to, (F.col("_i") + F.col("_off")).cast("bigint")).drop("_p", "_q", "_i", "_off", *[f"_g_{g}" for g in groups])


def chunks(df: DataFrame, by: list[Column], size: int, within: list[str] | None = None, to: str = "chunk") -> DataFrame:
    """Number fixed-size chunks from 0, within groups or over all rows."""
    ranked = rank_in_groups(df, within, by, "_rank") if within else global_rank(df, by, "_rank")
    return ranked.withColumn(to, F.floor((F.col("_rank") - 1) / size).cast("bigint")).drop("_rank")


def top_by_count(df: DataFrame, key: str, ord_: str, n: int) -> DataFrame:
    """(key, n): the most frequent keys, ties by first appearance."""
    g = df.groupBy(key).agg(F.count("*").alias("n"), F.min(ord_).alias("_first"))
    return g.orderBy(F.desc("n"), F.asc("_first"), F.asc(key)).limit(n).select(key, "n")
