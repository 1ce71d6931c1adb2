"""Greedy batches under a limit: a new batch begins where the next item no longer fits.

The rule is sequential within a group, and a group may hold a large share of all rows. It is
solved exactly in pieces: rows are range-partitioned by group and order; each piece tells, for
every place at which a batch could begin near its start, in which state it leaves its end; a scan
over these few states of a group (one a piece) fixes where each piece really begins; the pieces
then number their batches on their own. Items are numbers (texts are measured first, in the JVM), a
batch holds at most `most` of them and a piece about PIECE rows, so that pieces and states are small.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.functions.passages import ended_at_sentence, ended_with_ellipsis
from taxaloom.operators.ordering import global_rank
from taxaloom.session import checkpoint

#: Rows of a piece, on average.
PIECE = 50_000

Fits = Callable[[list], bool]


def by_budget(budget: int, most: int) -> Fits:
    """Items are lengths: their sum stays within the budget and their number within `most`."""
    return lambda items: len(items) <= max(1, most) and sum(max(1, x) for x in items) <= max(1, budget)


class Rendered:
    """Texts rendered with markers, each cut to an equal share, stay within `most_chars`.

    Such an item is a list: its length when cut to the share of a batch of 1, 2, ... `most` items.
    """

    def __init__(self, most_chars: int, most: int):
        self.most_chars, self.most = most_chars, most
        #: Characters of the markers and gaps of a batch of n items.
        self.around = [sum(len(f"[[[{i}]]]\n") for i in range(1, n + 1)) + 2 * max(0, n - 1) for n in range(most + 1)]

    def share(self, n: int) -> int:
        return max(80, self.most_chars // n - 16)

    def measure(self, text: Column) -> Column:
        return F.array(*[F.length(ended_at_sentence(text, self.share(n))).cast("bigint") for n in range(1, self.most + 1)])

    def __call__(self, items: list) -> bool:
        n = len(items)
        return n <= self.most and self.around[n] + sum(x[n - 1] for x in items) <= self.most_chars


def _plain(items: pd.Series) -> list:
    return [x if isinstance(x, int) else list(map(int, x)) for x in items.tolist()]


def _next_starts(items: list, fits: Fits) -> list[int]:
    """For a batch that begins at each place, where the next one begins (len(items): beyond the piece)."""
    out = []
    for i in range(len(items)):
        j = i + 1
        while j < len(items) and fits(items[i : j + 1]):
            j += 1
        out.append(j)
    return out


def _walk(nxt: list[int], at: int) -> tuple[list[int], int]:
    """All starts from one on, and the last of them."""
    starts = []
    while at < len(nxt):
        starts.append(at)
        at = nxt[at]
    return starts, starts[-1] if starts else -1


def greedy_batches(df: DataFrame, group: list[str], ord_: str, item: str, fits: Fits, most: int, parts: int | None = None, to: str = "batch") -> DataFrame:
    """Add the batch number (from 0) of each row within its group, in the order of `ord_`.

    A single item that doesn't fit makes a batch of its own. Orders must be unique in a group;
    null items count as empty.
    """
    spark = df.sparkSession
    n = parts or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / PIECE))
    x = fits.measure(F.coalesce(item, F.lit(""))) if isinstance(fits, Rendered) else F.coalesce(F.col(item).cast("bigint"), F.lit(0))
    gid = F.to_json(F.struct(*group)) if group else F.lit("{}")
    d = df.select(gid.alias("g"), F.col(ord_).alias("o"), x.alias("x"))
    d = checkpoint(d.repartitionByRange(n, "g", "o").withColumn("p", F.spark_partition_id()))

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("o")
        items = _plain(pdf["x"])
        nxt = _next_starts(items, fits)
        out = []
        for j in range(min(most + 1, len(items))):
            starts, last = _walk(nxt, j)
            out.append([len(starts), items[last:]])
        return pd.DataFrame({"g": [pdf["g"].iloc[0]], "p": [int(pdf["p"].iloc[0])], "n": [len(items)], "head": [json.dumps(items[: most + 1])], "ends": [json.dumps(out)]})

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        state: list = []
        begun, out = 0, []
        for r in pdf.sort_values("p").itertuples():
            head, table, j = json.loads(r.head), json.loads(r.ends), 0
            if state:
                while j < len(head) and fits([*state, head[j]]):
                    state = [*state, head[j]]
                    j += 1
            out.append((r.g, r.p, j, begun))
            if j < r.n:
                starts, state = table[j]
                begun += starts
        return pd.DataFrame(out, columns=["g", "p", "first", "begun"])

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("o")
        nxt = _next_starts(_plain(pdf["x"]), fits)
        starts = set(_walk(nxt, int(pdf["first"].iloc[0]))[0])
        at, out = int(pdf["begun"].iloc[0]) - 1, []
        for i in range(len(pdf)):
            at += i in starts
            out.append(at)
        return pd.DataFrame({"g": pdf["g"].to_numpy(), "o": pdf["o"].to_numpy(), "b": out})

    otype = dict(df.dtypes)[ord_]
    e = d.groupBy("g", "p").applyInPandas(ends, "g string, p int, n bigint, head string, ends string")
    s = e.groupBy("g").applyInPandas(scan, "g string, p int, first bigint, begun bigint")
    b = d.join(s, ["g", "p"]).groupBy("g", "p").applyInPandas(number, f"g string, o {otype}, b bigint")
    b = b.toDF("__g", "__o", "__b")
    return df.withColumn("__group", gid).join(b, (F.col("__group") == F.col("__g")) & (F.col(ord_) == F.col("__o"))).drop("__group", "__g", "__o", to).withColumnRenamed("__b", to)


def by_signature(df: DataFrame, signature: str, ord_: str, text: str, budget: int, most: int, most_chars: int) -> DataFrame:
    """Batches of the rows with the same (array) signature, with the group's size and the batch's turn from 1.

    Turns go to larger groups first, then to longer signatures, then by signature and batch.
    """
    d = df.withColumn("_len", F.length(ended_with_ellipsis(text, most_chars)).cast("bigint")).withColumn("_sig", F.array_join(signature, ","))
    b = greedy_batches(d, ["_sig"], ord_, "_len", by_budget(budget, most), most)
    size = d.groupBy("_sig").agg(F.count("*").alias("group_size"), F.first(F.size(signature)).alias("_n"))
    turns = b.select("_sig", "batch").distinct().join(size, "_sig")
    turns = global_rank(turns, [F.desc("group_size"), F.desc("_n"), F.col("_sig"), F.col("batch")], "turn").select("_sig", "batch", "group_size", "turn")
    return b.join(turns, ["_sig", "batch"]).drop("_len", "_sig")
