"""Mix sources to target shares of tokens by iterative proportional fitting and calibrated sampling.

Tokens are counted with a public tokenizer (its file is a parameter). Documents fall into cells of
source, language and topic; the topic is an input column (in the queries, the group of the text's species).
The cell totals are pre-aggregated, and the fitting runs on the driver over all of them, as arrays of codes and
numbers and in blocks; no cell is left out or taken together with others, however many there are (unless MOST_CELLS is
set). Each mix's cells are raked in turn to the source marginal (the targets), the
language marginal and the topic marginal (the corpus's own, or given ones), with no cell above its source's
permitted repeats, until nothing changes; the source marginal comes last and is met exactly. A mix has the
size asked for, or is as large as its scarcest source permits, times FILL; of a size asked for, a source
gives its share or all it has. A cell's expected uses of a document are then realised by systematic
sampling along sizes, which runs on from cell to cell of a source: a document's place within its cell, counted
through range partitions, and the sum of the cells before it tell how often it is used, so that no group is held in
one task and one rule holds for any number of documents and partitions. `shares` reports what each source reached,
`marginals` what the rakes reached on every axis.

Defined results: spellings of a source that differ in case, blanks or punctuation are one source;
null languages and topics are 'und'; null and empty texts have no tokens and aren't used; a target source
that no document has gets 0 and its share is spread over the others in proportion; documents of
sources outside a mix aren't used.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.common import spread
from taxaloom.operators.ordering import rank_in_groups

TOKENIZER = os.path.join("/opt/tokenizers", "byte_bpe_50k.tiktoken")
#: Fixed value: the published pattern by which this vocabulary's texts are cut before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Share of the largest possible mix that is used, which leaves the rakes room to move.
FILL = 0.9
#: Only if set: the rarest languages and topics are taken together so that so many cells remain, and more targets raise.
MOST_CELLS: int | None = None
#: Planned cells that are broadcast; more are joined. The results are the same.
BROADCAST_CELLS = 200_000
#: Cells that the rakes work on at a time, for the sake of the driver's memory.
BLOCK = 1 << 20
AXES = ("skey", "lang", "topic")
PLAN = pa.schema([("cell", pa.int64()), ("mix_name", pa.string()), *((axis, pa.string()) for axis in AXES), ("uses", pa.float64()), ("before", pa.float64())])

@cache
def _tokenizer(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(df: DataFrame, text: str = "text", to: str = "tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """Add the number of tokens of each text; null and empty texts have 0."""

    @F.pandas_udf("bigint")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = _tokenizer(tokenizer)
        for b in batches:
            yield pd.Series([len(t.encode_ordinary(x)) if x else 0 for x in b], dtype="int64")

    return spread(df).withColumn(to, run(F.col(text)))


def source_key(column: str):
    return F.regexp_replace(F.lower(column), r"[^\p{L}\p{N}]", "")


def rake(tokens: np.ndarray, axes: list[np.ndarray], marginals: list[np.ndarray], cap: np.ndarray, least: float = 1e-9, most_rounds: int = 5000) -> np.ndarray:
    """Expected uses of each cell's documents: tokens * uses meets the marginals as far as the caps permit.

    axes: the category of each cell on each axis; marginals: the wanted tokens by category. The
    first axis is met last in each round, by scaling its uncapped cells until its total is right.
    Rounds end when none changes a use by more than the share `least`; marginals that contradict each other
    or the caps may leave a rest, which `marginals` reports.
    """
    n = len(tokens)
    blocks = [slice(i, i + BLOCK) for i in range(0, n, BLOCK)]
    use = np.ones(n)
    for _ in range(most_rounds):
        begun = use.copy()
        for axis, want in [*zip(axes[1:], marginals[1:]), (axes[0], marginals[0])]:
            for _ in range(n if axis is axes[0] else 1):
                now, held = np.zeros(len(want)), np.zeros(len(want))
                for b in blocks:
                    uses = tokens[b] * use[b]
                    now += np.bincount(axis[b], uses, len(want))
                    held += np.bincount(axis[b], uses * (use[b] >= cap[b] - 1e-9), len(want))
                free = now - held
                ratio = np.where(free > 1e-9, np.maximum(want - held, 0) / np.maximum(free, 1e-9), 1.0)
                ratio = np.where(want < held, np.where(now > 0, want / np.maximum(now, 1e-9), 1), ratio)
                done = True
                for b in blocks:
                    moved = np.where((use[b] < cap[b] - 1e-9) | (want < held)[axis[b]], use[b] * ratio[axis[b]], use[b])
                    new = np.minimum(moved, cap[b])
                    done = done and np.allclose(new, use[b], rtol=least, atol=0)
                    use[b] = new
                if done:
                    break
        if all(np.allclose(use[b], begun[b], rtol=least, atol=0) for b in blocks):
            break
    return use


def _folded(cells: DataFrame, most: int) -> DataFrame:
    """Cells whose rarest languages and topics are one, 'other', so that at most `most` cells remain."""
    sources = max(1, cells.select("skey").distinct().count())
    each = max(2, int((most / sources) ** 0.5))
    for axis in ("lang", "topic"):
        top = cells.groupBy(axis).agg(F.sum("tokens").alias("_n")).orderBy(F.desc("_n"), axis).limit(each - 1).select(axis, F.lit(True).alias("_kept"))
        cells = cells.join(F.broadcast(top), axis, "left").withColumn(axis, F.when(F.col("_kept"), F.col(axis)).otherwise("other")).drop("_kept")
    return cells


def _coded(column: pd.Series) -> tuple[np.ndarray, pd.Index]:
    """The codes of a column's values, and the values in order."""
    column = column.astype("category").cat.remove_unused_categories()
    names = column.cat.categories
    order = names.argsort()
    place = np.empty(len(names), "int32")
    place[order] = np.arange(len(names), dtype="int32")
    return place[column.cat.codes.to_numpy()], names[order]


def _dense(code: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes that occur, numbered without gaps, and whether each of the n occurs."""
    there = np.bincount(code, minlength=n) > 0
    return (np.cumsum(there, dtype="int32") - np.int32(1))[code], there


def plan(cells: pd.DataFrame, targets: pd.DataFrame, fill: float = FILL, size: float | None = None) -> pa.Table:
    """(cell, mix_name, skey, lang, topic, uses, before) of every cell of every mix; `size` is the wanted number of tokens of each.

    uses: the expected uses of each of the cell's documents; before: the broken part of those of all documents of the cells
    of the source that come before it.
    """
    coded = {axis: _coded(cells[axis]) for axis in AXES}
    order = np.lexsort([coded[axis][0] for axis in reversed(AXES)])
    codes, names = {axis: x[0][order] for axis, x in coded.items()}, {axis: x[1] for axis, x in coded.items()}
    tokens, docs = (cells[c].to_numpy(float)[order] for c in ("tokens", "docs"))
    whole = {axis: np.bincount(codes[axis], tokens, len(names[axis])) / max(1, tokens.sum()) for axis in ("lang", "topic")}
    out = []
    for mix, t in targets.groupby("mix_name", sort=True):
        t = t.groupby("skey").agg(share=("target_share", "sum"), cap=("max_repeats", "max")).reindex(names["skey"])
        share, most = t["share"].to_numpy(float), t["cap"].to_numpy(float)
        at = np.flatnonzero((tokens > 0) & ((share > 0) & (most > 0))[codes["skey"]])
        if not len(at):
            continue
        c = {axis: code[at] for axis, code in codes.items()}
        n, k = tokens[at], docs[at]
        dense = {axis: _dense(c[axis], len(names[axis])) for axis in AXES}
        source, there = dense["skey"]
        share, most = share[there] / share[there].sum(), most[there]
        have = np.bincount(source, n) * most
        total = size or fill * float((have / share).min())
        wants = [np.minimum(total * share / share.sum(), have)]
        for axis in ("lang", "topic"):
            s = whole[axis][dense[axis][1]]
            wants.append(total * s / s.sum())
        use = rake(n, [dense[axis][0] for axis in AXES], wants, most[source])
        broken = k * (use - np.floor(use))
        for i in np.split(np.arange(len(at)), np.flatnonzero(np.diff(source)) + 1):
            broken[i] = np.concatenate([[0.0], np.cumsum(broken[i])[:-1]])
        strings = [pa.DictionaryArray.from_arrays(c[axis], pa.array(names[axis], pa.string())).cast(pa.string()) for axis in AXES]
        first = sum(x.num_rows for x in out)
        out.append(pa.table([np.arange(first, first + len(at)), pa.repeat(str(mix), len(at)), *strings, use, broken - np.floor(broken)], schema=PLAN))
    return pa.concat_tables(out) if out else PLAN.empty_table()


def cells_of(counted: DataFrame, tokens: str = "tokens", topic: str | None = None, materialise=None) -> DataFrame:
    """(doc_id, skey, lang, topic, tokens) of each counted document that has tokens; `topic` names its topic column, if any."""
    und = lambda c: F.coalesce(c, F.lit("und"))
    t = F.col(topic) if topic else F.lit(None).cast("string")
    d = counted.select("doc_id", source_key("source").alias("skey"), und("lang").alias("lang"), und(t).alias("topic"), F.col(tokens).alias("tokens"))
    return (materialise(d) if materialise else d).where("tokens > 0 and skey is not null")


def prepare(documents: DataFrame, tokenizer: str = TOKENIZER, topic: str | None = None, materialise=None) -> DataFrame:
    """The same of documents whose tokens have to be counted first."""
    columns = ["doc_id", "text", "lang", "source", *([topic] if topic else [])]
    return cells_of(with_tokens(documents.select(*columns), to="_tokens", tokenizer=tokenizer), "_tokens", topic, materialise)


def mix(prepared: DataFrame, targets: DataFrame, fill: float = FILL, seed: int = 7, size: float | None = None) -> DataFrame:
    """(mix_name, doc_id, skey, lang, topic, tokens, repeats) of every document used."""
    spark = prepared.sparkSession
    wanted = targets.withColumn("skey", source_key("source"))
    small = wanted.toPandas()
    if MOST_CELLS and len(small) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} targets")
    keys = F.broadcast(wanted.select("skey").distinct())

    def totals(d: DataFrame) -> DataFrame:
        return d.join(keys, "skey", "left_semi").groupBy(*AXES).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))

    if MOST_CELLS and totals(prepared).count() > MOST_CELLS:
        prepared = _folded(prepared, MOST_CELLS)
    p = plan(totals(prepared).toArrow().to_pandas(categories=list(AXES)), small, fill, size)
    cell = spark.createDataFrame(p)
    d = prepared.join(F.broadcast(cell) if p.num_rows <= BROADCAST_CELLS else cell, list(AXES))
    d = d.withColumn("_u", F.xxhash64(F.lit(seed), "mix_name", "doc_id"))
    # Running on from cell to cell of a source, so that its uses and those of each cell are met within one document.
    d = rank_in_groups(d, ["cell"], [F.col("tokens"), F.col("_u"), F.col("doc_id")], "place")
    frac = "(uses - floor(uses))"
    d = d.withColumn("repeats", F.expr(f"cast(floor(uses) + (floor(before + place * {frac} + 0.5 + 1e-9) - floor(before + (place - 1) * {frac} + 0.5 + 1e-9)) as bigint)"))
    return d.where("repeats > 0").select("mix_name", "doc_id", "skey", "lang", "topic", "tokens", "repeats")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_name, source, target_share, actual_share, tokens, documents, most_repeats, max_repeats)."""
    got = mixed.groupBy("mix_name", "skey").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"))
    t = targets.withColumn("skey", source_key("source")).join(got, ["mix_name", "skey"], "left")
    total = F.expr("sum(coalesce(tokens, 0)) over (partition by mix_name)")
    return t.select(
        "mix_name", "source", "target_share", F.round(F.coalesce(F.col("tokens") / total, F.lit(0.0)), 6).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), "max_repeats",
    )


def marginals(mixed: DataFrame, prepared: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_name, axis, category, wanted_share, actual_share): what the rakes were to reach and what the mix has.

    Wanted are the corpus's own shares of languages and topics (of the sources that occur in targets), over the
    categories that the mix has at all.
    """
    keys = targets.select(source_key("source").alias("skey")).distinct()
    whole = prepared.join(F.broadcast(keys), "skey", "left_semi")
    axes = F.explode(F.create_map(F.lit("lang"), F.col("lang"), F.lit("topic"), F.col("topic"))).alias("axis", "category")
    want = whole.groupBy("lang", "topic").agg(F.sum("tokens").alias("n")).select(axes, "n").groupBy("axis", "category").agg(F.sum("n").alias("wanted"))
    got = mixed.groupBy("mix_name", "lang", "topic").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("n")).select("mix_name", axes, "n")
    got = got.groupBy("mix_name", "axis", "category").agg(F.sum("n").alias("actual")).join(want, ["axis", "category"])
    share = lambda c: F.expr(f"round({c} / sum({c}) over (partition by mix_name, axis), 6)")
    return got.select("mix_name", "axis", "category", share("wanted").alias("wanted_share"), share("actual").alias("actual_share"))


def kept(mixed: DataFrame, shares_: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """(mix_name, repeats_kept, each_once, shares_met): whether a mix keeps what it has to.

    No record may be used more often than allowed, each stands in one row, and each present source's share is within
    `tolerance` of its target, absent sources' targets being spread over the present ones.
    """
    rows = mixed.groupBy("mix_name", "doc_id").agg(F.count("*").alias("n")).groupBy("mix_name").agg((F.max("n") == 1).alias("each_once"))
    wanted = F.expr("target_share / sum(case when documents > 0 then target_share end) over (partition by mix_name)")
    s = shares_.withColumn("_w", wanted).groupBy("mix_name").agg(
        F.every(F.col("most_repeats") <= F.col("max_repeats")).alias("repeats_kept"),
        F.every((F.col("documents") == 0) | (F.abs(F.col("actual_share") - F.col("_w")) <= tolerance)).alias("shares_met"),
    )
    return s.join(rows, "mix_name", "left").select("mix_name", "repeats_kept", F.coalesce("each_once", F.lit(True)).alias("each_once"), "shares_met")
