"""Entity resolution across sources: match cascades, claims, fallbacks and normalisation chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.operators.ordering import last_wins
from taxaloom.session import checkpoint


def resolve_claims(cands: DataFrame) -> DataFrame:
    """(ord, claim, source) of every row, claims taken strictly in row order.

    cands has `ord` and three nullable candidate owners: direct, named, linked. A row with a
    direct owner claims it whether or not it is claimed; else it claims its named owner if nobody
    before it claimed that; else it claims its linked owner without asking. As an earlier claim
    can move a later row to its linked owner, which is a claim itself, the rule is sequential.

    Of the rows that name one owner only the first can get it: either it does, or the owner was claimed
    before. So all others go to their linked owner, and the first of an owner is moved only if a claim that is
    certain comes before it, or the linked claim of another owner's first that is moved itself. Each
    first leads to one other at most, and always to a later row, so that what is moved is what can be reached
    from the certain ones in a forest: found by doubling steps, in as many rounds as the longest chain has binary
    digits. Null orders are not permitted; rows without candidates come out with a null claim.
    """
    base = checkpoint(cands.select("ord", "direct", "named", "linked"))
    open_ = base.where("direct is null and named is not null")
    first = checkpoint(open_.groupBy(F.col("named").alias("o")).agg(F.min(F.struct("ord", "linked")).alias("_f")).select("o", "_f.ord", "_f.linked"))
    later = open_.join(first.select("ord"), "ord", "left_anti")
    idle = base.where("direct is null and named is null")
    sure = base.where("direct is not null").select(F.col("direct").alias("o"), "ord").unionByName(idle.unionByName(later).select(F.col("linked").alias("o"), "ord"))
    sure = sure.where("o is not null").groupBy("o").agg(F.min("ord").alias("_sure"))
    moved = checkpoint(first.join(sure, "o").where("_sure < ord").select("o"))
    nodes = first.select(F.col("o").alias("b"), F.col("ord").alias("_b"))
    step = checkpoint(first.where("linked is not null").select(F.col("o").alias("a"), F.col("linked").alias("b"), "ord").join(nodes, "b").where("ord < _b").select("a", "b"))
    while not step.isEmpty():
        moved = checkpoint(moved.unionByName(moved.join(step, F.col("o") == F.col("a")).select(F.col("b").alias("o"))).distinct())
        step = checkpoint(step.join(step.toDF("b", "c"), "b").select("a", F.col("c").alias("b")))
    taken = first.join(moved, "o", "left_anti").select("ord", F.lit(True).alias("_named"))
    d = base.join(taken, "ord", "left")
    claim = F.when(F.col("direct").isNotNull(), F.col("direct")).when(F.col("_named"), F.col("named")).otherwise(F.col("linked"))
    source = F.when(F.col("direct").isNotNull(), "direct").when(F.col("_named"), "named").when(F.col("linked").isNotNull(), "linked")
    return d.select("ord", claim.alias("claim"), source.alias("source"))


def match_cascade(rows: DataFrame, checklist: DataFrame, links: DataFrame) -> DataFrame:
    """(ord, claim, source): owner of each row by exact name, English name, or linked code.

    rows(ord, name, english), checklist(ord, name, english, code), links(name, code). Of several
    checklist rows with one key the last counts.
    """
    by_name = last_wins(checklist.where("name is not null"), ["name"], "ord", ["code"]).select("name", F.col("name").alias("direct"))
    by_english = last_wins(checklist.where("english is not null").withColumn("e", F.lower("english")), ["e"], "ord", ["name"]).select("e", F.col("name").alias("named"))
    by_code = last_wins(checklist.where("code is not null"), ["code"], "ord", ["name"]).select("code", F.col("name").alias("linked"))
    x = rows.join(by_name, "name", "left").join(by_english, F.lower("english") == F.col("e"), "left")
    x = x.join(links.select("name", "code"), "name", "left").join(by_code, "code", "left")
    return resolve_claims(x.select("ord", "direct", "named", "linked"))


def first_of(*options: Column) -> Column:
    """The first option that is neither null nor ''."""
    return F.coalesce(*[F.nullif(o, F.lit("")) for o in options])


def fallback_lookup(rows: DataFrame, key: str, sources: list[tuple[str, DataFrame]], value: str, to: str = "matched_by") -> DataFrame:
    """Resolve each row by the first source that knows it; later sources see only the remainder.

    sources: (name, DataFrame(key, value)). Every pass is an equi-join with what is left.
    """
    out, left = None, rows
    for name, s in sources:
        s = s.where(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value))
        hit = left.join(s, key).withColumn(to, F.lit(name))
        left = left.join(s, key, "left_anti")
        out = hit if out is None else out.unionByName(hit)
    rest = left.withColumn(value, F.lit(None).cast("string")).withColumn(to, F.lit(None).cast("string"))
    return rest if out is None else out.unionByName(rest)


def unambiguous(df: DataFrame, name: str, owner: str) -> DataFrame:
    """(name, owner) of names that just one owner has."""
    g = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(owner).alias(owner), F.max(owner).alias("_m"))
    return g.where(F.col(owner) == F.col("_m")).drop("_m")


def follow_titles(inputs: DataFrame, normalized: DataFrame, redirects: DataFrame, pages: DataFrame) -> DataFrame:
    """(title, page_id): an asked title through normalisation and redirect to its page, null without one."""
    x = inputs.join(normalized.select(F.col("from").alias("title"), F.col("to").alias("_n")), "title", "left").withColumn("_t", F.coalesce("_n", "title"))
    x = x.join(redirects.select(F.col("from").alias("_t"), F.col("to").alias("_r")), "_t", "left").withColumn("_p", F.coalesce("_r", "_t"))
    return x.join(pages.select(F.col("title").alias("_p"), "page_id"), "_p", "left").select("title", "page_id")


def unknown_keys(keys: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys of an override table that the records don't have."""
    return keys.select(key).distinct().join(known.select(key), key, "left_anti")


def require_known(keys: DataFrame, known: DataFrame, key: str, what: str = "override") -> None:
    """Raise with a sample where override keys are unknown."""
    bad = [r[0] for r in unknown_keys(keys, known, key).orderBy(key).limit(20).collect()]
    if bad:
        raise ValueError(f"unknown {what} keys: {', '.join(map(str, bad))}")


