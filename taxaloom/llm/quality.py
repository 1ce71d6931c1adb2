"""Text quality statistics of each document, and the verdict prose, list, table or junk.

The statistics are Spark expressions. The verdict is an ordered rule list that was induced once
by incremental reduced-error pruning on labelled documents (`induce`, run by `train_quality.py`)
and stored in models/quality_rules.json; `prose_sql` and `kind_sql` export the thresholds to SQL CASE expressions,
so that applying it is a projection inside code generation: no Python and no shuffle.

Defined results: a null text has null statistics and a null verdict; an empty or blank text has
word_count 0 and the verdict 'prose' (nothing speaks against it); very long texts are processed
whole; repeated rows give repeated results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.common import COMMON_WORDS, load_model

#: The statistics that the rules may test, in order.
FEATURES = (
    "word_count", "mean_word_length", "symbol_ratio", "digit_ratio", "punct_line_share",
    "common_word_share", "sentence_share", "separator_rate", "line_count", "distinct_share",
    "longest_word", "markup_share", "glued_rate", "item_line_share", "label_line_share", "vowelless_share",
)


#: White space, as a class of Latin characters alone, which matches fast.
_SPACES = r"[\\s\\x{85}\\x{a0}]+"


def _in_list() -> str:
    words = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _count(text: str, pattern: str) -> str:
    return f"regexp_count({text}, '{pattern}')"


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the statistics as columns; `text` names the text column.

    sentence_share is the share of characters in sentences, that is in stretches closed by a
    terminator that hold enough common words (or kana); separator_rate counts list separators and
    line breaks outside of sentences per word, glued_rate punctuation between letters;
    item_line_share and label_line_share are the unclosed lines that begin with a list mark or a label; vowelless_share
    the Latin words of three letters or more without a vowel; CJK text counts two characters as one word.
    """
    t = f"`{text}`"
    common = _in_list()
    end = r"[.!?…。！？][\"”»’\\)\\]\\d\\[]*$"
    piece_ok = rf"""p -> right(p, 1) in ('.', '!', '?') and (
          (size(filter(split(p, '[^\\p{{L}}]+'), w -> w in ({common}))) >= 0.12 * size(split(p, '{_SPACES}'))
           and length(p) >= 15 and {_count('p', r'[;|/»>·•=]')} <= 2)
          or {_count('p', r'[\\x{3040}-\\x{309f}]')} >= 0.25 * length(p))"""
    # Full-width terminators become plain ones first: a class of Latin characters alone is matched much faster.
    pieces = rf"regexp_extract_all(translate(regexp_replace(_low, '\\n(?=\\p{{L}})', ' '), '。！？', '.!?'), '[^\\n.!?]++[.!?]?+', 0)"
    item = r"^\\s*(?:[-*•·–—]|\\(?\\d{1,3}[.)])\\s"

    def bound(value: str, name: str, fields: dict[str, str]) -> str:
        """A struct of what an array gives; the array is bound once and never leaves the expression."""
        return f"element_at(transform(array({value}), {name} -> struct({', '.join(f'{e} as {k}' for k, e in fields.items())})), 1)"

    parts = {
        "_words": bound(rf"filter(split({t}, '{_SPACES}'), w -> w <> '')", "ws", {"n": "size(ws)", "unlike": "size(array_distinct(ws))"}),
        "_tokens": bound(rf"filter(split(_low, '[^\\p{{L}}]+'), w -> w <> '')", "ws", {"n": "size(ws)", "common": f"size(filter(ws, w -> w in ({common})))", "vowelless": "size(filter(ws, w -> w rlike '^[b-df-hj-np-tv-xz]{3,}$'))"}),
        "_lines": bound(rf"filter(split({t}, '\\n'), l -> trim(l) <> '')", "ls", {"n": "size(ls)", "punct": f"size(filter(ls, l -> rtrim(l) rlike '{end}'))", "item": f"size(filter(ls, l -> l rlike '{item}' and not (rtrim(l) rlike '{end}')))"}),
        "_sentences": bound(f"filter({pieces}, {piece_ok})", "ps", {"n": "size(ps)", "joined": "array_join(ps, '\\n')"}),
        "_cjk": _count(t, r"[\\x{3040}-\\x{30ff}\\x{3400}-\\x{9fff}\\x{ac00}-\\x{d7af}]"),
    }
    # The parts pass through a generator, so that no statistic that uses one computes it again.
    d = df.withColumn("_low", F.explode(F.array(F.lower(text)))).withColumn("_b", F.explode(F.array(F.struct(*[F.expr(e).alias(k) for k, e in parts.items()]))))
    d = d.withColumns({"_t": F.col(text), **{k: F.col(f"_b.{k}") for k in parts}})
    d = d.withColumns({"_n": F.expr("greatest(length(_t), 1)"), "word_count": F.expr("cast(_words.n + floor(_cjk / 2) as bigint)")})
    words = "greatest(word_count, 1)"
    by_line = lambda n: F.expr(f"round(coalesce({n} / nullif(_lines.n, 0), 0), 4)")
    separators = r"[,;/|»>·•\\t、]|(?<!=)=(?!=)"
    d = d.withColumns(
        {
            "mean_word_length": F.expr(f"round((length(_t) - {_count('_t', r'(?U)\\s')}) / {words}, 4)"),
            "symbol_ratio": F.expr(
                f"round({_count('_t', r'[^\\p{L}\\p{M}\\p{N}\\s.,!?:…。、！？()\\[\\]\"“”„«»‘’\\x27\\x{2013}\\x{2014}-]')} / _n, 4)"
            ),
            "digit_ratio": F.expr(f"round({_count('_t', r'\\p{Nd}')} / _n, 4)"),
            "punct_line_share": by_line("_lines.punct"),
            "common_word_share": F.expr(
                f"round((_tokens.common + {_count('_t', r'[\\x{3040}-\\x{309f}]')} / 4) / greatest(_tokens.n + _cjk / 2, 1), 4)"
            ),
            "sentence_share": F.expr("round((length(_sentences.joined) - greatest(_sentences.n - 1, 0)) / _n, 4)"),
            "vowelless_share": F.expr("round(_tokens.vowelless / greatest(_tokens.n, 1), 4)"),
            "line_count": F.expr("cast(_lines.n as bigint)"),
            "item_line_share": by_line("_lines.item"),
            "label_line_share": by_line(
                rf"size(filter(split(_t, '\\n'), l -> trim(l) <> '' and l rlike '^\\S{{2,14}}\\s*(?:[:=|;\\t]|[.]{{3,}}|\\s\\s)\\s*\\S' and not (rtrim(l) rlike '{end}')))"
            ),
            "distinct_share": F.expr("round(_words.unlike / greatest(_words.n, 1), 4)"),
            "longest_word": F.expr(rf"cast(coalesce(array_max(transform(split(_t, '{_SPACES}'), w -> length(regexp_replace(w, '[^\\x{{00}}-\\x{{2fff}}]', '')))), 0) as bigint)"),
            "markup_share": F.expr("round(1 - length(regexp_replace(_t, '<[^<>]*>', '')) / _n, 4)"),
        }
    )
    d = d.withColumns(
        {
            "separator_rate": F.expr(
                f"""round(({_count('_t', separators)} - {_count('_sentences.joined', separators)}
                    + (1 - sentence_share) * ({_count('_t', r'\\n')} + {_count('_t', r' {2,}')})) / {words}, 4)"""
            ),
            "glued_rate": F.expr(f"round({_count('_t', r'\\p{L}[;:,!?]+\\p{L}')} / {words}, 4)"),
        }
    )
    return d.drop("_b", "_low", "_t", "_n", *parts)


# ---------------------------------------------------------------- rule induction (numpy)


def _covers(x: np.ndarray, rule: list) -> np.ndarray:
    m = np.ones(len(x), bool)
    for f, op, v in rule:
        m &= (x[:, f] <= v) if op == "<=" else (x[:, f] > v)
    return m


def _grow(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], most: int = 5) -> list:
    """Add the test with the highest FOIL gain until no negative is covered."""
    rule: list = []
    m = np.ones(len(x), bool)
    while len(rule) < most:
        p0, n0 = (y & m).sum(), (~y & m).sum()
        if n0 == 0 or p0 == 0:
            break
        base, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for f, cs in enumerate(cuts):
            v = x[m, f]
            yy = y[m]
            order = np.argsort(v, kind="stable")
            vs, cp, ca = v[order], np.cumsum(yy[order]), np.arange(1, len(v) + 1)
            at = np.searchsorted(vs, cs, side="right")
            for c, k in zip(cs, at):
                for op, p, a in (("<=", cp[k - 1] if k else 0, k), (">", p0 - (cp[k - 1] if k else 0), len(v) - k)):
                    if p and a < len(v):
                        gain = p * (np.log2(p / a) - base)
                        if gain > best[0]:
                            best = (gain, (f, op, float(c)))
        if best[1] is None:
            break
        rule.append(best[1])
        m = m & _covers(x, [best[1]])
    return rule


def _prune(x: np.ndarray, y: np.ndarray, rule: list) -> tuple[list, float]:
    """Drop final tests while (p - n) / (p + n) on the pruning part doesn't fall."""
    def worth(r: list) -> float:
        m = _covers(x, r)
        p, n = (y & m).sum(), (~y & m).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best = min(range(1, len(rule) + 1), key=lambda k: (-worth(rule[:k]), k)) if rule else 0
    return rule[:best], worth(rule[:best]) if rule else -1.0


def tidy(rule: list) -> list:
    """The same rule with one test for each feature and direction, the narrowest."""
    kept: dict[tuple, float] = {}
    for f, op, v in rule:
        kept[f, op] = v if (f, op) not in kept else (min if op == "<=" else max)(kept[f, op], v)
    return [(f, op, v) for (f, op), v in kept.items()]


def induce(x: np.ndarray, labels: np.ndarray, default: str, classes: list[str], seed: int = 0, most: int = 40) -> list[dict]:
    """An ordered rule list by incremental reduced-error pruning.

    For each class in turn, rules are grown on two thirds of the rows not yet covered and pruned
    on the rest; a class ends when a pruned rule is right in less than three quarters of what it
    covers in the pruning part, ten splits in a row. `classes` gives the order; `default` is
    what no rule covers.
    """
    rng = np.random.default_rng(seed)
    left = np.ones(len(x), bool)
    out: list[dict] = []
    for c in classes:
        failed = 0
        while failed < 10 and len(out) < most * len(classes):
            idx = np.flatnonzero(left)
            y = labels[idx] == c
            if y.sum() < 3:
                break
            part = rng.random(len(idx)) < 2 / 3
            g, p = idx[part], idx[~part]
            if not (labels[g] == c).any():
                failed += 1
                continue
            at = np.linspace(0, 1, 49)
            cuts = []
            for f in range(x.shape[1]):
                vs = np.unique(x[g, f])
                qs = np.unique(np.concatenate([np.quantile(x[g, f], at), np.quantile(x[g][labels[g] == c, f], at)]))
                k = np.clip(np.searchsorted(vs, qs, side="right"), 1, len(vs) - 1) if len(vs) > 1 else []
                cuts.append(np.unique((vs[k] + vs[np.subtract(k, 1)]) / 2) if len(vs) > 1 else vs)
            rule = _grow(x[g], labels[g] == c, cuts)
            rule, worth = _prune(x[p], labels[p] == c, rule)
            if not rule or worth < 0.5:
                failed += 1
                continue
            failed = 0
            hit = left & _covers(x, rule)
            out.append({"class": str(c), "tests": [[FEATURES[f], op, round(v, 5)] for f, op, v in tidy(rule)], "covered": int(hit.sum()), "right": int((labels[hit] == c).sum())})
            left &= ~hit
    return [*out, {"class": default, "tests": []}]


def rules_sql(rules: list[dict]) -> str:
    """A rule list as one SQL CASE over the statistics."""
    known = set(FEATURES)
    when = []
    for r in rules:
        if r["tests"]:
            assert all(f in known and op in ("<=", ">") for f, op, _ in r["tests"])
            when.append(f"when {' and '.join(f'{f} {op} {v}D' for f, op, v in r['tests'])} then '{r['class']}'")
    default = next(r["class"] for r in rules if not r["tests"])
    return f"case {' '.join(when)} else '{default}' end"


def prose_sql() -> str:
    """Whether the stored rules call a text prose."""
    return f"({rules_sql(load_model('quality_rules.json')['rules'])}) = 'prose'"


def kind_sql() -> str:
    """Of what isn't prose, its kind by the stored rules."""
    return rules_sql(load_model("quality_rules.json")["kinds"])


def assess(df: DataFrame, text: str = "text") -> DataFrame:
    """Statistics and verdict of each row's text."""
    return _judged(df, text).withColumn("verdict", F.expr(f"case when _prose then 'prose' when not _prose then {kind_sql()} end")).drop("_prose")


def _judged(df: DataFrame, text: str) -> DataFrame:
    """Statistics and `_prose`, null for a null text.

    It passes through a generator: a plain filter on it would be pushed below the projections and have every
    statistic evaluated once for each test that names it.
    """
    blank = rf"trim(regexp_replace(`{text}`, '(?U)\\s+', '')) = ''"
    prose = F.expr(f"case when `{text}` is null then null when {blank} then true else {prose_sql()} end")
    return with_statistics(df, text).withColumn("_prose", F.explode(F.array(prose)))


def flagged(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text isn't prose; only the statistics that tell so are computed."""
    return _judged(df, text).where("not _prose").select(*df.columns)


def prose(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text is prose."""
    return _judged(df, text).where("_prose").select(*df.columns)
