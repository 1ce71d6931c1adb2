"""Reading level of each document: a linear pairwise ranker with isotonic calibration.

The ranker learns from pairs of graded documents which of the two is harder (logistic loss on the
difference of their features), over syntax features (lengths of words and sentences, clauses,
commas, digits, abbreviations) and hashed vocabulary. As a level belongs to the greater part of a text,
the ranker scores each sentence, and a document's score is the median over its words. Training follows that:
a first fit on whole documents finds the sentences about each document's median, and the second is
fitted on these. Scores are calibrated to levels by isotonic regression on graded documents that the ranker
has not seen: each of FOLDS parts is scored by a ranker fitted on the others, and every ranker's scores
are brought to one scale by the mean and deviation of what it was fitted on.

The graded sample is bounded by MOST_GRADED documents, taken in the order of a hash of their id;
the model is fitted on the driver (a few MB) and sent to the workers in the function's closure.
All documents are scored, whole.

Defined results: a null text has a null score and level; a text without words has level 1, the
least; with no graded documents that have words, or only one level, every text gets that level (or null).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.common import spread

#: Bound of the graded sample that is collected and fitted.
MOST_GRADED = 3000
#: Pairs drawn from it for training.
PAIRS = 12_000
#: Parts of the graded sample for calibration.
FOLDS = 3
BUCKETS = 4096
SYNTAX = 12

_SENTENCE = re.compile(r"(?<=[.!?…])[\"”»’)\]]*\s+(?=[\"“«„¿¡(\[]*[A-ZÀ-ÞÄÖÜ0-9])|\n\s*\n")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|\d+(?:[.,]\d+)*")
#: Words that open a clause (en, de, fr, es).
CLAUSE_WORDS = frozenset("because although whereas which while since if that when obwohl während weil dass die der wenn bien que qui tandis puisque aunque mientras porque cuando lo".split())
_SHORT = re.compile(r"\b\w{1,5}\.(?=\s*[a-z(,;])")
_CAPITALS = re.compile(r"\b[A-Z]{1,4}[a-z]?\b")


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s and s.strip()]


def words(sentence: str) -> list[str]:
    """Words of a sentence: numbers as 0, names (capitalised inside a sentence and rare in form) as they are."""
    return ["0" if w[0].isdigit() else w.lower() for w in _WORD.findall(sentence)]


def syntax(sentence: str, ws: list[str]) -> list[float]:
    """Scale-free syntax features of one sentence."""
    n = max(1, len(ws))
    sizes = list(map(len, ws))
    return [
        min(n, 60) / 30,
        sum(sizes) / n / 6,
        sum([s >= 7 for s in sizes]) / n,
        sum([s >= 11 for s in sizes]) / n,
        sum([s <= 3 for s in sizes]) / n,
        min(6, sentence.count(",") + sentence.count(";")) / 3,
        ws.count("0") / n,
        min(4, sum([w in CLAUSE_WORDS for w in ws])) / 2,
        min(3, sentence.count("(") + sentence.count(":")) / 2,
        min(4, len(_SHORT.findall(sentence))) / 2,
        min(4, len(_CAPITALS.findall(sentence))) / 2,
        1.0 if sentence.rstrip().endswith("?") else 0.0,
    ]


def _bucket(w: str) -> int:
    return zlib.crc32(w.encode()) % BUCKETS


def parsed(text: str) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(syntax features, buckets of the words, number of words) of each sentence that has words."""
    out = []
    for s in sentences(text):
        ws = words(s)
        if ws:
            out.append((np.array(syntax(s, ws), np.float32), np.array([_bucket(w) for w in ws]), len(ws)))
    return out


def features(parts: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Mean of the features of sentences, weighted by words."""
    x = np.zeros(SYNTAX + BUCKETS, np.float32)
    for syn, buckets, n in parts:
        x[:SYNTAX] += syn * n
        np.add.at(x, SYNTAX + buckets, 1)
    return x / max(1, sum(n for _, _, n in parts))


def middle(parts: list, w: np.ndarray) -> list:
    """The sentences about the median: those that hold the middle half of the words in the order of their scores."""
    order = sorted(parts, key=lambda p: p[0] @ w[:SYNTAX] + w[SYNTAX:][p[1]].mean())
    total, run, out = sum(n for _, _, n in parts), 0, []
    for p in order:
        if run < 0.75 * total and run + p[2] > 0.25 * total:
            out.append(p)
        run += p[2]
    return out


def fit_ranker(x: np.ndarray, levels: np.ndarray, seed: int = 0, epochs: int = 12, start: np.ndarray | None = None) -> np.ndarray:
    """Weights of the pairwise ranker, by Adam on the logistic loss of level-ordered pairs, from `start` on."""
    rng = np.random.default_rng(seed)
    # Features that no document has keep their weight of 0 and needn't be carried along.
    used = np.flatnonzero(x.any(0))
    scale = np.where(used < SYNTAX, 1.0, 12.0).astype(np.float32)
    z = x[:, used] * scale
    out = np.zeros(x.shape[1], np.float32)
    by = {int(v): np.flatnonzero(levels == v) for v in np.unique(levels)}
    kinds = [(a, b) for a in by for b in by if a > b]
    if not kinds:
        return out
    each = max(1, PAIRS // len(kinds))
    hard = np.concatenate([rng.choice(by[a], each) for a, b in kinds])
    easy = np.concatenate([rng.choice(by[b], each) for a, b in kinds])
    gap = np.concatenate([np.full(each, a - b, np.float32) for a, b in kinds])
    w = np.zeros(len(used), np.float32) if start is None else (start[used] / scale).astype(np.float32)
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    for _ in range(epochs):
        order = rng.permutation(len(hard))
        for i in range(0, len(order), 256):
            k = order[i : i + 256]
            d = z[hard[k]] - z[easy[k]]
            g = -d.T @ (gap[k] / (1 + np.exp(np.clip(d @ w - (gap[k] - 1), -30, 30)))) / len(k) + 2e-4 * w
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    out[used] = w * scale
    return out


def isotonic(score: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (bounds, levels), where levels[i] holds up to bounds[i], the last one beyond.

    A bound lies midway between the scores on either side of a step.
    """
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, y in zip(score[order], level[order].astype(float)):
        blocks.append([s, s, y, 1.0])
        while len(blocks) > 1 and blocks[-2][2] >= blocks[-1][2]:
            _, hi, y2, n2 = blocks.pop()
            lo, _, y1, n1 = blocks.pop()
            blocks.append([lo, hi, (y1 * n1 + y2 * n2) / (n1 + n2), n1 + n2])
    return np.array([(a[1] + b[0]) / 2 for a, b in zip(blocks, blocks[1:])]), np.array([b[2] for b in blocks])


def _median(scored: list[tuple[float, int]]) -> float:
    """Median over words of (score, words) of sentences; -inf for none."""
    if not scored:
        return float("-inf")
    scored.sort()
    half, run = sum(n for _, n in scored) / 2, 0
    for s, n in scored:
        run += n
        if run >= half:
            return s
    return scored[-1][0]


def median(parts: list, w: np.ndarray) -> float:
    return _median([(float(syn @ w[:SYNTAX] + w[SYNTAX:][buckets].mean()), n) for syn, buckets, n in parts])


class Model:
    def __init__(self, w: np.ndarray, at: np.ndarray, fitted: np.ndarray):
        self.w, self.at, self.fitted = w, at, fitted
        self._known: dict[str, float] = {}

    def __getstate__(self):
        return {"w": self.w, "at": self.at, "fitted": self.fitted, "_known": {}}

    def score(self, text: str) -> float:
        """Median over the words of the sentence scores."""
        known, vocabulary, weights = self._known, self.w[SYNTAX:], self.w[:SYNTAX].tolist()
        if len(known) > 200_000:
            known.clear()
        got = []
        for s in sentences(text):
            ws = words(s)
            if not ws:
                continue
            total = 0.0
            for x in ws:
                y = known.get(x)
                if y is None:
                    y = known[x] = float(vocabulary[_bucket(x)])
                total += y
            got.append((total / len(ws) + sum(map(mul, weights, syntax(s, ws))), len(ws)))
        return _median(got)

    def expected(self, score: float) -> float:
        return float(self.fitted[np.searchsorted(self.at, score)])


def _ranker(docs: list[list], y: np.ndarray, seed: int, epochs: tuple[int, int] = (5, 7)) -> np.ndarray:
    """Weights fitted on whole documents, then on the sentences about their medians, with scores of mean 0 and deviation 1."""
    w = fit_ranker(np.stack([features(d) for d in docs]), y, seed, epochs[0])
    x = np.stack([features(middle(d, w)) for d in docs])
    w = fit_ranker(x, y, seed, epochs[1], w)
    score = x @ w
    # A shift of all scores goes to the words, whose mean every sentence has.
    w = w / max(1e-9, float(score.std()))
    w[SYNTAX:] -= float((x @ w).mean())
    return w


def fit(texts: list[str], levels: list[int], seed: int = 0) -> Model | None:
    """Ranker and calibration on the graded texts; None without any."""
    given = [(d, y) for d, y in ((parsed(t), y) for t, y in zip(texts, levels)) if d]
    if not given:
        return None
    docs, y = [d for d, _ in given], np.array([v for _, v in given])
    score = np.full(len(docs), np.nan)
    part = np.arange(len(docs)) % FOLDS
    if len(docs) >= 10 * FOLDS:
        for k in range(FOLDS):
            w = _ranker([d for d, p in zip(docs, part) if p != k], y[part != k], seed, (3, 3))
            for i in np.flatnonzero(part == k):
                score[i] = median(docs[i], w)
    w = _ranker(docs, y, seed)
    if np.isnan(score).any():
        score = np.array([median(d, w) for d in docs])
    return Model(w, *isotonic(score, y))


def fit_on(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", level: str = "reading_level") -> Model | None:
    graded = labels.where(F.col(level).isNotNull()).orderBy(F.xxhash64(key), key).limit(MOST_GRADED)
    rows = documents.select(key, text).join(F.broadcast(graded.select(key, level)), key).where(f"trim({text}) <> ''").select(text, level).collect()
    rows.sort(key=lambda r: (r[1], r[0]))
    return fit([r[0] for r in rows], [int(r[1]) for r in rows])


def with_level(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add `reading_score` and `reading_level`."""
    if model is None:
        return df.withColumns({"reading_score": F.lit(None).cast("double"), "reading_level": F.lit(None).cast("bigint")})

    @F.pandas_udf("struct<score:double,level:bigint>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = [None if t is None else model.score(t) for t in b]
            level = [None if x is None else int(np.floor(model.expected(x) + 0.5)) for x in s]
            yield pd.DataFrame({"score": [None if x is None or np.isinf(x) else round(x, 6) for x in s], "level": pd.array(level, "Int64")})

    d = spread(df).withColumn("_r", run(F.col(text)))
    return d.withColumns({"reading_score": F.col("_r.score"), "reading_level": F.col("_r.level")}).drop("_r")
