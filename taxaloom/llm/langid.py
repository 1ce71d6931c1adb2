"""Language of each document and of each segment, by a byte convolutional network.

The network is numpy only: bytes are embedded, filters of several widths run over them, each
filter's maximum over the window is kept, and a softmax layer gives the languages, or that a window is in none
(tables, menus, codes). It was trained by `train_langid.py` on the labelled texts; its weights are models/langid.npz. For prediction the
embedding and each filter column are multiplied once to tables of 256 rows, so that a window
costs look-ups and additions alone.

A text is cut into sentences; quoted words, brackets, reference marks and scientific names are
taken out; each sentence fills one or more fixed-length windows (long ones all of theirs, with an
overlap), whose scores are averaged. Batches of windows of all texts of an Arrow batch are scored
together. A segment's confidence is its softmax probability; a text's language is the one with the
greatest confidence-weighted length, its confidence that share.

Defined results: null, empty and letterless texts give no segments and no language; segments are
judged from two words on (or two letters of a script without blanks); what is in no language has a
null one; labels other than the known languages count as none.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.common import model_bytes

LANGS = ("en", "de", "fr", "es", "pt", "it", "nl", "sv", "pl", "ru", "ja")
WINDOW = 160
STRIDE = 120
WIDTHS = (2, 3, 4, 5)
#: Confidence that a segment needs to count, with LONG letters or more and (the sum, falling evenly) with none.
LEAST, MORE, LONG = 0.75, 0.24, 30
#: Windows scored at once; bounds a worker's memory to some 40 MB.
CHUNK = 512

#: Quoted words: pairs of quotes with a short stretch between them.
_QUOTED = re.compile(r"“[^“”]{1,90}”|«[^«»]{1,90}»|„[^“”]{1,90}[“”]|\"[^\"\n]{1,90}\"|「[^「」]{1,40}」|『[^『』]{1,40}』")
_ASIDE = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|<[^<>]*>|https?://\S+")
_BREAK = re.compile(r"(?<=[.!?…])[\"”»’)\]]*\s+|(?<=[。！？])|\n\s*\n|\n(?=\s*(?:[-*•·–]|\(?\d{1,3}[.)])\s)")
_WORDS, _DIGITS, _CJK = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"[぀-ヿ一-鿿]")
_NAME = re.compile(r"\b[A-Z][a-z]{3,} [a-z]{4,}(?:us|is|ys|um|ensis|ops|eps|ons|tus|ula|uda|ris|ens|ipes|ollis|otus|orsum|enter)\b")


def segments(text: str | None) -> list[tuple[int, int, str, int]]:
    """(start, end, words to judge, their letters) of each sentence of a text, in order."""
    if not text:
        return []
    out = []
    text = _QUOTED.sub(lambda m: " " * len(m.group()), text)
    cuts = [m for m in _BREAK.finditer(text)]
    for start, end in zip([0, *(m.end() for m in cuts)], [*(m.start() for m in cuts), len(text)]):
        body = text[start:end]
        clean = _NAME.sub(" ", _ASIDE.sub(" ", body))
        clean = _DIGITS.sub("0", " ".join(clean.split())).lower()
        words = _WORDS.findall(clean)
        if len(words) > 1 or words and len(words[0]) > 1 and _CJK.search(words[0]):
            out.append((start, end, clean, sum(map(len, words))))
    return out


def windows(clean: str) -> list[bytes]:
    """All fixed-length windows of a cleaned sentence, in bytes, with a blank at both ends."""
    b = b" " + clean.encode("utf-8", "ignore") + b" "
    return [b[i : i + WINDOW] for i in range(0, max(1, len(b) - WINDOW + STRIDE), STRIDE)]


def to_matrix(ws: list[bytes]) -> np.ndarray:
    m = np.zeros((len(ws), WINDOW), np.uint8)
    for i, w in enumerate(ws):
        m[i, : len(w)] = np.frombuffer(w, np.uint8)
    return m


class Net:
    """The network for prediction: look-up tables by filter width and column, and the last layer."""

    def __init__(self, weights: dict[str, np.ndarray]):
        emb = weights["emb"].astype(np.float32)
        self.tables = {w: [emb @ weights[f"w{w}"][k].astype(np.float32) for k in range(w)] for w in WIDTHS}
        self.bias = {w: weights[f"b{w}"].astype(np.float32) for w in WIDTHS}
        self.v, self.c = weights["v"].astype(np.float32), weights["c"].astype(np.float32)

    def scores(self, m: np.ndarray) -> np.ndarray:
        out = np.empty((len(m), len(self.c)), np.float32)
        order = np.argsort((m != 0).sum(1), kind="stable")
        for i in range(0, len(m), CHUNK):
            rows = order[i : i + CHUNK]
            x = m[rows]
            x = x[:, : max(8, int((x != 0).sum(1).max()) + 1)]
            h = []
            for w in WIDTHS:
                n = x.shape[1] - w + 1
                a = self.tables[w][0][x[:, :n]]
                for k in range(1, w):
                    a += self.tables[w][k][x[:, k : k + n]]
                h.append(a.max(1) + self.bias[w])
            out[rows] = np.maximum(np.concatenate(h, 1), 0) @ self.v + self.c
        return out


@cache
def net() -> Net:
    with np.load(io.BytesIO(model_bytes("langid.npz"))) as f:
        return Net(dict(f))


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def judge(texts: list[str | None]) -> list[list[tuple[int, int, str | None, float, int]]]:
    """(start, end, language, confidence, letters) of the segments of each text."""
    segs = [segments(t) for t in texts]
    ws, owner = [], []
    for i, s in enumerate(segs):
        for j, (_, _, clean, _) in enumerate(s):
            for w in windows(clean):
                ws.append(w)
                owner.append((i, j))
    out: list[list[tuple[int, int, str | None, float, int]]] = [[] for _ in texts]
    if not ws:
        return out
    distinct = sorted(set(ws))
    place = {w: k for k, w in enumerate(distinct)}
    s = net().scores(to_matrix(distinct))[[place[w] for w in ws]]
    first = [k for k in range(len(owner)) if k == 0 or owner[k] != owner[k - 1]]
    mean = np.add.reduceat(s, first, axis=0) / np.diff([*first, len(owner)])[:, None]
    p = softmax(mean)
    best = p.argmax(1)
    for k, row in zip(first, range(len(first))):
        i, j = owner[k]
        a, b, _, letters = segs[i][j]
        out[i].append((a, b, LANGS[best[row]] if best[row] < len(LANGS) else None, float(p[row, best[row]]), letters))
    return out


_SCHEMA = "start:bigint,end:bigint,lang:string,confidence:double,letters:bigint"


def with_segments(df: DataFrame, text: str = "text", to: str = "segments") -> DataFrame:
    """Add the judged segments of each text as an array column."""

    @F.pandas_udf(f"array<struct<{_SCHEMA}>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            got = judge(b.tolist())
            yield pd.Series([[{"start": a, "end": e, "lang": lang, "confidence": round(c, 4), "letters": n} for a, e, lang, c, n in s] for s in got])

    return df.withColumn(to, run(F.col(text)))


def document_languages(df: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, lang, confidence): the language of each text, null where nothing can be judged."""
    d = with_segments(df.select(*key, text), text).withColumn("segments", F.filter("segments", lambda s: s["lang"].isNotNull()))
    by = F.expr(
        """transform(array_distinct(transform(segments, s -> s.lang)), l -> struct(
            aggregate(filter(segments, s -> s.lang = l), 0D, (a, s) -> a + s.confidence * (s.end - s.start)) as weight, l as lang))"""
    )
    d = d.withColumn("_by", by).withColumn("_top", F.array_max("_by"))
    total = F.expr("aggregate(segments, 0D, (a, s) -> a + (s.end - s.start))")
    return d.select(*key, F.col("_top.lang").alias("lang"), F.round(F.col("_top.weight") / total, 4).alias("confidence"))


def label_language(locale: str) -> str:
    """SQL: the language a locale label stands for, null for none."""
    known = ", ".join(f"'{x}'" for x in LANGS)
    base = f"lower(split({locale}, '[-_]')[0])"
    return f"case when {base} in ({known}) then {base} end"


def other_languages(df: DataFrame, key: list[str], locale: str = "locale", text: str = "text", least: float = LEAST, more: float = MORE) -> DataFrame:
    """(key, lang): languages other than the label's in which the text or a whole sentence is written.

    A segment counts from a confidence of `least` on (shorter ones need up to `more` above that),
    if it is a closed sentence or the greater part of its text.
    """
    d = with_segments(df.select(*key, *[c for c in (locale, text) if c not in key]), text)
    whole = rf"""filter(segments, s -> s.lang is not null and s.confidence >= {least} + {more} * greatest(0, 1 - s.letters / {LONG}) and (2 * (s.end - s.start) >= length(`{text}`)
        or rtrim(substring(`{text}`, cast(s.start + 1 as int), cast(s.end - s.start as int))) rlike '[.!?。！？][\"”»’)\\]\\d\\[]*$'))"""
    d = d.select(*key, *[c for c in (locale, text) if c not in key], F.explode(F.expr(f"array_distinct(transform({whole}, s -> s.lang))")).alias("lang"))
    own = label_language(f"`{locale}`")
    d = d.where(f"({own}) is null or lang <> ({own})")
    return d.select(*key, "lang")
