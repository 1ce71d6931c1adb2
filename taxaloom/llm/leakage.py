"""Held-out test passages inside a corpus, by a generalised suffix automaton over words.

The test items are normalised (case, punctuation, layout, look-alike characters) to word ids and
put into suffix automata of at most MOST_ITEM_WORDS words each, built on the driver and broadcast;
a fixed item table needs one, and a larger one is searched in turns. Corpus tokens stream through
them, tracking the longest matching length; at each end the suffix links lead to the items that
share a shorter run. Of an item with a run of ANCHOR words all further matches nearby are
gathered, and matches of one item in one order, apart by a changed word here and there, are joined.
A joined run counts from LEAST_WORDS words on (`least`), or when it covers nearly all of a shorter
item. An instruction line is left out of the items: it is an opening sentence that several items
share and go on from differently.

`find_leaks` gives every item and document, `without_leaks` the corpus without the spans that pass a
limit of length or of coverage of the item.

Defined results: null and empty texts and items match nothing; items with equal text each report;
every occurrence in a document is tracked, a pair is reported once with its longest run, its place and
coverage; texts are processed whole; repeated rows and other columns stay.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.canonical import LOOKALIKES
from taxaloom.llm.common import checkpoint, spread

LEAST_WORDS = 12
#: Words between two matches of a run that may differ, on either side.
MOST_CHANGED = 2
#: Share of a run's words that must match.
LEAST_SHARE = 0.75
#: A seed is a maximal match of at least so many words.
SEED = 3
#: From so many words on, a match counts for every item that has it, also where another item matches longer.
ANCHOR = 7
#: Bound on the words of one automaton, which has at most twice as many states; more items are searched in turns.
MOST_ITEM_WORDS = 1_000_000

_TABLE = {ord(k): v for k, v in LOOKALIKES.items()}
_DROP = re.compile(r"[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯︀-️﻿]")
_WORD = re.compile(r"[^\W_]+")
#: Hyphens and line ends inside a word.
_SPLIT_LINE = re.compile(r"(?<=[^\W\d_])[-‐‑]\s*\n\s*(?=[^\W\d_])")
_SPLIT_BLANK = re.compile(r"(?<=[^\W\d_])[-‐‑] (?=[a-zà-ÿ])")
_SENTENCE = re.compile(r"(?<=[.!?:])\s+")


def _letters(t: str) -> str:
    """Look-alikes to one letter, without accents, case and apostrophes; each character by itself."""
    t = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", t).translate(_TABLE).casefold())
    return "".join(c for c in t if c not in "'’" and not unicodedata.combining(c))


def tokens(text: str | None) -> list[str]:
    """Normalised words: look-alikes to one letter, accents and case dropped, split words rejoined."""
    if not text:
        return []
    t = _SPLIT_BLANK.sub("", _SPLIT_LINE.sub("", _DROP.sub("", text)))
    return _WORD.findall(t.lower().replace("'", "") if t.isascii() else _letters(t))


class Automaton:
    """A generalised suffix automaton: transitions, suffix links, lengths and end positions."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.sequences, tips = sequences, []
        for i, seq in enumerate(sequences):
            last = 0
            for j, c in enumerate(seq):
                last = self._extend(last, c)
                self.ends[last].append((i, j))
            tips.append(last)
        order = sorted(range(len(self.len)), key=self.len.__getitem__, reverse=True)
        self.children: list[list[int]] = [[] for _ in self.len]
        for s in order:
            if self.link[s] >= 0:
                self.children[self.link[s]].append(s)
        #: Whether a sequence ends with the words of a state.
        self.closes = [False] * len(self.len)
        for s in tips:
            while s > 0 and not self.closes[s]:
                self.closes[s] = True
                s = self.link[s]

    def _new(self, length: int, link: int, nxt: dict[int, int]) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.len.append(length)
        self.ends.append([])
        return len(self.len) - 1

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            if self.len[q] == self.len[last] + 1:
                return q
            return self._split(last, c, q)
        cur = self._new(self.len[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._new(self.len[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def occurrences(self, state: int, but: int = -1) -> list[tuple[int, int]]:
        """(sequence, end) of all places where the words of a state stand, without those of its child `but`."""
        out, todo = [], [state]
        while todo:
            s = todo.pop()
            out += self.ends[s]
            todo += [x for x in self.children[s] if x != but]
        return out

    def matches(self, seq: list[int], least: int) -> list[tuple[int, int, int]]:
        """(end, length, state) of every match of `least` words or more that can't be extended to the right."""
        out, s, n = [], 0, 0
        for j, c in enumerate(seq):
            if c not in self.next[s]:
                if n >= least:
                    out.append((j - 1, n, s))
                while s and c not in self.next[s]:
                    s = self.link[s]
                    n = self.len[s]
            if c in self.next[s]:
                s, n = self.next[s][c], n + 1
        if n >= least:
            out.append((len(seq) - 1, n, s))
        return out


    def placed(self, seq: list[int], least: int, least_top: int | None = None) -> Iterator[tuple[int, int, int, int]]:
        """(sequence, its start, start in seq, length) of every match of `least` words or more that neither side extends.

        Where no sequence matches longer at an end, `least_top` words are enough.
        """
        least_top = least if least_top is None else least_top
        s, n = 0, 0
        for j, c in enumerate([*seq, None]):
            at, k, below = s, n, -1
            while at > 0 and (k >= least or k >= least_top and below < 0 and c not in self.next[at]):
                if c not in self.next[at] or len(self.next[at]) > 1 or self.closes[at]:
                    for i, end in self.occurrences(at, below):
                        own = self.sequences[i]
                        if end + 1 == len(own) or own[end + 1] != c:
                            yield i, end - k + 1, j - k, k
                below, at = at, self.link[at]
                k = self.len[at]
            while s and c not in self.next[s]:
                s = self.link[s]
                n = self.len[s]
            if c in self.next[s]:
                s, n = self.next[s][c], n + 1


def located(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The words of `tokens` and where each stands in the text, as (start, end)."""
    at = list(range(len(text)))
    for gap in (_DROP, _SPLIT_LINE, _SPLIT_BLANK):
        now = "".join(text[i] for i in at)
        gone = {i for m in gap.finditer(now) for i in range(m.start(), m.end())}
        at = [o for i, o in enumerate(at) if i not in gone]
    out, origin = [], []
    for i in at:
        for c in _letters(text[i]):
            out.append(c)
            origin.append(i)
    marks = [(m.group(), m.start(), m.end() - 1) for m in _WORD.finditer("".join(out))]
    return [w for w, _, _ in marks], [(origin[a], origin[b] + 1) for _, a, b in marks]


def opening(text: str | None) -> tuple[str, str]:
    """(normalised first sentence, normalised rest); the first is '' where the text is one sentence."""
    s = _SENTENCE.split((text or "").strip(), maxsplit=1)
    return (" ".join(tokens(s[0])), " ".join(tokens(s[1]))) if len(s) == 2 else ("", " ".join(tokens(s[0])))


def _next(rest: str) -> str:
    return " ".join(rest.split(" ", 3)[:3])


def without_instructions(items: list[tuple[int, str | None]]) -> list[tuple[int, list[str]]]:
    """Normalised words of each item without an opening sentence from which items go on differently."""
    split = [(i, *opening(t)) for i, t in items]
    follows: dict[str, set[str]] = {}
    for _, head, rest in split:
        follows.setdefault(head, set()).add(_next(rest))
    return [(i, (rest if not head or len(follows[head]) > 1 else f"{head} {rest}").split()) for i, head, rest in split]


class Index:
    """The automaton with its vocabulary and items (their normalised words), as broadcast."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.vocabulary: dict[str, int] = {}
        seqs = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws] for _, ws in items]
        self.ids = [i for i, _ in items]
        self.sizes = [len(s) for s in seqs]
        self.automaton = Automaton(seqs)
        self._grams: dict[int, dict[tuple, list[int]]] = {}

    def __getstate__(self):
        return {**self.__dict__, "_grams": {}}

    def _nearby(self, item: int, seq: list[int], lo: int, hi: int) -> list[tuple[int, int, int]]:
        """(start in seq, start in item, length) of all matches of SEED words or more within seq[lo:hi]."""
        own = self.automaton.sequences[item]
        if item not in self._grams:
            if len(self._grams) > 5000:
                self._grams.clear()
            grams: dict[tuple, list[int]] = {}
            for a in range(len(own) - SEED + 1):
                grams.setdefault(tuple(own[a : a + SEED]), []).append(a)
            self._grams[item] = grams
        out = []
        for d in range(lo, hi - SEED + 1):
            for a in self._grams[item].get(tuple(seq[d : d + SEED]), ()):
                if a == 0 or d == lo or own[a - 1] != seq[d - 1]:
                    k = SEED
                    while a + k < len(own) and d + k < hi and own[a + k] == seq[d + k]:
                        k += 1
                    out.append((d, a, k))
        return out

    def search(self, text: str | None, least: int = LEAST_WORDS) -> list[tuple[int, int, int, float, list[tuple[int, int, int]], int]]:
        """(item id, words, span, coverage, runs, unbroken) of every item that leaked into the text.

        words and span are the longest run's matching words and its length in the text; runs are the
        (first word, word after the last, matching words) of all runs, the longest first; unbroken is the
        longest match without a changed word.
        """
        seq = [self.vocabulary.get(w, -1) for w in tokens(text)]
        seeds: dict[int, list[tuple[int, int, int]]] = {}
        for item, a, d, k in self.automaton.placed(seq, ANCHOR, SEED):
            seeds.setdefault(item, []).append((d, a, k))
        out = []
        for item, matches in seeds.items():
            size = self.sizes[item]
            if max(k for _, _, k in matches) >= ANCHOR:
                reach = size + size // 2 + least
                lo, hi = min(d for d, _, _ in matches) - reach, max(d + k for d, _, k in matches) + reach
                matches = self._nearby(item, seq, max(0, lo), min(len(seq), hi))
            if sum(k for _, _, k in matches) >= (size if size < least else LEAST_SHARE * least):
                runs = self._join(matches, least, size)
                if runs:
                    first, last, words = runs[0]
                    out.append((self.ids[item], words, last - first, round(words / size, 4), runs, max(k for _, _, k in matches)))
        return out

    def _join(self, matches: list[tuple[int, int, int]], least: int, size: int) -> list[tuple[int, int, int]]:
        """(first, after last, words) of chains of matches in the same order on both sides with few changed words between, longest first."""
        matches = sorted(set(matches))
        best: list[tuple[int, int, int]] = []
        runs, longest = [], 0
        for i, (d, a, k) in enumerate(matches):
            words, first, whole = k, d, k
            longest = max(longest, k)
            for j in range(i - 1, -1, -1):
                d0, a0, k0 = matches[j]
                if d - d0 > MOST_CHANGED + longest:
                    break
                gd, ga = d - (d0 + k0), a - (a0 + k0)
                if gd > MOST_CHANGED + k0:
                    continue
                over = max(0, -gd, -ga)
                if over >= k or max(gd, ga) > MOST_CHANGED or abs(gd - ga) > 1:
                    continue
                both = best[j][0] + k - over
                if both >= LEAST_SHARE * (d + k - best[j][1]) and both > words:
                    words, first, whole = both, best[j][1], max(best[j][2], k)
            best.append((words, first, whole))
            span = d + k - first
            # A run with changed words counts by its length in the text where a good part of it is unchanged.
            if words >= least or span >= least and whole >= ANCHOR or size < least and words >= 0.9 * size and size >= 5:
                runs.append((first, d + k, words))
        return sorted(runs, key=lambda r: (-r[2], r[0]))


def _indexes(items: DataFrame, item_key: str, item_text: str) -> list:
    """Broadcast automata over all items, each within the bound (or of one item alone)."""

    @F.pandas_udf("struct<head:string,rest:string>")
    def split(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([opening(t) for t in s], columns=["head", "rest"])

    d = items.select(F.col(item_key).alias("_i"), split(F.col(item_text)).alias("_s")).select("_i", "_s.*")
    follows = d.where("head <> ''").groupBy("head").agg(F.min(F.substring_index("rest", " ", 3)).alias("_a"), F.max(F.substring_index("rest", " ", 3)).alias("_b"))
    shared = follows.where("_a <> _b").select("head", F.lit(True).alias("_shared"))
    d = d.join(shared, "head", "left").select("_i", F.when(F.col("_shared") | (F.col("head") == ""), F.col("rest")).otherwise(F.concat_ws(" ", "head", "rest")).alias("_w"))
    d = checkpoint(d.where("_w <> ''").withColumn("_n", F.size(F.split("_w", " "))))
    blocks = 1
    while True:
        of = F.pmod(F.xxhash64("_i"), F.lit(blocks))
        over = d.groupBy(of.alias("b")).agg(F.sum("_n").alias("n"), F.count_distinct("_i").alias("k")).where((F.col("n") > MOST_ITEM_WORDS) & (F.col("k") > 1))
        if over.isEmpty():
            break
        blocks *= 2
    sc = items.sparkSession.sparkContext
    out = []
    for b in range(blocks):
        rows = sorted((r._i, r._w) for r in d.where(of == b).select("_i", "_w").collect())
        if rows or not b:
            out.append(sc.broadcast(Index([(i, w.split(" ")) for i, w in rows])))
    return out


def _searcher(index, kind: str, least: int):
    @F.pandas_udf(f"array<struct<item:{kind},words:bigint,span:bigint,coverage:double,start:bigint,end:bigint,unbroken:bigint>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            out = []
            for t in b:
                got = index.value.search(t, least)
                at = located(t)[1] if got else []
                out.append([{"item": i, "words": n, "span": s, "coverage": c, "start": at[r[0][0]][0], "end": at[r[0][1] - 1][1], "unbroken": u} for i, n, s, c, r, u in got])
            yield pd.Series(out)

    return run


def _spanner(index, longest: int, coverage: float):
    @F.pandas_udf("array<struct<first:bigint,last:bigint>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            mine, out = index.value, []
            size = dict(zip(mine.ids, mine.sizes))
            for t in b:
                got = mine.search(t, min(longest, LEAST_WORDS))
                out.append([{"first": a, "last": z} for i, _, _, _, runs, _ in got for a, z, n in runs if n >= longest or n >= coverage * size[i]])
            yield pd.Series(out)

    return run


def find_leaks(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """(item, doc, words, span, coverage, start, end, unbroken): every document that holds a passage of an item.

    start and end are the places of the longest run in the text, in characters from 0; unbroken is the longest match
    of the pair without a changed word.
    """
    kind = items.schema[item_key].dataType.simpleString()
    d = spread(documents.select(key, text).where(F.col(text).isNotNull()))
    found = [_searcher(index, kind, least)(F.col(text)) for index in _indexes(items, item_key, item_text)]
    leaks = F.explode(F.concat(*found) if len(found) > 1 else found[0])
    return d.select(key, leaks.alias("_l")).select(F.col("_l.item").alias(item_key), key, "_l.words", "_l.span", "_l.coverage", "_l.start", "_l.end", "_l.unbroken")


def without_leaks(documents: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", longest: int = LEAST_WORDS, coverage: float = 0.5) -> DataFrame:
    """All documents, their text without leaked spans, and `removed_words`.

    A span goes if its run matches at least `longest` words of an item, or at least the share
    `coverage` of one. What stands around a span is joined by a blank. A null text stays null.
    """
    d = spread(documents)
    spans = [_spanner(index, longest, coverage)(F.col(text)) for index in _indexes(items, item_key, item_text)]

    @F.pandas_udf("struct<text:string,removed:bigint>")
    def cut(texts: pd.Series, all_spans: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([removed(t, [(s["first"], s["last"]) for s in x] if x is not None else []) for t, x in zip(texts, all_spans)], columns=["text", "removed"])

    c = d.withColumn("_cut", cut(F.col(text), F.concat(*spans) if len(spans) > 1 else spans[0]))
    return c.withColumns({text: F.col("_cut.text"), "removed_words": F.col("_cut.removed")}).drop("_cut")


def removed(text: str | None, spans: list[tuple[int, int]]) -> tuple[str | None, int]:
    """(text without the words of the spans, number of words that went)."""
    if not text or not spans:
        return text, 0
    at = located(text)[1]
    parts, done, gone = [], 0, 0
    last = 0
    for a, z in sorted(spans):
        a = max(a, last)
        if a < z:
            start = at[a][0] if a > last or not gone else done
            parts.append(text[done:start])
            done, gone, last = at[z - 1][1], gone + z - a, z
    parts.append(text[done:])
    return " ".join(p.strip() for p in parts if p.strip()), gone
