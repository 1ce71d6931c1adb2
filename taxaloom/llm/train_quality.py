"""Induce the rule list of `quality` and store it: python -m taxaloom.llm.train_quality TABLES_DIR.

The labelled documents are the entries of `descriptions` under TABLES_DIR (at most MOST of them,
in hash order). Each got its class from a line-by-line annotation guide, written out in `annotate`: a line
belongs to a table, a list, to junk or to prose, and the class with the most characters wins.
A third of the documents is held out; the accuracy there is stored with the rules.
"""

from __future__ import annotations

import json
import re
import sys

import numpy as np

from taxaloom.llm import quality
from taxaloom.llm.common import COMMON_WORDS, MODELS, descriptions
from taxaloom.session import get_spark, table

#: Bound of the labelled sample.
MOST = 20_000
#: Inductions over different splits, of which the one with the fewest errors in training is kept.
SEEDS = 16
WORDS = {w for ws in COMMON_WORDS.values() for w in ws}
BULLET = re.compile(r"^\s*(?:[-*•·–—►▪]|\(?\d{1,3}[.)])\s+")
CLOSED = re.compile(r"[.!?…。！？][\"”»’)\]\d\[]*\s*$")


def _line_class(line: str, wrapped: bool) -> str:
    body = BULLET.sub("", line).strip()
    letters = sum(ch.isalpha() for ch in body)
    words = re.findall(r"[^\W\d_]+", body.lower())
    kana = len(re.findall(r"[぀-ゟ]", body))
    known = sum(len(w) > 2 and w in WORDS for w in words)
    if re.search(r"<(?:td|tr|li|div|span|p|a)\b[^>]*>.*</", body) or body.count("|") >= 3 and body.startswith("|") or body.count("\t") >= 2:
        return "table"
    if re.fullmatch(r"[^|;\t]+(?:(?:\s*\|\s*|;|\s{2,})[^|;\t]+){2,}", body) and re.search(r"\d|[Ss]ize|Gr|Ta", body) and known < 2 and not kana:
        return "table"
    if re.match(r"^\S{2,12}\s*(?::|=|\.{3,})\s*\S", body) and len(body) < 70 and not CLOSED.search(body):
        return "table"
    if not kana and known == 0 and re.search(r"[a-z];[a-z]|[a-z] ;[a-z]", body) and not re.search(r"; ", body.replace(" ;", "")):
        return "junk"
    if letters < 0.35 * len(body) and not kana or (len(body) > 60 and " " not in body and not kana) or re.search(r"Rep\. \d", body):
        return "junk"
    if len(set(body.replace(" ", ""))) <= 4 and len(body) > 20:
        return "junk"
    if CLOSED.search(body) and (any(w in WORDS for w in words) or kana):
        return "prose"
    if BULLET.match(line):
        return "list"
    if len(re.findall(r" [|/»>·•] |;", body)) >= 3:
        return "list"
    if len(re.findall(r"[,、]", body)) >= max(4, len(words) / 6) and not CLOSED.search(body) and body[:1].islower():
        return "list"
    return "open" if wrapped and len(body) > 30 or len(words) > 3 or kana else "short"


def annotate(text: str | None) -> str:
    if not text or not text.strip():
        return "prose"
    lines = [x for x in text.split("\n") if x.strip()]
    sizes: dict[str, int] = {}
    if len(lines) > 8 and len(set(lines)) < 3:
        return "junk"
    classes = [_line_class(x, len(lines) > 1) for x in lines]
    many_short = sum(c == "short" and len(x) < 24 for c, x in zip(classes, lines)) >= 4
    for x, c in zip(lines, classes):
        c = {"open": "prose", "short": "list" if many_short else "prose"}.get(c, c)
        sizes[c] = sizes.get(c, 0) + len(x)
    return max(sizes, key=sizes.__getitem__)


def main(tables: str) -> None:
    spark = get_spark()
    d = quality.with_statistics(descriptions(table(spark, tables, "species_records"))).where("text is not null")
    pdf = d.orderBy(__import__("pyspark.sql.functions", fromlist=["x"]).expr("xxhash64(rec_id, locale)")).limit(MOST).toPandas()
    labels = np.array([annotate(t) for t in pdf["text"]])
    x = pdf[list(quality.FEATURES)].to_numpy(float)
    held = np.arange(len(x)) % 3 == 0
    coarse = np.where(labels == "prose", "prose", "other")

    def apply(rows: np.ndarray, given: list[dict]) -> np.ndarray:
        out, free = np.full(len(rows), given[-1]["class"], dtype="U8"), np.ones(len(rows), bool)
        for r in given[:-1]:
            m = free & quality._covers(rows, [(quality.FEATURES.index(f), op, v) for f, op, v in r["tests"]])
            out[m], free = r["class"], free & ~m
        return out

    def wrong(given: list[dict]) -> int:
        return int((apply(x[~held], given) != coarse[~held]).sum())

    rules = min((quality.induce(x[~held], coarse[~held], "prose", ["other"], seed) for seed in range(SEEDS)), key=wrong)
    other = (coarse == "other") & ~held
    kinds = quality.induce(x[other], labels[other], "list", ["junk", "table"])

    got = np.where(apply(x, rules) == "prose", "prose", apply(x, kinds))
    bad, said = labels[held] != "prose", got[held] != "prose"
    report = {
        "documents": int(len(x)), "classes": {c: int((labels == c).sum()) for c in sorted(set(labels))},
        "held_out": int(held.sum()), "accuracy": round(float((labels[held] == got[held]).mean()), 5),
        "not_prose_precision": round(float((bad & said).sum() / max(1, said.sum())), 5), "not_prose_recall": round(float((bad & said).sum() / max(1, bad.sum())), 5),
    }
    (MODELS / "quality_rules.json").write_text(json.dumps({"report": report, "rules": rules, "kinds": kinds}, indent=1) + "\n")
    print(json.dumps(report))
    for r in [*rules, *kinds]:
        print(r)
    for i in np.flatnonzero((labels != "prose") != (got != "prose"))[:40]:
        print(labels[i], got[i], pdf["rec_id"][i], pdf["locale"][i], repr(pdf["text"][i][:160]), "..", repr(pdf["text"][i][-50:]), list(x[i]))


if __name__ == "__main__":
    main(sys.argv[1])
