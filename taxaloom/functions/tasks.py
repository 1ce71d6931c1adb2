"""Text tasks of a generating service: shorten, translate, write from other languages. Requests out, checked texts back.

A request is made of a batch of rows and asks for one JSON object, name to locale to text; what comes back is mended
(`udf.repair_json`) and checked: only names and locales that were asked for count, blank texts don't.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.functions.udf import repair_json

GOALS = {
    "shorten": "Cut every text below down to about {words} words of running prose in the language it has. Keep looks, places and habits; add nothing.",
    "translate": "Give every text below in each of the languages named before it, in running prose of the same length. Add nothing and leave nothing out.",
    "fallback": "Write a description in English of about {words} words for every species below, from the texts in other languages alone.",
}
FORMAT = "Answer with one JSON object and nothing else: the name as given, then the language code, then the text."


def request(task: str, rows: list[dict], words: int = 120) -> str:
    """The text of a request. A row has name, locales (asked for) and texts ({locale: text})."""
    body = [json.dumps({"name": r["name"], "languages": list(r["locales"]), "texts": dict(r["texts"])}, ensure_ascii=False) for r in rows]
    return "\n".join([GOALS[task].format(words=words), FORMAT, *body])


def read(answer: str | None, rows: list[dict]) -> list[tuple[str, str, str]]:
    """(name, locale, text) of what an answer has of the things asked for, in the order asked."""
    got = repair_json(answer)
    found = []
    for r in rows:
        texts = got.get(r["name"])
        for locale in r["locales"]:
            text = texts.get(locale) if isinstance(texts, dict) else None
            if isinstance(text, str) and text.strip():
                found.append((r["name"], locale, text.strip()))
    return found


def run(work: DataFrame, task: str, send: Callable[[str], str | None], batch: str = "batch", words: int = 120, tries: int = 2) -> DataFrame:
    """(scientific_name, locale, text) of a task over batched rows (scientific_name, locales, texts, `batch`).

    A batch is small by construction (see `operators.batching`), so that one task holds it; a request that fails is
    repeated, and what it doesn't give stays open. Rows with a null batch are not sent.
    """

    def do(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [{"name": r.scientific_name, "locales": list(r.locales), "texts": dict(r.texts)} for r in pdf.itertuples()]
        found: list[tuple[str, str, str]] = []
        for _ in range(tries):
            try:
                found = read(send(request(task, rows, words)), rows)
            except Exception:  # noqa: BLE001
                continue
            if found:
                break
        return pd.DataFrame(found, columns=["scientific_name", "locale", "text"], dtype=object)

    d = work.where(F.col(batch).isNotNull()).select("scientific_name", "locales", "texts", batch)
    return d.groupBy(batch).applyInPandas(do, "scientific_name string, locale string, text string")


