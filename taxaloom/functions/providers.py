"""Pluggable text providers (translation, generation) run over batches in workers.

A provider is a callable (list of texts, options) -> list of texts or None. A batch that fails or
comes back incomplete is retried, then sent one by one; texts that fail stay null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from taxaloom.functions.udf import decode_batch, encode_batch

Provider = Callable[[list[str], dict], list[str] | None]
_REGISTRY: dict[str, Provider] = {}


def register(name: str, provider: Provider) -> None:
    _REGISTRY[name] = provider


def provider(name: str) -> Provider:
    if name not in _REGISTRY:
        raise KeyError(f"no provider {name}; registered: {', '.join(sorted(_REGISTRY)) or 'none'}")
    return _REGISTRY[name]


def through_markers(send: Callable[[str], str]) -> Provider:
    """A provider from a service that takes one text: batches travel with markers between the pieces."""
    return lambda texts, options: decode_batch(send(encode_batch(texts)), len(texts))


def run_batch(p: Provider, texts: list[str], options: dict, tries: int = 2) -> list[str | None]:
    for _ in range(tries):
        try:
            got = p(texts, options)
        except Exception:  # noqa: BLE001
            got = None
        if got is not None and len(got) == len(texts):
            return list(got)
    if len(texts) == 1:
        return [None]
    return [run_batch(p, [t], options, tries)[0] for t in texts]


def apply(df: DataFrame, text: str, p: Provider, options: dict | None = None, size: int = 12, to: str = "result") -> DataFrame:
    """Add the provider's answer to each text; null texts are not sent."""
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            out = pd.Series([None] * len(b), dtype=object)
            idx = [i for i, t in enumerate(b) if t]
            for k in range(0, len(idx), size):
                part = idx[k : k + size]
                for i, r in zip(part, run_batch(p, [b.iloc[i] for i in part], options or {})):
                    out.iloc[i] = r
            yield out

    return df.withColumn(to, run(F.col(text)))
