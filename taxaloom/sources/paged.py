"""Paged services as Spark data sources.

`PagedSource` reads a service page by page, one partition a run of pages, so that executors fetch
in parallel. The service is a fetcher: a callable (page, options) -> list of dicts, named by
"module:function", so that tests and offline runs give recorded pages. Requests are spaced by
`min_interval` (over all partitions of a read), retried with growing pauses, and answers may be kept by content key in
`cache`, a folder that all executors share (a mounted one; what isn't there is fetched). `read_until` stops a whole read.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import os
import time
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def cache_key(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:16]


class Cache:
    """Answers by key in a folder; writing goes through a temporary name, so that readers see whole files."""

    def __init__(self, folder: str | None):
        self.folder = folder

    def get(self, key: str) -> object | None:
        p = Path(self.folder or "", f"{key}.json")
        return json.loads(p.read_text())["value"] if self.folder and p.exists() else None

    def put(self, key: str, value: object) -> None:
        if not self.folder:
            return
        os.makedirs(self.folder, exist_ok=True)
        p = Path(self.folder, f"{key}.json")
        t = p.with_suffix(f".{os.getpid()}.tmp")
        t.write_text(json.dumps({"stored_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "value": value}))
        os.replace(t, p)


def with_retries(call: Callable[[], object], tries: int = 3, pause: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> object:
    """The call's value; failures are retried after pauses that double, the last one is raised."""
    for k in range(tries):
        try:
            return call()
        except Exception:
            if k == tries - 1:
                raise
            sleep(pause * 2**k)
    raise AssertionError


def fetcher(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


#: Options that say how to read, not what.
_READING = ("first_page", "pages", "pages_per_partition", "min_interval", "tries", "pause", "cache", "stop_below", "stop_below_field")


class _Pages(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__((first, last))


class _Reader(DataSourceReader):
    def __init__(self, schema, options):
        self.names, self.options = [f.name for f in schema.fields], dict(options)

    def partitions(self):
        first, pages, each = int(self.options.get("first_page", 1)), int(self.options.get("pages", 1)), max(1, int(self.options.get("pages_per_partition", 10)))
        return [_Pages(a, min(a + each, first + pages)) for a in range(first, first + pages, each)]

    def read(self, partition) -> Iterator[tuple]:
        fetch, cache = fetcher(self.options["fetcher"]), Cache(self.options.get("cache"))
        # The spacing holds for the whole read, whose partitions may all run at once.
        gap = float(self.options.get("min_interval", 0)) * len(self.partitions())
        stop_field, least = self.options.get("stop_below_field"), float(self.options.get("stop_below", 0))
        for page in range(*partition.value):
            own = sorted((k, v) for k, v in self.options.items() if k not in _READING)
            key = cache_key(self.options["fetcher"], page, own)
            rows = cache.get(key)
            if rows is None:
                rows = with_retries(lambda p=page: fetch(p, self.options), int(self.options.get("tries", 3)), float(self.options.get("pause", 0.5)))
                cache.put(key, rows)
                time.sleep(gap)
            for r in rows:
                if stop_field and (r.get(stop_field) or 0) < least:
                    return
                yield tuple(r.get(n) for n in self.names)
            if not rows:
                return


class PagedSource(DataSource):
    """Format "paged". Options: fetcher, pages, pages_per_partition, min_interval, tries, cache, stop_below_field, stop_below."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self):
        raise ValueError("give the schema of the pages with .schema(...)")

    def reader(self, schema) -> DataSourceReader:
        return _Reader(schema, self.options)


def read_pages(spark: SparkSession, schema: str, fetch: str, pages: int, **options: object) -> DataFrame:
    spark.dataSource.register(PagedSource)
    r = spark.read.format("paged").schema(schema).option("fetcher", fetch).option("pages", str(pages))
    for k, v in options.items():
        r = r.option(k, str(v))
    return r.load()


def read_until(spark: SparkSession, schema: str, fetch: str, most_pages: int, wave: int, stop_below_field: str, stop_below: float, keep: Callable[[DataFrame], DataFrame], **options: object) -> DataFrame:
    """Rows of pages in falling order of a field, up to the first below a bound, over the whole read.

    Pages are fetched in waves of `wave`, which run in parallel; no further wave is asked for once one has a row below the
    bound or fewer rows than pages. `keep` holds a wave's rows (see `session.checkpoint`), so that nothing is fetched twice.
    """
    out = None
    for first in range(1, most_pages + 1, wave):
        pages = min(wave, most_pages + 1 - first)
        got = keep(read_pages(spark, schema, fetch, pages, first_page=first, **options))
        good = got.where(F.coalesce(stop_below_field, F.lit(0)) >= stop_below)
        out = good if out is None else out.unionByName(good)
        n, enough = got.agg(F.count("*"), F.count_if(F.coalesce(stop_below_field, F.lit(0)) >= stop_below)).first()
        if n < pages or enough < n:
            break
    return out if out is not None else spark.createDataFrame([], schema)
