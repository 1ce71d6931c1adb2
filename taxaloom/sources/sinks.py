"""Sinks: atomic JSON, exports as CSV and ZIP, reports.

Distributed tables are written by Spark's commit protocol. The single JSON files of the export are written in
parallel parts in order and joined by their bytes, in any file system that Spark reaches; CSV and ZIP, which are for
downloads, go through the driver row by row and stay local.
"""

from __future__ import annotations

import csv
import io
import os
import zipfile
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.operators.catalog import csv_cells
from taxaloom.sources import storage


def _replace(path: str, chunks: Iterable[str]) -> None:
    tmp = f"{path}.tmp"
    with open(tmp, "w", encoding="utf-8", newline="") as f:
        for c in chunks:
            f.write(c)
        f.flush()
        os.fsync(f.fileno())
    os.replace(tmp, path)


def write_json_array(df: DataFrame, path: str, order: str, indent: bool = True) -> int:
    """One JSON array of all records in order, null fields kept; the number of records.

    Tasks render and write their parts in parallel; the driver only joins the bytes.
    """
    pretty = {"ignoreNullFields": "false", "pretty": str(bool(indent)).lower()}
    lines = df.select(F.concat(F.lit(","), F.to_json(F.struct(*df.columns), pretty)).alias("j"), order)
    storage.write_merged(lines.toDF("_line", "_order"), path, ["_order"], "[\n", "]\n", first=1)
    return df.count()


def write_keyed_json(df: DataFrame, path: str, key: str, order: str = "ord") -> None:
    """One object {key: record} in delivered order, in the same way."""
    fields = [c for c in df.columns if c not in (key, order)]
    name = F.regexp_extract(F.to_json(F.struct(F.col(key).alias("k"))), r'^\{"k":(.*)\}$', 1)
    lines = df.where(F.col(key).isNotNull()).select(F.concat(F.lit(","), name, F.lit(": "), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})), order)
    storage.write_merged(lines.toDF("_line", "_order"), path, ["_order"], "{\n", "}\n", first=1)


def _csv_lines(columns: list[str], rows: Iterable) -> Iterable[str]:
    buf = io.StringIO()
    w = csv.writer(buf)
    w.writerow(columns)
    for r in rows:
        w.writerow(["" if v is None else v for v in r])
        yield buf.getvalue()
        buf.seek(0)
        buf.truncate()
    yield buf.getvalue()


def write_csv(df: DataFrame, path: str, order: str | None = None) -> None:
    """One CSV file with a header, rows in order."""
    d = df.orderBy(order) if order else df
    _replace(path, _csv_lines(d.columns, d.toLocalIterator()))


def export_columns(df: DataFrame, fixed: list[str], locales: int = 30) -> DataFrame:
    """Fixed columns, arrays joined by '|', and one name column for each of the most frequent locales."""
    from taxaloom.operators.ordering import top_by_count

    kinds = dict(df.dtypes)
    tops = [r[0] for r in top_by_count(df.select("ord", F.explode(F.map_keys("common_names")).alias("locale")), "locale", "ord", locales).collect()]
    plain = [F.array_join(c, "|").alias(c) if kinds[c].startswith("array") else F.col(c) for c in fixed]
    return df.select(*plain, *[F.coalesce(F.element_at("common_names", F.lit(x)), F.lit("")).alias(f"common_name_{x}") for x in tops])


def api_csv(df: DataFrame, fields: str = "") -> str:
    """Records of one page as CSV text; '' for no records."""
    d = csv_cells(df, fields)
    rows = d.collect()
    return "".join(_csv_lines(d.columns, rows)) if rows else ""


def write_zip(path: str, files: list[str]) -> None:
    """Files deflated into one archive, under their base names."""
    tmp = f"{path}.tmp"
    with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as z:
        for f in files:
            z.write(f, os.path.basename(f))
    os.replace(tmp, path)
