"""All registered queries of the core, and their SQL twins."""

from __future__ import annotations

import importlib

MODULES = ("nested", "names", "catalog", "joins", "ordering", "aggregates", "merge", "textfuncs", "batches", "media", "worklists", "reports")


def _collect(attr: str) -> dict:
    out: dict = {}
    for m in MODULES:
        try:
            mod = importlib.import_module(f"taxaloom.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"taxaloom.plans.{m}":
                raise
            continue
        out.update(getattr(mod, attr))
    return out


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("ORACLE")
