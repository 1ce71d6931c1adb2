"""Command line: python -m taxaloom {query NAME|list|search Q|audit} TABLES_DIR."""

from __future__ import annotations

import argparse

from taxaloom.operators import catalog, quality
from taxaloom.plans import registry
from taxaloom.plans.common import records
from taxaloom.session import get_spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="taxaloom")
    sub = p.add_subparsers(dest="command", required=True)
    for name, args in (("query", ["name", "tables"]), ("list", ["tables"]), ("search", ["q", "tables"]), ("audit", ["tables"])):
        c = sub.add_parser(name)
        for a in args:
            c.add_argument(a)
        c.add_argument("--limit", type=int, default=20)
        c.add_argument("--sort", default="")
        c.add_argument("--group", default="")
        c.add_argument("--fields", default="")
        c.add_argument("--strict", action="store_true")
    a = p.parse_args(argv)
    spark = get_spark()
    if a.command == "query":
        registry.queries()[a.name](spark, a.tables).show(a.limit, False)
    elif a.command == "list":
        d = catalog.page(catalog.filters(records(spark, a.tables), group=a.group), a.sort, 1, a.limit)
        catalog.project(d, a.fields).show(a.limit, False)
    elif a.command == "search":
        d = catalog.search(records(spark, a.tables), a.q, a.group).orderBy("score", "ord", ascending=[False, True])
        d.select("scientific_name", "common_name", "score").show(a.limit, False)
    else:
        d = quality.audit(records(spark, a.tables), ["birdnet_id", "scientific_name", "common_name", "taxon_group"])
        d.show(50, False)
        if a.strict and quality.failed(d, ["missing_scientific_name", "bad_scientific_name"]):
            return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
