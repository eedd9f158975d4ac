"""Tools: python -m reviewlake.tools merge_all FOLDER OUT [--fmt xlsx] | resolve_rules PRODUCT... [--rules_dir rules]"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from reviewlake.sources import reviews as sources
from reviewlake.sources import sinks


def merge_all(spark: SparkSession, folder: str, out: str, fmt: str = "parquet", pattern: str = "*_clauses_clustered_*") -> str:
    """Writes the sheet clauses_all: the clauses of all runs below a folder with the name of each one's file."""
    return sinks.write_sheets({"clauses_all": sources.read_merged(spark, folder, pattern, fmt)}, out)["clauses_all"]


def rules_table(products: list[str], rules_dir: str = "rules") -> str:
    """A table of fixed width: each product with the rule files that a run of it would use."""
    rows = [("product", "facets", "thresholds"), *((p, *sources.rules_for(p, rules_dir)) for p in products)]
    widths = [max(len(r[i]) for r in rows) for i in range(3)]
    return "\n".join("  ".join(c.ljust(w) for c, w in zip(r, widths)).rstrip() for r in rows)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("tool", choices=("merge_all", "resolve_rules"))
    p.add_argument("names", nargs="+")
    p.add_argument("--fmt", default="parquet")
    p.add_argument("--pattern", default="*_clauses_clustered_*")
    p.add_argument("--rules_dir", default="rules")
    args = p.parse_args(argv)
    if args.tool == "resolve_rules":
        print(rules_table(args.names, args.rules_dir))
    else:
        folder, out = args.names
        print(merge_all(SparkSession.builder.appName("merge_all").getOrCreate(), folder, out, args.fmt, args.pattern))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
