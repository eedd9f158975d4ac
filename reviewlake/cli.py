"""Command line: python -m reviewlake.cli --files a.parquet --output_dir out [--mode community_filtered --product p ...]"""

from __future__ import annotations

import argparse
import logging
from pathlib import Path

from pyspark.sql import SparkSession

from reviewlake.config import LANGUAGES, Settings
from reviewlake.operators import report
from reviewlake.plans import reviews as plans
from reviewlake.sources import reviews as sources
from reviewlake.sources import sinks

log = logging.getLogger("reviewlake")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--files", nargs="*", default=[])
    p.add_argument("--output_dir", default="output")
    p.add_argument("--resume", action="store_true", help="use what the models gave in an earlier run")
    p.add_argument("--cache_dir", help="where that is kept; output_dir/cache unless given")
    p.add_argument("--state", help="where ids go on from run to run; output_dir/state unless given")
    p.add_argument("--language", choices=sorted(LANGUAGES), default="korean")
    p.add_argument("--merge_percentile", type=float, help="merge clusters above this percentile of similarities")
    p.add_argument("--facets")
    p.add_argument("--thresholds")
    p.add_argument("--mode", choices=("auto", "community_filtered"), default="auto")
    p.add_argument("--all", action="store_true", help="every dataset in the folders review and community of --data_dir")
    p.add_argument("--data_dir", default="data")
    p.add_argument("--pattern", default="*.xlsx", help="the datasets that --all takes")
    p.add_argument("--rules_dir", default="rules")
    p.add_argument("--product")
    p.add_argument("--community_rules")
    p.add_argument("--rel_tau", type=float)
    p.add_argument("--alias_tau", type=float)
    p.add_argument("--ban_mode", choices=("soft", "strict", "off"))
    p.add_argument("--save_filter_debug", action="store_true")
    p.add_argument("--summary_max_sentences", type=int)
    return p


def settings_of(args) -> Settings:
    given = {
        "community_rel_tau": args.rel_tau, "community_alias_tau": args.alias_tau, "community_ban_mode": args.ban_mode, "community_summary_max": args.summary_max_sentences,
        "merge_percentile": args.merge_percentile, "language": LANGUAGES[args.language],
    }
    return Settings.from_env(**{k: v for k, v in given.items() if v is not None})


def stem(path: str) -> str:
    return Path(path).name.split(".")[0]


def ruled(args, product: str, settings: Settings) -> tuple[Settings, list[dict], bool]:
    """(settings, facets, whether to refine) by the product's rule files, the command line's, or the common ones."""
    facets_path, thresholds_path = sources.rules_for(product, args.rules_dir, args.facets, args.thresholds)
    facets = sources.parse_facets(sources.load_yaml(facets_path)) if Path(facets_path).exists() else []
    refine = True
    if Path(thresholds_path).exists():
        settings, refine = sources.with_thresholds(settings, sources.load_yaml(thresholds_path))
    return settings, facets, refine


def options(args, name: str, facets: list[dict], refine: bool) -> dict:
    cache, state = args.cache_dir or f"{args.output_dir}/cache", args.state or f"{args.output_dir}/state"
    return {"facets": facets, "refine": refine, "dataset": name, "cache_dir": f"{cache}/{name}", "state_path": f"{state}/{name}", "resume": args.resume}


def save(tables: dict, out: str, settings: Settings, **more) -> None:
    sheets = report.workbook(tables["clauses"], tables["mapping"], tables["reviews"])
    sinks.write_sheets({**tables, **sheets}, out)
    sinks.write_manifest(f"{out}/manifest.json", settings, **more)


def run_reviews_of(spark: SparkSession, args, path: str) -> None:
    product = args.product or stem(path).split("_")[0]
    settings, facets, refine = ruled(args, product, settings_of(args))
    loaded = sources.with_position(sources.load_reviews(sources.read_table(spark, path)))
    tables = plans.run_reviews(loaded, settings, "row_idx", **options(args, stem(path), facets, refine))
    lost = report.columns_lost(loaded, tables["reviews"].withColumnsRenamed({"product_name": "product", "comments": "review"}))
    log.info("%s: columns that the sheet leaves out: %s", path, lost)
    save(tables, f"{args.output_dir}/{stem(path)}", settings, input=path, product=product)


def run_community_of(spark: SparkSession, args, product: str, paths: list[str]) -> None:
    """One run over all post files of a product."""
    rules = sources.load_yaml(args.community_rules or f"{args.rules_dir}/community.yml")
    if product not in rules["products"]:
        raise SystemExit(f"unknown product: {product}; known: {sorted(rules['products'])}")
    settings, facets, refine = ruled(args, product, settings_of(args))
    terms = [t for own in (rules.get("facets") or {}).values() for t in own or []]
    aliases, banned = rules["products"][product].get("aliases") or [], rules.get("ban_terms") or []
    posts = sources.union_tables(*[sources.load_posts(sources.read_table(spark, p), product) for p in paths])
    if posts.isEmpty():
        raise SystemExit("there are no posts to read")
    name = f"{product}_community"
    tables = plans.run_community(posts, settings, aliases, terms, banned, **options(args, name, facets, refine))
    if args.save_filter_debug:
        tables["filter_debug"] = plans.run_posts(posts, settings, aliases, terms, banned)[2]
    save(tables, f"{args.output_dir}/{name}", settings, input=paths, product=product)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.all and args.mode == "community_filtered":
        raise SystemExit("--all already runs both kinds; leave out --mode")
    reviews, posts = sources.discover_all(args.data_dir, args.pattern) if args.all else ([], [])
    reviews += args.files if args.mode == "auto" else []
    by_product: dict[str, list[str]] = {}
    for path in [*posts, *(args.files if args.mode == "community_filtered" else [])]:
        product = args.product or stem(path).split("_")[0]
        by_product.setdefault(product.strip().lower(), []).append(path)
    if not reviews and not by_product:
        raise SystemExit("no input: give --files, or --all with --data_dir")
    spark = SparkSession.builder.appName("reviewlake").getOrCreate()
    for path in reviews:
        run_reviews_of(spark, args, path)
    for product, paths in by_product.items():
        run_community_of(spark, args, product, paths)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
