"""Readers: review tables, community posts, rules, facets, thresholds and spreadsheets."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.config import Settings
from reviewlake.functions import text as T

# Header names that mean the same column.
HEADER_ALIASES = {"platfrom": "platform", "product_name": "product", "review_text": "review", "comments": "review", "content": "review"}
FALLBACK_TEXT = ("text", "body", "content", "contents", "summary")
POST_COLUMNS = {
    "platform": ("플랫폼", "platform"),
    "link": ("링크", "link", "url"),
    "date": ("작성일", "date"),
    "title": ("제목", "title"),
    "body": ("본문", "본문 내용", "body", "content"),
    "summary": ("본문 요약 및 주요 내용", "요약", "summary"),
}


def read_table(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """A parquet, csv (also gzipped), json, orc or xlsx table; the format comes from the name if it is not given."""
    if fmt is None:
        m = re.search(r"\.(parquet|csv|json|orc|xlsx)(\.gz)?$", path)
        fmt = m[1] if m else "parquet"
    if fmt == "xlsx":
        from reviewlake.sources.xlsx import read_xlsx

        return read_xlsx(spark, path, **options)
    if fmt == "csv":
        options = {"header": True, "multiLine": True, "escape": '"'} | options
    return spark.read.format(fmt).options(**options).load(path)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Headers trimmed and lower-cased, unnamed ones dropped, aliases renamed; of equal names the first non-null value."""
    names: dict[str, list[str]] = {}
    for c in df.columns:
        name = c.strip().lower()
        if not name.startswith("unnamed"):
            names.setdefault(HEADER_ALIASES.get(name, name), []).append(c)
    if "review" not in names:
        for name in FALLBACK_TEXT:
            if name in names:
                names["review"] = names.pop(name)
                break
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in df.columns}
    return df.select(*[F.coalesce(*[quoted[c] for c in own]).alias(name) if len(own) > 1 else quoted[own[0]].alias(name) for name, own in names.items()])


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; found: {df.columns}")
    return df


def load_reviews(df: DataFrame, keep_meta: bool = True) -> DataFrame:
    out = require_columns(normalize_columns(df), "review")
    return out if keep_meta else out.select("review")


def pick(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    return next((c for c in candidates if c in columns), None)


def load_posts(df: DataFrame, product: str) -> DataFrame:
    """The eight columns of posts; title, body, platform and link must be there, date and summary may be missing."""
    found = {k: pick(df.columns, v) for k, v in POST_COLUMNS.items()}
    missing = [k for k in ("title", "body", "platform", "link") if found[k] is None]
    if missing:
        raise ValueError(f"missing columns: {missing}; found: {df.columns}")
    text = lambda k: F.col(f"`{found[k]}`").cast("string")
    return df.select(
        text("platform").alias("platform"),
        text("link").alias("link"),
        (text("date") if found["date"] else F.lit(None).cast("string")).alias("date"),
        F.coalesce(text("title"), F.lit("")).alias("title"),
        F.coalesce(text("body"), F.lit("")).alias("body"),
        (F.coalesce(text("summary"), F.lit("")) if found["summary"] else F.lit("")).alias("summary"),
        F.lit(product).alias("product"),
        T.post_id(F.lit(product), text("link"), text("title")).alias("post_id"),
    )


def union_tables(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def merge_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The tables under each other by column name, with the name of the file each row is from."""
    return union_tables(*[t.select(F.lit(name).alias("source_file"), *t.columns) for name, t in sorted(tables.items())])


def read_merged(spark: SparkSession, folder: str, pattern: str = "*_clauses_clustered_*", fmt: str = "parquet") -> DataFrame:
    """All matching files below a folder, unreadable ones skipped, with their names; of workbooks the sheet clauses.

    A part file of a dataset folder goes by the folder's name.
    """
    if fmt == "xlsx":
        from reviewlake.sources.xlsx import read_xlsx

        return read_xlsx(spark, folder, "clauses", pattern=pattern, skip_unreadable=True)
    df = spark.read.format(fmt).option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").option("mergeSchema", "true").option("pathGlobFilter", pattern).load(folder)
    steps = F.split(F.col("_metadata.file_path"), "/")
    name = F.when(F.col("_metadata.file_name").startswith("part-"), F.element_at(steps, -2)).otherwise(F.col("_metadata.file_name"))
    return df.select(name.alias("source_file"), "*")


def discover(folder: str, pattern: str = "*.xlsx") -> list[str]:
    """Sorted dataset files of a folder; lock files are left out."""
    return sorted(str(p) for p in Path(folder).glob(pattern) if not p.name.startswith("~$"))


def product_key(name: str) -> str:
    """The name in lower case without anything but letters of any script, digits and underscores."""
    return "".join(c for c in name.strip().lower() if c.isalnum() or c == "_")


def discover_all(data_dir: str, pattern: str = "*.xlsx") -> tuple[list[str], list[str]]:
    """(review files, community files) of the folders review and community below data_dir."""
    return discover(f"{data_dir}/review", pattern), discover(f"{data_dir}/community", pattern)


def rules_for(product: str, folder: str, facets: str | None = None, thresholds: str | None = None) -> tuple[str, str]:
    """(facets, thresholds): the product's own files if they are there, else the given ones, else the common ones."""
    out = []
    for kind, given in (("facets", facets), ("thresholds", thresholds)):
        own = Path(folder) / f"{kind}_{product_key(product)}.yml"
        out.append(str(own) if own.exists() else given or str(own.with_name(kind + ".yml")))
    return tuple(out)


def with_position(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """df with the order of its rows in their files, if it has no such column: the same whenever the files are read alike."""
    return df if name in df.columns else df.withColumn(name, F.monotonically_increasing_id())


def resolve_rules(products: DataFrame, available: DataFrame, product: str = "product", path: str = "path") -> DataFrame:
    """Each product with the path of its own rule, or of the rule without a product."""
    common = available.filter(F.col(product).isNull()).select(F.col(path).alias("_common"))
    own = available.filter(F.col(product).isNotNull())
    return products.join(own, product, "left").join(F.broadcast(common.limit(1)), how="left").select(*products.columns, F.coalesce(path, "_common").alias(path))


def parse_facets(given) -> list[dict]:
    """(id, name, desc) of facets given as a list, as a list under `buckets` or `facets`, or as a dict of dicts."""
    if isinstance(given, Mapping):
        given = given.get("buckets", given.get("facets", given))
    if isinstance(given, Mapping):
        given = [{"id": k, **(v if isinstance(v, Mapping) else {"desc": v})} for k, v in given.items()]
    out = []
    for x in given or []:
        ident = str(x.get("id") or x.get("name") or "").strip()
        if not ident:
            raise ValueError(f"a facet needs an id: {x}")
        keywords = ", ".join(map(str, x.get("keywords") or []))
        desc = x.get("desc") or x.get("description") or keywords or f"about {ident}"
        out.append({"id": ident.lower().replace(" ", ""), "name": str(x.get("name") or ident), "desc": str(desc)})
    return out


def load_yaml(path: str):
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


def facets_table(spark: SparkSession, facets: Sequence[Mapping]) -> DataFrame:
    return spark.createDataFrame([(f["id"], f["name"], f["desc"]) for f in facets], "id string, name string, desc string")


def load_facets(spark: SparkSession, path: str, embed) -> DataFrame:
    """(id, emb) of a rule file's facets, each embedded as "id: desc" by embed(df, text); a facet without an id is refused."""
    return facet_vectors(spark, parse_facets(load_yaml(path)), embed)


def facet_vectors(spark: SparkSession, facets: Sequence[Mapping], embed) -> DataFrame:
    rows = spark.createDataFrame([(f["id"], f"{f['id']}: {f['desc']}") for f in facets], "id string, _t string")
    return embed(rows, "_t").select("id", F.col("embedding").alias("emb"))


# Threshold names of rule files and the settings they set.
THRESHOLDS = {"top_k_facets": "facet_top_k", "facet_threshold": "facet_threshold", "hetero_sil_threshold": "hetero_threshold", "min_cluster_size_for_split": "min_split_size", "max_local_k": "max_local_k"}


def with_thresholds(settings: Settings, given: Mapping | None) -> tuple[Settings, bool]:
    """(settings, whether refinement is on) after a threshold file's `refinement` part."""
    found = (given or {}).get("refinement", {}) or {}
    return replace(settings, **{THRESHOLDS[k]: v for k, v in found.items() if k in THRESHOLDS}), bool(found.get("enabled", True))
