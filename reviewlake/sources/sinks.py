"""Writers: sheets as tables, JSON summaries, manifests and the content-keyed caches."""

from __future__ import annotations

import json
import platform
import subprocess
import sys
from collections.abc import Mapping
from dataclasses import asdict
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.config import Settings


def write_sheets(sheets: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """One table for each sheet below a folder."""
    out = {}
    for name, df in sheets.items():
        out[name] = f"{folder}/{name}"
        df.write.mode("overwrite").format(fmt).save(out[name])
    return out


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_clustered(df: DataFrame, rows: int, path: str) -> None:
    """Clustered reviews as csv, json or parquet, by the path's ending; refuses another ending or another number of rows."""
    fmt = path.rsplit(".", 1)[-1].lower()
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError(f"unknown format: {path}; known: csv, json, parquet")
    if df.count() != rows:
        raise ValueError(f"{df.count()} labelled rows for {rows} reviews")
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)


def stamped(name: str, at: datetime | None = None) -> str:
    """A file name with the run's time, as in clauses_240131_235959."""
    return f"{name}_{(at or datetime.now()).strftime('%y%m%d_%H%M%S')}"


def cached(df: DataFrame, keys: list[str], compute, path: str) -> DataFrame:
    """Every row of df with what compute(rows) gives for its keys; computed only for keys that are not in the cache yet.

    Keys are a hash of content, so a changed input is computed anew and a resumed run computes only what is missing. The
    cache grows by the new ones, one row a key; repeated rows of df all get theirs. Columns that df has already stay its
    own. compute keeps the column cache_key.
    """
    spark = df.sparkSession
    marked = df.withColumn("cache_key", F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256))
    if _exists(spark, path):
        missing = marked.join(spark.read.parquet(path).select("cache_key"), "cache_key", "left_anti")
    else:
        missing = marked
    compute(missing.dropDuplicates(["cache_key"])).write.mode("append").parquet(path)
    held = spark.read.parquet(path).dropDuplicates(["cache_key"])
    return marked.join(held.select("cache_key", *[c for c in held.columns if c not in marked.columns]), "cache_key")


STATE_VERSION = 1


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """(sig, stable_id) of the last run that was written whole; None without one or if it is of another version."""
    last = max(_whole_versions(spark, path), default=None)
    if last is None:
        return None
    state = spark.read.parquet(f"{path}/v{last:09d}")
    return state.select("sig", "stable_id") if state.filter(F.col("version") != STATE_VERSION).isEmpty() else None


def write_state(state: DataFrame, path: str) -> None:
    """The ids of signatures as the next version of the state; earlier ones stay until it is whole, then all but one go."""
    from reviewlake.session import delete_path

    spark = state.sparkSession
    known = sorted(_whole_versions(spark, path))
    state.select("sig", "stable_id").distinct().withColumn("version", F.lit(STATE_VERSION)).write.mode("overwrite").parquet(f"{path}/v{(known[-1] if known else 0) + 1:09d}")
    for old in known[:-1]:
        delete_path(spark, f"{path}/v{old:09d}")


def _whole_versions(spark: SparkSession, path: str) -> list[int]:
    if not _exists(spark, path):
        return []
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [x.getPath().getName() for x in where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)]
    return [int(n[1:]) for n in names if n[0] == "v" and n[1:].isdigit() and _exists(spark, f"{path}/{n}/_SUCCESS")]


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def git_revision() -> str | None:
    try:
        return subprocess.run(["git", "rev-parse", "--short", "HEAD"], capture_output=True, text=True, timeout=5, check=True).stdout.strip()
    except (OSError, subprocess.SubprocessError):
        return None


def manifest(settings: Settings, **more) -> dict:
    return {"settings": asdict(settings), "model": settings.embedding_model, "dimensions": settings.embedding_dims, "git": git_revision(), "python": sys.version.split()[0], "platform": platform.platform(), "at": datetime.now(timezone.utc).isoformat(), **more}


def write_manifest(path: str, settings: Settings, **more) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(manifest(settings, **more), ensure_ascii=False, indent=2, default=str), encoding="utf-8")
