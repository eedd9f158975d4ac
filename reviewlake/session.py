"""Session helpers shared by every operator: tables, checkpoints, the shared folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where that is unset."""
    conf = spark.sparkContext.getConf()
    found = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        found = "file://" + tempfile.mkdtemp(prefix="reviewlake-")
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of df at a copy that outlives executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """df marked for broadcast if it has at most `rows` rows; else as it is, for Spark to join as it sees fit."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame) -> DataFrame:
    """df dealt over all cores if it has less input than they could read at once, else as it is.

    Such a table comes from few files or row groups, which Spark cannot split, so that a few tasks would do all the work on
    its texts. What is moved is at most spark.sql.files.maxPartitionBytes a core; a larger table has splits enough.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(2 * cores) if size < cores * split else df


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files that nothing refers to any more, and checkpoints too if
    spark.cleaner.referenceTracking.cleanCheckpoints is set when the session starts; it is off by default."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
