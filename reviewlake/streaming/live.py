"""Row-local operators on streams: clauses with polarity, windowed counts, and ids that a batch at a time extends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.config import Settings
from reviewlake.functions import text as T
from reviewlake.operators import clusters, polarity
from reviewlake.plans.reviews import clause_rows


def polarized_stream(reviews: DataFrame, settings: Settings, key: str = "review_id", text: str = "review") -> DataFrame:
    """Confident clauses of a stream of reviews; no state."""
    cleaned = reviews.withColumn(text, T.clean(F.col(text))).filter(F.length(text) > 0)
    return polarity.confident(polarity.classify(clause_rows(cleaned, settings, text, key), settings), settings)


def windowed_counts(events: DataFrame, time: str, by: str, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts by window and key; rows later than `late` are left out, closed windows leave the state."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def extend_stable_ids(batch: DataFrame, state_path: str, cluster: str, sig: str) -> DataFrame:
    """For foreachBatch: ids of a batch's clusters, appended to the state; a repeated batch adds nothing."""
    spark = batch.sparkSession
    try:
        state = spark.read.parquet(state_path)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        state = spark.createDataFrame([], "sig string, stable_id long")
    ids = clusters.stable_ids(batch, cluster, sig, state).persist()
    new = ids.select("sig", "stable_id").distinct().filter(F.pmod("stable_id", F.lit(1000)) != 999).join(state, "sig", "left_anti")
    new.write.mode("append").parquet(state_path)
    return ids
