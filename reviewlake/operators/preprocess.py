"""Reviews to rows with ids: cleaning, first-wins deduplication and gapless numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlake.functions import text as T
from reviewlake.session import checkpointed


def dedupe_first(df: DataFrame, by: str, order: str) -> DataFrame:
    """The first row of each value by `order`; aggregated by maps first, so a value in very many rows is no burden."""
    rest = [c for c in df.columns if c != by]
    first = df.groupBy(by).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r"))
    return first.select(*[F.col(by) if c == by else F.col(f"_r.{c}").alias(c) for c in df.columns])


def _before(c: str, rows) -> Column:
    """The sum of c over the rows before each in its window."""
    return F.coalesce(F.sum(c).over(rows.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))


def numbered(df: DataFrame, order: str, name: str = "row_no", weight: Column | None = None) -> DataFrame:
    """Gapless numbers from 0 by `order`: ranges are numbered each on its own, and offset by the rows before them.

    With `weight` a row takes so many numbers, of which it gets the first. The ranges are drawn from a sample, so they are
    fixed by a checkpoint before they are used twice.
    """
    ranged = checkpointed(df.withColumn("_w", F.lit(1) if weight is None else weight).repartitionByRange(order).withColumn("_p", F.spark_partition_id()))
    sizes = ranged.groupBy("_p").agg(F.sum("_w").alias("_n"))
    begins = sizes.select("_p", _before("_n", W.orderBy("_p")).alias("_b"))
    inside = ranged.withColumn("_i", _before("_w", W.partitionBy("_p").orderBy(order)))
    return inside.join(F.broadcast(begins), "_p").withColumn(name, F.col("_b") + F.col("_i")).drop("_p", "_b", "_i", "_w")


def preprocess(df: DataFrame, order: str, text: str = "review") -> DataFrame:
    """Cleaned text, the first of equal texts, non-empty ones only."""
    cleaned = df.withColumn(text, T.clean(F.col(text))).withColumn("_n", F.length(text))
    # The length goes through the aggregate: a filter on the text itself would be moved to the scan, and clean it twice.
    return dedupe_first(cleaned, text, order).filter("_n > 0").drop("_n")


def with_review_id(df: DataFrame, order: str, name: str = "review_id") -> DataFrame:
    """review_id as text: the column if there is one, else the position."""
    if name in df.columns:
        return df.withColumn(name, F.col(name).cast("string"))
    return numbered(df, order, name).withColumn(name, F.col(name).cast("string"))


def sentence_rows(df: DataFrame, parts: Column, *keep: str, at: str = "pos", name: str = "sentence") -> DataFrame:
    return df.select(*keep, F.posexplode(parts).alias(at, name))
