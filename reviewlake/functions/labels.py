"""Cluster labels: coercion, offsets by polarity and refined ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.config import BASES, NOISE, NOISE_OFFSET


def coerce_label(c: Column) -> Column:
    """An integer label; `other`, nan, none, blanks, nulls and what is no whole number become -1."""
    return F.coalesce(F.trim(F.lower(c.cast("string"))).try_cast("int"), F.lit(NOISE))


def base_of(polarity: Column) -> Column:
    known = F.create_map(*[x for k, v in BASES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(known, polarity), F.lit(0))


def label_offset(label: Column, polarity: Column) -> Column:
    return base_of(polarity) + F.when(label == NOISE, F.lit(NOISE_OFFSET)).otherwise(label)


def relabel(df: DataFrame, key: str, polarity: str) -> DataFrame:
    """df with the labels in `key` moved to their polarity's thousand: for tables of representatives and keywords."""
    return df.withColumn(key, label_offset(coerce_label(F.col(key)), F.col(polarity)))


def refined_id(prefix: Column, label: Column) -> Column:
    return prefix * 1000 + F.when(label == NOISE, F.lit(NOISE_OFFSET)).otherwise(label)


def polarity_prefix(cluster: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(2), F.floor(cluster / 1000))).cast("int")
