"""Polarity of clauses: a lexicon classifier by default, any model through the same columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.config import POLARITIES, LanguagePack, Settings


def lexicon_polarity(clause: Column, pack: LanguagePack) -> tuple[Column, Column]:
    """(polarity, confidence) from counts of positive and negative words: the larger one wins, a tie is neutral.

    Words are runs of letters and digits; they count if they are a word of the pack, or begin with one if it lists stems.
    confidence is (1 + |difference| / (1 + sum)) / 2 for a winner and 1 / (1 + sum) for a tie.
    """
    words = F.split(F.lower(clause), r"[^\p{L}\p{N}]+")
    counts = lambda own: (lambda w: w.rlike("^(" + "|".join(own) + ")")) if pack.stems else (lambda w: w.isin(*own))
    count = lambda own: F.size(F.filter(words, counts(own)))
    p, n = count(pack.positive), count(pack.negative)
    polarity = F.when(p > n, "positive").when(n > p, "negative").otherwise("neutral")
    confidence = F.when(p == n, 1.0 / (1 + p + n)).otherwise((1 + F.abs(p - n) / (1 + p + n)) / 2)
    return polarity, confidence


def classify(df: DataFrame, settings: Settings, clause: str = "clause", model=None) -> DataFrame:
    """df with polarity and confidence. model(df, clause) may give them instead, as an Arrow function would."""
    if model is not None:
        return model(df, clause)
    polarity, confidence = lexicon_polarity(F.col(clause), settings.language)
    return df.withColumn("polarity", polarity).withColumn("confidence", confidence)


def confident(df: DataFrame, settings: Settings) -> DataFrame:
    return df.filter(F.col("polarity").isin(*POLARITIES) & (F.col("confidence") >= settings.confidence))
