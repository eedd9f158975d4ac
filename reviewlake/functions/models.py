"""Adapters for trained models: any embedder or classifier runs in Arrow batches and is loaded once a worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.config import POLARITIES

#: The models of this worker process by name.
_LOADED: dict[str, Callable] = {}


def loaded(name: str, load: Callable[[], Callable]) -> Callable:
    """The model of that name, loaded at its first use in this process."""
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("there is no text to embed")
    return df


def embedder(name: str, load: Callable[[], Callable], batch: int = 128, unit: bool = True) -> Callable[[DataFrame, str], DataFrame]:
    """embed(df, text) for run_reviews: df with `embedding`. load() gives a function from a list of texts to a matrix.

    A null text is an empty one; `batch` texts are embedded at once; with `unit` vectors have length 1, zeros stay zeros.
    An empty table is refused, as a model cannot tell its number of dimensions without a text.
    """

    def column(text: Column) -> Column:
        import pandas as pd
        from pyspark.sql.functions import pandas_udf

        def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            import numpy as np

            model = loaded(name, load)
            for some in texts:
                given, out = some.fillna("").tolist(), []
                for a in range(0, len(given), batch):
                    x = np.asarray(model(given[a : a + batch]), float)
                    if unit:
                        n = np.sqrt((x * x).sum(axis=1, keepdims=True))
                        x = x / np.where(n > 0, n, 1)
                    out += x.tolist()
                yield pd.Series(out, index=some.index, dtype=object)

        run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return pandas_udf(run, "array<double>")(text)

    return lambda df, text: require_rows(df).withColumn("embedding", column(F.col(text)))


def classifier(name: str, load: Callable[[], Callable], batch: int = 32, lower: bool = True) -> Callable[[DataFrame, str], DataFrame]:
    """classify(df, clause) for run_reviews: df with polarity and confidence.

    load() gives a function from a list of texts to pairs (polarity, confidence). A polarity is lower-cased; another than
    the three known ones, or a null text, is neutral with confidence 0.
    """

    def column(text: Column) -> Column:
        import pandas as pd
        from pyspark.sql.functions import pandas_udf

        def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            model = loaded(name, load)
            for some in texts:
                given, out = [t.lower() if lower and t is not None else t for t in some.tolist()], [("neutral", 0.0)] * len(some)
                at = [i for i, t in enumerate(given) if t is not None]
                for a in range(0, len(at), batch):
                    own = at[a : a + batch]
                    for i, (p, c) in zip(own, model([given[i] for i in own]), strict=True):
                        out[i] = (str(p).lower(), float(c)) if str(p).lower() in POLARITIES else ("neutral", 0.0)
                yield pd.DataFrame(out, columns=["polarity", "confidence"])

        run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
        return pandas_udf(run, "polarity string, confidence double")(text)

    def classify(df: DataFrame, clause: str) -> DataFrame:
        told = df.withColumn("_m", column(F.col(clause)))
        return told.withColumn("polarity", F.col("_m.polarity")).withColumn("confidence", F.col("_m.confidence")).drop("_m")

    return classify
