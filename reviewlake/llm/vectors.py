"""What the two vector searches share: clean vectors, blobs of many vectors in one row, and bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """Whether a vector takes part: not null or empty, without null, NaN or infinite components, and not all zeros."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def matrix(column) -> np.ndarray:
    """A pyarrow list column as a matrix of doubles; all rows have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. Each row is first divided by its largest part, so that no square overflows or vanishes."""
    if not x.size:
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sample(df: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """About `rows` rows at most by a hash of the key, the same on each run: a bounded sample to fit an index on."""
    share = min(1.0, 0.97 * rows / max(total, 1))
    return df.filter(F.pmod(F.xxhash64(F.col(key), F.lit(77)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).limit(rows)


def one_length(df: DataFrame, v: str) -> tuple[DataFrame, int]:
    """The rows whose vectors have the commonest length, and that length; vectors of another length cannot be compared."""
    found = df.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = found["d"] if found else 0
    return df.filter(F.size(v) == d), d


def blocks_met(a: DataFrame, b: DataFrame, cell: str, columns_a: list[str], columns_b: list[str], block: int) -> DataFrame:
    """(cell, a, b): every block of a's rows of a cell beside every block of b's; blocks hold about `block` rows.

    Rows fall into blocks by a hash of their first column. The key of a meeting is the cell and both blocks, so the meetings
    of a cell with very many rows go to many tasks, and each side is sent once to where it meets the other. Cells that only
    one side has are left out.
    """
    from reviewlake.session import checkpointed, small

    parts = lambda d, name: d.groupBy(cell).agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    sizes = small(checkpointed(parts(a, "_na").join(parts(b, "_nb"), cell)))

    def packed(d: DataFrame, columns: list[str], own: str, own_n: str, other: str, other_n: str, name: str) -> DataFrame:
        rows = d.join(sizes, cell).withColumn(own, F.pmod(F.xxhash64(columns[0]), F.col(own_n)).cast("int"))
        rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
        return rows.groupBy(cell, "_pa", "_pb").agg(F.collect_list(F.struct(*columns)).alias(name))

    left, right = packed(a, columns_a, "_pa", "_na", "_pb", "_nb", "a"), packed(b, columns_b, "_pb", "_nb", "_pa", "_na", "b")
    return left.join(right, [cell, "_pa", "_pb"]).select(cell, "a", "b")


def numbered_classes(rows: DataFrame, v: str = "v") -> DataFrame:
    """rows, one for each vector, with `uid`, a number of its own; fixed by a checkpoint, so it is read as it was given."""
    from reviewlake.session import checkpointed

    return checkpointed(rows.withColumn("uid", F.monotonically_increasing_id()))
