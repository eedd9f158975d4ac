"""Vector functions as column expressions; sums run in double precision."""

from __future__ import annotations

import hashlib
import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def fused_dot(v: Column, q: list[float]) -> Column:
    """The dot product with a fixed vector, left to right, each product added with a single rounding as the SQL's list_inner_product does.

    Sums of equal parts often lie on a threshold, where the last bit tells. Zeros of `q` add nothing and are left out.
    """
    def add(s: Column, c: Column) -> Column:
        x = F.get(v, c["i"]).cast("double")
        return F.when(x.isNotNull() & s.isNotNull(), F.reflect(F.lit("java.lang.Math"), F.lit("fma"), x, c["x"], s).cast("double"))

    used = [(i, x) for i, x in enumerate(q) if x] or [(0, 0.0)]
    return F.aggregate(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(x)).alias("x")) for i, x in used]), F.lit(0.0), add)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalize(v: Column) -> Column:
    n = norm(v) + F.lit(1e-12)
    return F.transform(v, lambda x: x.cast("double") / n)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def euclid(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def hash_embed(tokens: Column, dims: int) -> Column:
    """A vector of length 1 from token counts by bucket of the token's MD5; zeros without tokens."""
    def vector(buckets: Column) -> Column:
        # What removing a bucket takes away is its count: a plain loop over integers, without a lambda for each of them.
        counts = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: (F.size(buckets) - F.size(F.array_remove(buckets, i))).cast("double"))

        def scaled(c: Column) -> Column:
            n = F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))
            return F.element_at(F.transform(F.array(n), lambda m: F.when(m > 0, F.transform(c, lambda x: x / m)).otherwise(c)), 1)

        return F.element_at(F.transform(F.array(counts), scaled), 1)

    # Arrays of one element bind what would otherwise be worked out again for every component.
    buckets = F.transform(tokens, lambda t: F.pmod(F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long"), F.lit(dims)).cast("int"))
    return F.element_at(F.transform(F.array(buckets), vector), 1)


def hash_embed_text(text: str, pattern: str, dims: int) -> list[float]:
    """The vector of a single text, worked out on the driver: for queries, which are then literals of the plan."""
    counts = [0.0] * dims
    for t in re.findall(pattern, text):
        counts[int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % dims] += 1.0
    n = math.sqrt(sum(x * x for x in counts))
    return [x / n for x in counts] if n else counts
