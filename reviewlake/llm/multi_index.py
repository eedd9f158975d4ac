"""Near-duplicate vectors by an inverted multi-index.

Vectors of length 1 are cut in halves; each half has its own codebook, and pairs of codewords form the product grid. A
vector lives in the cell of its nearest codewords. It also looks into further cells in the order of a multi-sequence
traversal, by the sum of its squared distances to their two codewords, as far as the sum stays within `reach` of its best
one. `reach` is set from links that an exhaustive search finds for a sample, so that the target recall is met. Every pair
met in a cell is verified in double precision.

Cells hold blocks of bounded size, and a block of visitors meets a block of residents in one matrix product. Such a
meeting gives counts and, instead of its pairs, one edge for each linked vector to the smallest vector of its group. So a
group of very many near copies gives few rows.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.arrow_text import arrow_map
from reviewlake.llm.vectors import blocks_met, matrix, numbered_classes, one_length, sample, unit, usable
from reviewlake.operators.graph import connected_components
from reviewlake.session import checkpointed

#: Rows that codebooks are fitted on, at most, and rows whose links set the reach.
FIT_ROWS, PROBE_ROWS = 16_384, 2048
#: Codewords of a half: their square follows the number of vectors, so that a cell holds about CELL_ROWS, from the least to
#: the most; beyond some 130 million vectors cells grow. Fewer codewords mean fewer cells to look into, each a copy.
LEAST_CODEWORDS, MOST_CODEWORDS, CELL_ROWS, ROUNDS = 16, 1024, 128, 12
#: Vectors in a block.
BLOCK = 1024
TARGET_RECALL = 0.98


def codebook(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means centres of the rows of x; at most as many as there are distinct rows."""
    r = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x
    centres = x[r.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        near = ((centres**2).sum(1)[None, :] - 2 * x @ centres.T).argmin(axis=1)
        order = np.argsort(near, kind="stable")
        own, first = np.unique(near[order], return_index=True)
        centres = x[r.integers(len(x), size=k)]
        centres[own] = np.add.reduceat(x[order], first, axis=0) / np.diff(np.append(first, len(x)))[:, None]
    return centres


def codewords_for(total: int) -> int:
    return int(min(MOST_CODEWORDS, max(LEAST_CODEWORDS, round((total / CELL_ROWS) ** 0.5))))


def distances(x: np.ndarray, books) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of both halves of each row to the codewords of their books."""
    h = x.shape[1] // 2
    return tuple(((p**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * p @ b.T) for p, b in ((x[:, :h], books[0]), (x[:, h:], books[1])))


def traverse(first: np.ndarray, second: np.ndarray, reach: float):
    """Cells in the order of first[i] + second[j], up to `reach` over the smallest: the multi-sequence algorithm."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    best = first[a[0]] + second[b[0]]
    heap, seen = [(best, 0, 0)], {(0, 0)}
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > best + reach:
            return
        yield int(a[i]), int(b[j])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (first[a[p]] + second[b[q]], p, q))


def _linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    return x @ y.T >= threshold


def _need(x: np.ndarray, y: np.ndarray, books) -> np.ndarray:
    """For each pair of rows of x and y how far over its best sum the one that needs less must look to see the other's home."""
    out, at = None, np.arange(len(x))
    for p, q in ((x, y), (y, x)):
        f, s = distances(p, books)
        qf, qs = distances(q, books)
        own = f[at, qf.argmin(1)] + s[at, qs.argmin(1)] - f.min(1) - s.min(1)
        out = own if out is None else np.minimum(out, own)
    return out


def _reach(vectors: DataFrame, books, threshold: float, total: int, dims: int) -> float:
    """How far over its best sum a vector must look to meet its links, where one of two linked vectors must see the other:
    what TARGET_RECALL of made-up pairs need whose cosine is the threshold, and at least what any link of a sample needs."""
    spark = vectors.sparkSession
    got = sample(vectors, "v", PROBE_ROWS, total).toArrow()
    probes = unit(matrix(got.column("v").combine_chunks()))
    shared = spark.sparkContext.broadcast((probes, got.column("uid").to_numpy(), books))

    def run(batches):
        import pyarrow as pa

        x, uids, books = shared.value
        for batch in batches:
            y = unit(matrix(batch.column(1)))
            if not len(y) or not len(x):
                continue
            i, j = np.nonzero(_linked(x, y, threshold) & (uids[:, None] != batch.column(0).to_numpy()[None, :]))
            most = max((float(_need(x[i[a : a + BLOCK]], y[j[a : a + BLOCK]], books).max()) for a in range(0, len(i), BLOCK)), default=None)
            if most is not None:
                yield pa.RecordBatch.from_arrays([pa.array([most], pa.float64())], names=["x"])

    found = arrow_map(vectors.select("uid", "v"), run, "x double").agg(F.max("x").alias("top")).first()
    if not len(probes):
        return 0.0
    r = np.random.default_rng(5)
    noise = r.normal(size=probes.shape)
    noise = unit(noise - (noise * probes).sum(1, keepdims=True) * probes)
    cosine = min(1.0, threshold)
    mates = cosine * probes + np.sqrt(max(0.0, 1 - cosine**2)) * noise
    made_up = float(np.quantile(_need(probes, mates, books), TARGET_RECALL))
    return max(found["top"] or 0.0, made_up) + 1e-6


def _meet(x, xi, xw, y, yi, yw, xcell_of_y, threshold: float):
    """What a block of visitors x and one of residents y tell: (id, links, edge to) rows.

    xcell_of_y[i, j]: whether resident j, as a visitor, looks into the home of visitor i; then that meeting counts j's
    link. A visitor's own row, met at home, is left out.
    """
    hit = _linked(x, y, threshold) & (xi[:, None] != yi[None, :])
    if not hit.any():
        return None
    links_x = hit @ yw
    links_y = (hit & ~xcell_of_y).T @ xw
    low_x = np.where(hit.any(1), np.minimum(xi, np.where(hit, yi[None, :], np.iinfo(np.int64).max).min(1)), xi)
    low_y = yi.copy()
    while True:
        new_y = np.minimum(low_y, np.where(hit, low_x[:, None], np.iinfo(np.int64).max).min(0))
        new_x = np.minimum(low_x, np.where(hit, new_y[None, :], np.iinfo(np.int64).max).min(1))
        if np.array_equal(new_x, low_x) and np.array_equal(new_y, low_y):
            break
        low_x, low_y = new_x, new_y
    ids = np.concatenate([xi, yi])
    links = np.concatenate([links_x, links_y])
    low = np.concatenate([low_x, low_y])
    keep = (links > 0) | (low < ids)
    return ids[keep], links[keep], low[keep]


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9, codewords: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of df.

    Equal vectors are one class and are compared once. Vectors that are null, empty, zero or hold a null or non-finite
    component, and vectors of another length than most, link with nothing; so does a row with a null key. Every other row is
    a vector of its own, so rows that repeat a key count each, whether their vectors are equal or not. An empty table gives
    an empty one; other columns of df are not read.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    good, dims = one_length(rows.filter(usable(F.col("v")) & F.col("id").isNotNull()), "v")
    classes = numbered_classes(good.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("w")))
    total = classes.count()
    codewords = codewords or codewords_for(total)
    fitted = unit(matrix(sample(classes, "v", FIT_ROWS, total).toArrow().column("v").combine_chunks()))
    h = dims // 2
    books = (codebook(fitted[:, :h], codewords, 1), codebook(fitted[:, h:], codewords, 2)) if len(fitted) else (np.zeros((1, h)), np.zeros((1, dims - h)))
    reach = _reach(classes, books, threshold, total, dims) if total else 0.0
    shared = df.sparkSession.sparkContext.broadcast((books, reach))
    k2 = len(books[1])

    def visits(batches):
        import pyarrow as pa

        books, reach = shared.value
        for batch in batches:
            x = unit(matrix(batch.column(2)))
            if not len(x):
                continue
            f, s = distances(x, books)
            cells = [[i * k2 + j for i, j in traverse(f[n], s[n], reach)] for n in range(len(x))]
            home = f.argmin(1) * k2 + s.argmin(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(home, pa.int32()), pa.array(cells, pa.list_(pa.int32()))], names=["uid", "w", "v", "home", "cells"])

    kind = classes.schema["v"].dataType.simpleString()
    placed = checkpointed(arrow_map(classes.select("uid", "w", "v"), visits, f"uid long, w long, v {kind}, home int, cells array<int>"))
    residents = placed.select("uid", "w", "v", "home", F.col("home").alias("cell"))
    visitors = placed.select("uid", "w", "v", "home", F.explode("cells").alias("cell"))
    sides = ["uid", "w", "home", "v"]
    meetings = blocks_met(visitors, residents, "cell", sides, sides, BLOCK).select("a", "b")

    def meet(batches):
        import pyarrow as pa

        books, reach = shared.value
        for batch in batches:
            for sides in zip(batch.column(0), batch.column(1), strict=True):
                (xi, xw, xh, x), (yi, yw, yh, y) = ((b.values.field("uid").to_numpy(), b.values.field("w").to_numpy(), b.values.field("home").to_numpy(), unit(matrix(b.values.field("v")))) for b in sides)
                f, s = distances(y, books)
                back = (f[:, xh // k2] + s[:, xh % k2]).T <= (f.min(1) + s.min(1) + reach)[None, :]
                found = _meet(x, xi, xw, y, yi, yw, back, threshold)
                if found is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["uid", "links", "low"])

    # Pairs of a vector and the smallest of its group are made distinct by tasks before they are sent.
    met = checkpointed(arrow_map(meetings, meet, "uid long, links long, low long").groupBy("uid", "low").agg(F.sum("links").alias("links")))
    placed_in = connected_components(met.filter("uid <> low"), "uid", "low")
    links = met.groupBy("uid").agg(F.sum("links").alias("links"))
    grouped = classes.join(placed_in, classes["uid"] == placed_in["node"], "left").select("uid", "v", "w", "id", F.coalesce("component", "uid").alias("group"))
    # A group goes by its smallest key, not by the number of the class that stands for it.
    lowest = grouped.groupBy("group").agg(F.min("id").alias("component_id"))
    sums = grouped.join(links, "uid", "left").join(lowest, "group").select("v", (F.coalesce("links", F.lit(0).cast("long")) + F.col("w") - 1).alias("n_links"), "component_id")
    counted = rows.withColumn("_v", F.when(F.col("id").isNotNull(), F.col("v"))).drop("v")
    out = counted.join(sums, counted["_v"] == sums["v"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op10_multi_index(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all embeddings from a cosine of 0.9 on."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
