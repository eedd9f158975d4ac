"""Nearest neighbours by a forest of random-projection trees.

Trees split a bounded sample by hyperplanes between two of its vectors, at the median; all rows then go down every tree to
a leaf. A query searches the whole forest through one shared priority queue: the nodes of all trees wait in one heap by
the smallest margin on their way from the root, and the best is opened next, until as many leaves are reached as the wanted
recall needs. That number is measured: for a sample of the queries an exhaustive search gives the true neighbours, and the
place in the queue at which a query meets each of them.

Leaves hold blocks of bounded size, and so do the queries that reach them. A block of queries meets a block of vectors in
one matrix product, which gives each query's best few of that block; these are merged by query and scored exactly.
"""

from __future__ import annotations

import heapq
import logging

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reviewlake.llm.arrow_text import arrow_map
from reviewlake.llm.vectors import blocks_met, matrix, numbered_classes, one_length, sample, unit, usable
from reviewlake.session import checkpointed

log = logging.getLogger(__name__)
#: Rows that trees are fitted on, queries that the number of leaves is measured with, and rows in a block, at most.
FIT_ROWS, PROBE_ROWS, BLOCK = 65_536, 256, 1024
#: Rows of the whole table in a leaf, and rows of the sample that a leaf needs at least: the number of leaves follows the
#: table up to some 500,000 vectors, and leaves grow beyond. Leaves are made larger, too, until a query opens OPENED of them
#: at most, as it is sent to each: where vectors have no groups the recall needs a fixed share of all leaves.
TREES, LEAF_ROWS, LEAST_ROWS, OPENED, RECALL = 4, 128, 16, 64, 0.97
#: Rows that a task gathers before it keeps only the best of each query.
GATHERED = 1 << 18


class Tree:
    """Nodes in arrays: a unit direction and an offset, and two children; a child below 0 is leaf -1 - child."""

    def __init__(self, x: np.ndarray, leaf_rows: int, seed: int):
        r = np.random.default_rng(seed)
        self.direction, self.offset, self.children, self.leaves = [], [], [], 0
        self.root = self._grow(x, np.arange(len(x)), leaf_rows, r)
        self.direction = np.array(self.direction).reshape(len(self.offset), x.shape[1])
        self.offset = np.array(self.offset)

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, x, own, leaf_rows, r) -> int:
        if len(own) <= leaf_rows:
            return self._leaf()
        for _ in range(8):
            a, b = r.choice(own, 2, replace=False)
            d = x[a] - x[b]
            if d.any():
                break
        else:
            d = r.normal(size=x.shape[1])
        d = d / np.sqrt((d * d).sum())
        side = x[own] @ d
        cut = float(np.median(side))
        right = side > cut
        if not right.any() or right.all():
            return self._leaf()
        at = len(self.offset)
        self.direction.append(d)
        self.offset.append(cut)
        self.children.append(None)
        self.children[at] = (self._grow(x, own[~right], leaf_rows, r), self._grow(x, own[right], leaf_rows, r))
        return at

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.direction.T - self.offset if len(self.offset) else np.zeros((len(x), 0))

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.full(len(x), self.root)
        m = self.margins(x)
        while (out >= 0).any():
            at = np.flatnonzero(out >= 0)
            kids = np.array([self.children[n] for n in out[at]])
            out[at] = kids[np.arange(len(at)), (m[at, out[at]] > 0).astype(int)]
        return -1 - out


class Forest:
    def __init__(self, x: np.ndarray, trees: int, leaf_rows: int):
        self.trees = [Tree(x, leaf_rows, 31 + t) for t in range(trees)]
        self.base = np.cumsum([0, *(t.leaves for t in self.trees)])

    def place(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each row in each tree, numbered through the forest."""
        return np.stack([t.place(x) + b for t, b in zip(self.trees, self.base, strict=False)], 1)

    def search(self, margins: list[np.ndarray], most: int):
        """Leaves in the order in which the shared queue gives them; margins: the query's, at each node of each tree."""
        heap = [(-np.inf, t, tree.root) for t, tree in enumerate(self.trees)]
        heapq.heapify(heap)
        while heap and most > 0:
            bound, t, node = heapq.heappop(heap)
            if node < 0:
                most -= 1
                yield int(self.base[t]) - 1 - node
                continue
            m = margins[t][node]
            low, high = self.trees[t].children[node]
            # The queue is a min-heap, so it holds the negative of the smallest margin met.
            heapq.heappush(heap, (max(bound, m), t, low))
            heapq.heappush(heap, (max(bound, -m), t, high))


def _best(scores: np.ndarray, ids: np.ndarray, k: int):
    """Columns of the k best scores of each row, equal ones by smaller id."""
    k = min(k, scores.shape[1])
    order = np.argsort(ids, kind="stable")
    s = scores[:, order]
    if s.shape[1] > k:
        cut = -np.partition(-s, k - 1, axis=1)[:, k - 1 : k]
        s = np.where(s >= cut, s, -np.inf)
    return order[np.argsort(-s, axis=1, kind="stable")[:, :k]]


def _merged(found: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("q").orderBy(F.desc("score"), "id", "uid")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _true_neighbours(classes: DataFrame, queries: DataFrame, n_queries: int, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(vectors of a sample of the queries, the vectors of each one's true neighbours) by an exhaustive search."""
    spark = classes.sparkSession
    got = sample(queries, "v", PROBE_ROWS, n_queries).toArrow()
    x, own = unit(matrix(got.column("v").combine_chunks())), got.column("key").to_numpy()
    shared = spark.sparkContext.broadcast((x, own))

    def run(batches):
        import pyarrow as pa

        x, own = shared.value
        for batch in batches:
            y = unit(matrix(batch.column(2)))
            if not len(y) or not len(x):
                continue
            uids, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            s = np.where(own[:, None] == ids[None, :], -np.inf, x @ y.T)
            at = _best(s, ids, k)
            q, scores, at = np.repeat(np.arange(len(x)), at.shape[1]), np.take_along_axis(s, at, 1).ravel(), at.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(uids[at]), pa.array(ids[at]), pa.array(scores), pa.array(y[at].tolist(), pa.list_(pa.float64()))], names=["q", "uid", "id", "score", "y"])

    # PROBE_ROWS times k rows at most reach the driver.
    true = _merged(arrow_map(classes.select("uid", "id", "v"), run, "q long, uid long, id long, score double, y array<double>"), k).select("q", "y").collect()
    mates: list[list] = [[] for _ in range(len(x))]
    for row in true:
        mates[row["q"]].append(row["y"])
    return x, [np.array(m).reshape(len(m), x.shape[1]) for m in mates]


def _leaves_needed(forest: Forest, x: np.ndarray, mates: list[np.ndarray], recall: float) -> int:
    """The leaves a query has to reach, so that `recall` of the true neighbours of a sample of queries are met."""
    every = int(forest.base[-1])
    margins = [t.margins(x) for t in forest.trees]
    places = []
    for q, y in enumerate(mates):
        left = [set(leaves) for leaves in forest.place(y).tolist()] if len(y) else []
        # Each neighbour is met with the first of its leaves; the search ends with the last of them.
        for n, leaf in enumerate(forest.search([m[q] for m in margins], every if left else 0)):
            met = [m for m in left if leaf in m]
            places += [n + 1] * len(met)
            left = [m for m in left if leaf not in m]
            if not left:
                break
    return int(np.ceil(np.quantile(places, recall))) if places else every


def _fitted(x: np.ndarray, total: int, trees: int, probes: np.ndarray, mates: list[np.ndarray], recall: float) -> tuple[Forest, int]:
    """(forest, leaves a query opens): the smallest leaves, by doubling, with which OPENED leaves give the recall."""
    rows = LEAF_ROWS
    while True:
        forest = Forest(x, trees, max(min(LEAST_ROWS, rows), rows * len(x) // total))
        most = _leaves_needed(forest, probes, mates, recall)
        if most <= OPENED or forest.base[-1] <= OPENED:
            return forest, most
        rows *= 2


def nearest(df: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of df by cosine, found for each row of queries but itself.

    Both tables hold key and vector; a query is kept from itself, and from other rows of its key, by that key. Equal scores
    go to the smaller key. Vectors that are null, empty, zero or hold a null or non-finite component, those of another
    length than most of df, and rows with a null key take no part. Equal vectors are one class, of which the k + 1 smallest
    keys can matter. A row that repeats key and vector counts once; rows that repeat a key with other vectors are candidates
    and queries each, so a key can come more than once. Empty tables give an empty result.
    """
    spark = df.sparkSession
    fine = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).filter(usable(F.col("v")) & F.col("id").isNotNull())
    fine, dims = one_length(fine, "v")
    # The k + 1 smallest keys of a class, by numbering within it: no group is gathered.
    few = fine.distinct().withColumn("n", F.row_number().over(W.partitionBy("v").orderBy("id"))).filter(F.col("n") <= k + 1)
    classes = numbered_classes(few.groupBy("v").agg(F.min("id").alias("id"), F.array_sort(F.collect_list("id")).alias("ids")).select("id", "v", "ids"))
    asked = queries.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("v")).filter(usable(F.col("v")) & F.col("key").isNotNull() & (F.size("v") == dims))
    asked = checkpointed(asked.distinct().withColumn("q", F.monotonically_increasing_id()))
    total, n_queries = classes.count(), asked.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total or not n_queries:
        return empty
    fitted = unit(matrix(sample(classes, "v", FIT_ROWS, total).toArrow().column("v").combine_chunks()))
    forest, most = _fitted(fitted, total, trees, *_true_neighbours(classes, asked, n_queries, k), recall)
    log.info("%d classes, %d leaves, %d opened for a query", total, int(forest.base[-1]), most)
    shared = spark.sparkContext.broadcast(forest)
    kind = classes.schema["v"].dataType.simpleString()

    def index(batches):
        import pyarrow as pa

        for batch in batches:
            x = unit(matrix(batch.column(2)))
            leaves = shared.value.place(x).tolist() if len(x) else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int32()))], names=["uid", "id", "v", "leaves"])

    def route(batches):
        import pyarrow as pa

        forest = shared.value
        for batch in batches:
            x = unit(matrix(batch.column(1)))
            margins = [t.margins(x) for t in forest.trees]
            leaves = [list(forest.search([m[n] for m in margins], most)) for n in range(len(x))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaves, pa.list_(pa.int32()))], names=["q", "v", "leaves"])

    indexed = checkpointed(arrow_map(classes.select("uid", "id", "v"), index, f"uid long, id long, v {kind}, leaves array<int>")).select("uid", "id", "v", F.explode("leaves").alias("leaf"))
    routed = checkpointed(arrow_map(asked.select("q", "v"), route, f"q long, v {kind}, leaves array<int>")).select("q", "v", F.explode("leaves").alias("leaf"))
    meetings = blocks_met(routed, indexed, "leaf", ["q", "v"], ["uid", "id", "v"], BLOCK).select("a", "b")

    def meet(batches):
        import pyarrow as pa

        held, size = [], 0

        def best():
            q, uids, ids, scores = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((uids, q))
            new = np.ones(len(q), bool)
            new[1:] = (q[order][1:] != q[order][:-1]) | (uids[order][1:] != uids[order][:-1])
            # A class met in several trees is kept once; its scores differ by rounding alone.
            q, uids, ids, scores = (c[order[new]] for c in (q, uids, ids, scores))
            order = np.lexsort((uids, ids, -scores, q))
            first = np.flatnonzero(np.concatenate([[True], q[order][1:] != q[order][:-1]]))
            rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
            return [c[order[rank < k + 1]] for c in (q, uids, ids, scores)]

        def told(found):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["q", "uid", "id", "score"])

        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1), strict=True):
                q, uids, ids = a.values.field("q").to_numpy(), b.values.field("uid").to_numpy(), b.values.field("id").to_numpy()
                s = unit(matrix(a.values.field("v"))) @ unit(matrix(b.values.field("v"))).T
                # One more than asked for: a query's own class may hold nothing but itself.
                at = _best(s, ids, k + 1)
                held.append((np.repeat(q, at.shape[1]), uids[at.ravel()], ids[at.ravel()], np.take_along_axis(s, at, 1).ravel()))
                size += at.size
                if size >= GATHERED:
                    held = [best()]
                    size = len(held[0][0])
                    if 2 * size > GATHERED:
                        yield told(held[0])
                        held, size = [], 0
        if held:
            yield told(best())

    # A class met in several trees comes with one score, but for rounding; the exact one follows below.
    found = arrow_map(meetings, meet, "q long, uid long, id long, score double").groupBy("q", "uid", "id").agg(F.max("score").alias("score"))
    top = _merged(found, k + 1).select("q", "uid")
    both = top.join(classes, "uid").select("q", "ids", "uid", F.col("v").alias("y")).join(asked.select("q", "key", F.col("v").alias("x")), "q")

    def dot(p, r):
        return F.aggregate(F.zip_with(p, r, lambda i, j: i.cast("double") * j.cast("double")), F.lit(0.0), lambda acc, i: acc + i)

    def scaled(v):
        largest = F.array_max(F.transform(v, lambda i: F.abs(i.cast("double"))))
        return F.transform(v, lambda i: i.cast("double") / largest)

    exact = both.select("q", "key", "uid", "ids", scaled(F.col("x")).alias("x"), scaled(F.col("y")).alias("y"))
    score = dot(F.col("x"), F.col("y")) / (F.sqrt(dot(F.col("x"), F.col("x"))) * F.sqrt(dot(F.col("y"), F.col("y"))))
    rows = exact.select("q", "key", "uid", score.alias("score"), F.explode("ids").alias("id")).filter("id <> key")
    return _merged(rows, k).select(F.col("key").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def op1_projection_forest(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest embeddings of each whose vec_id is divisible by 50."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(rows, rows.filter(F.col("vec_id") % 50 == 0), 5)
