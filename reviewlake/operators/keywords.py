"""Keywords of clusters by averaged TF-IDF, a fixed-size sample and a vector-based variant."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlake.functions import text as T
from reviewlake.functions import vectors as V
from reviewlake.session import checkpointed


def tfidf_keywords(df: DataFrame, cluster: str, doc: str, text: str, pattern: str, stopwords: Sequence[str], top: int = 3, normalize=None) -> DataFrame:
    """(cluster, rank, term, score): raw counts times ln((1 + n) / (1 + df)) + 1, each document of length 1, averaged
    over a cluster's documents, those without a term included. Ties by the later term.

    A row is a document. Its terms are counted within the row and once: a checkpoint holds the counts, from which document
    frequencies and weights are taken. `normalize` may give other tokens
    of a text than the pattern's, as a morphological analyser would.
    """
    found = T.tokens(F.lower(text), pattern) if normalize is None else normalize(F.col(text))
    if stopwords:
        found = F.filter(found, lambda t: ~t.isin(*stopwords))
    terms = checkpointed(df.select(cluster, doc, T.counted(found).alias("_t")))
    docs = terms.groupBy(cluster).agg(F.count("*").alias("_docs"))
    n = terms.agg(F.count("*").alias("_n"))
    tf = terms.select(cluster, doc, F.explode("_t").alias("_x")).select(cluster, doc, "_x.term", F.col("_x.n").alias("_tf"))
    idf = tf.groupBy("term").agg(F.count("*").alias("_df")).crossJoin(F.broadcast(n)).select("term", (F.log((1.0 + F.col("_n")) / (1.0 + F.col("_df"))) + 1).alias("_idf"))
    w = tf.join(idf, "term").withColumn("_w", F.col("_tf") * F.col("_idf"))
    # One exchange by document: its rows are few, as are the terms of a text.
    w = w.withColumn("_l", F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(doc))))
    score = w.groupBy(cluster, "term").agg(F.sum(F.col("_w") / F.col("_l")).alias("_s")).join(docs, cluster).select(cluster, "term", (F.col("_s") / F.col("_docs")).alias("score"))
    order = W.partitionBy(cluster).orderBy(F.desc(F.round("score", 9)), F.desc("term"))
    return score.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def sample_docs(df: DataFrame, key: str, group: str | None, most: int, seed: int) -> DataFrame:
    """`most` rows (of each group) at most, by the MD5 of seed and key."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    if group is None:
        return df.orderBy(h, key).limit(most)
    return df.withColumn("_r", F.row_number().over(W.partitionBy(group).orderBy(h, key))).filter(F.col("_r") <= most).drop("_r")


def keybert_like(df: DataFrame, cluster: str, key: str, text: str, pattern: str, dims: int, top: int = 3, most: int = 50, seed: int = 0, multiplier: int = 2, normalize=None) -> DataFrame:
    """(cluster, term, score): terms of a sample whose vectors lie nearest to the cluster's mean vector.

    `top` times `multiplier` candidates are taken by cosine, and of them the `top` whose similarities to each other sum up to
    least; equal sums go to the nearer terms. With a multiplier of 1 these are the nearest terms alone.
    """
    found = T.tokens(F.lower(text), pattern) if normalize is None else normalize(F.col(text))
    some = sample_docs(df, key, cluster, most, seed).select(cluster, key, found.alias("_t"))
    mean = _means(some, cluster, dims)
    terms = some.select(cluster, F.explode("_t").alias("term")).distinct().withColumn("_e", V.hash_embed(F.array("term"), dims))
    scored = terms.join(mean, cluster).withColumn("score", V.dot(F.col("_e"), F.col("_c")))
    near = scored.withColumn("_r", F.row_number().over(W.partitionBy(cluster).orderBy(F.desc(F.round("score", 9)), "term"))).filter(F.col("_r") <= top * multiplier)
    listed = near.groupBy(cluster).agg(F.array_sort(F.collect_list(F.struct("_r", "term", "score", "_e"))).alias("_l"))
    sums = []
    for n in range(top * multiplier + 1):
        for chosen in combinations(range(n), min(top, n)):
            pairs = [V.dot(F.get("_l", i)["_e"], F.get("_l", j)["_e"]) for i, j in combinations(chosen, 2)]
            total = F.lit(0.0)
            for p in pairs:
                total = total + p
            sums.append((n, chosen, total))
    best = F.lit(None).cast("array<int>")
    for n in range(1, top * multiplier + 1):
        own = [F.struct(F.round(t, 9).alias("s"), F.array(*map(F.lit, c)).alias("c")) for m, c, t in sums if m == n]
        best = F.when(F.size("_l") == n, F.array_min(F.array(*own))["c"]).otherwise(best)
    picked = listed.select(cluster, "_l", F.explode(best).alias("_i")).select(cluster, F.get("_l", F.col("_i")).alias("_x"))
    return picked.select(cluster, F.col("_x.term").alias("term"), F.col("_x.score").alias("score"))


def _means(some: DataFrame, cluster: str, dims: int) -> DataFrame:
    """(cluster, _c): the mean of the vectors of token lists."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    rows = some.select(cluster, array_to_vector(V.hash_embed(F.col("_t"), dims)).alias("_v"))
    return rows.groupBy(cluster).agg(Summarizer.mean(F.col("_v")).alias("_m")).select(cluster, vector_to_array("_m").alias("_c"))
