"""Clusters of vectors: centroids, representatives, merging, facets, silhouettes, names and persistent ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlake.config import NOISE
from reviewlake.functions import text as T
from reviewlake.functions import vectors as V
from reviewlake.functions.labels import polarity_prefix
from reviewlake.operators import pairs
from reviewlake.operators.graph import connected_components
from reviewlake.operators.preprocess import numbered
from reviewlake.session import checkpointed, small


def centroids(df: DataFrame, cluster: str, vector: str, unit: bool = False) -> DataFrame:
    """(cluster, centroid, n): the mean vector of each cluster but noise, by vectors of sums that tasks make first."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    rows = df.filter(F.col(cluster) != NOISE).select(cluster, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("_v"))
    means = rows.groupBy(cluster).agg(Summarizer.mean(F.col("_v")).alias("_m"), F.count("*").alias("n"))
    out = means.select(cluster, vector_to_array("_m").alias("centroid"), "n")
    return out.withColumn("centroid", V.normalize(F.col("centroid"))) if unit else out


def representatives(df: DataFrame, cluster: str, vector: str, order: str, top: int = 3) -> DataFrame:
    """The `top` rows nearest to their cluster's centre, with dist and rank; ties by `order`."""
    near = df.join(centroids(df, cluster, vector), cluster).withColumn("dist", V.euclid(F.col(vector), F.col("centroid")))
    near = near.withColumn("rank", F.row_number().over(W.partitionBy(cluster).orderBy(F.round("dist", 9), order)))
    return near.filter(F.col("rank") <= top).drop("centroid", "n")


def merge_candidates(items: DataFrame, key: str, vector: str, threshold: float | Column, facet: str | None = None) -> DataFrame:
    """Pairs cid1 < cid2 with cosine at the threshold, of equal facet if one is given. Items are clusters: few."""
    a, b = items.alias("a"), items.alias("b")
    on = F.col(f"a.{key}") < F.col(f"b.{key}")
    if facet:
        on = on & (F.col(f"a.{facet}") == F.col(f"b.{facet}"))
    sims = a.join(b, on).select(F.col(f"a.{key}").alias("cid1"), F.col(f"b.{key}").alias("cid2"), V.cosine(F.col(f"a.{vector}"), F.col(f"b.{vector}")).alias("sim"))
    return sims.filter(F.col("sim") >= threshold)


def dynamic_threshold(sims: DataFrame, percent: float, sim: str = "sim") -> DataFrame:
    """The linear percentile of all pairs' similarities; 0.999 without pairs."""
    return sims.agg(F.coalesce(F.percentile(sim, F.lit(percent / 100.0)), F.lit(0.999)).alias("threshold"))


def merge_map(items: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """(old, new): clusters linked by pairs get one new label; new labels count components by first appearance."""
    placed = connected_components(pairs, "cid1", "cid2")
    both = checkpointed(items.select(F.col(key).alias("old")).join(placed, F.col("old") == F.col("node"), "left").select("old", F.coalesce("component", "old").alias("root")))
    # Roots are numbered range by range, not in one task.
    numbers = numbered(both.select("root").distinct(), "root", "new").withColumn("new", F.col("new").cast("int"))
    return both.join(numbers, "root").select("old", "new")


def apply_map(df: DataFrame, label: str, mapping: DataFrame) -> DataFrame:
    """Labels that the map does not hold keep their value."""
    return df.join(small(mapping), df[label] == mapping["old"], "left").withColumn(label, F.coalesce("new", label)).drop("old", "new")


def merged_reps(reps: DataFrame, mapping: DataFrame, key: str, values: str) -> DataFrame:
    """(new, values): the distinct representatives of merged clusters, in order of first appearance.

    Each value is reduced to its first place before a cluster's values are gathered. A cluster without any has an empty list.
    """
    joined = reps.join(mapping, reps[key] == mapping["old"])
    flat = joined.select("new", "old", F.posexplode_outer(values).alias("_i", "_x"))
    first = flat.groupBy("new", "_x").agg(F.min(F.struct("old", "_i")).alias("_o"))
    listed = F.array_sort(F.collect_list(F.when(F.col("_o._i").isNotNull(), F.struct("_o", "_x"))))
    return first.groupBy("new").agg(F.transform(listed, lambda x: x["_x"]).alias(values))


def facet_routing(df: DataFrame, key: str, vector: str, facets: DataFrame, top_k: int, threshold: float) -> DataFrame:
    """(key, rank, facet_id, score): the best facets of each row; facets is a short list of (id, emb)."""
    listed = facets.agg(F.array_sort(F.collect_list(F.struct("id", "emb"))).alias("_f"))
    scored = F.transform("_f", lambda f: F.struct((-F.round(V.cosine(F.col(vector), f["emb"]), 9)).alias("k"), f["id"].alias("id")))
    best = df.crossJoin(F.broadcast(listed)).select(key, F.slice(F.array_sort(scored), 1, top_k).alias("_b"))
    rows = best.select(key, F.posexplode("_b").alias("_p", "_x"))
    return rows.select(key, (F.col("_p") + 1).alias("rank"), F.col("_x.id").alias("facet_id"), (-F.col("_x.k")).alias("score")).filter(F.col("score") >= threshold)


def facet_annotate(df: DataFrame, key: str, vector: str, facets: DataFrame, top_k: int, threshold: float) -> DataFrame:
    """df with facet_top1 (null below the threshold) and facet_topk, the text [["id",score],...]; given values stay."""
    routed = facet_routing(df, key, vector, facets, top_k, threshold)
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("rank", "facet_id", "score"))), lambda x: F.concat(F.lit('["'), x["facet_id"], F.lit('",'), F.format_string("%.4f", x["score"]), F.lit("]")))
    per = routed.groupBy(key).agg(F.max(F.when(F.col("rank") == 1, F.col("facet_id"))).alias("_t"), F.concat(F.lit("["), F.array_join(pairs, ","), F.lit("]")).alias("_k"))
    out = df.join(per, key, "left")
    for name, new in (("facet_top1", "_t"), ("facet_topk", "_k")):
        out = out.withColumn(name, F.coalesce(T.blank_to_null(F.col(name), ("[]", "{}")), F.col(new)) if name in df.columns else F.col(new))
    return out.drop("_t", "_k")


def silhouette_cosine(df: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """(key, label, sil) by mean cosine distance: rows meet the sums of labels, not each other.

    For unit vectors the mean of 1 - x.y over a label is 1 - x.(sum of y) / n. Labels are few, so their sums are one row.
    """
    unit = df.filter(F.col(label) != NOISE).select(key, label, V.normalize(F.col(vector)).alias("_v"))
    means = centroids(unit, label, "_v")
    sums = means.select(label, F.transform("centroid", lambda x: x * F.col("n")).alias("s"), "n")
    listed = sums.agg(F.collect_list(F.struct(F.col(label).alias("l"), "s", "n")).alias("_all"))
    far = unit.crossJoin(F.broadcast(listed))
    own = F.element_at(F.filter("_all", lambda c: c["l"] == F.col(label)), 1)
    a = F.when(own["n"] > 1, (own["n"] - V.dot(F.col("_v"), own["s"]) - (1 - V.dot(F.col("_v"), F.col("_v")))) / (own["n"] - 1))
    b = F.array_min(F.transform(F.filter("_all", lambda c: c["l"] != F.col(label)), lambda c: 1 - V.dot(F.col("_v"), c["s"]) / c["n"]))
    return far.select(key, label, a.alias("_a"), b.alias("_b")).select(key, label, F.when(F.col("_a").isNull(), 0.0).otherwise((F.col("_b") - F.col("_a")) / F.greatest("_a", "_b")).alias("sil"))


def silhouette_euclid(df: DataFrame, key: str, label: str, vector: str, rows: int | None = None) -> DataFrame:
    """(key, label, sil) by mean Euclidean distance, exact: all pairs, of which a task holds two blocks' at a time.

    The time grows with the square of the rows. With `rows`, more rows than that are refused; the cosine form is linear.
    """
    good = df.filter(F.col(label) != NOISE).select(key, label, vector)
    if rows is not None and good.limit(rows + 1).count() > rows:
        raise ValueError(f"more than {rows} rows; use silhouette_cosine or a sample")
    means = pairs.label_distances(good, key, label, vector)
    ab = means.groupBy(key, label).agg(F.max(F.when(F.col("_o") == F.col(label), F.col("_m"))).alias("_a"), F.min(F.when(F.col("_o") != F.col(label), F.col("_m"))).alias("_b"))
    # A row without a vector is at no distance of others.
    ab = ab.unionByName(good.filter(~pairs.given(vector)).select(key, label, F.lit(None).cast("double").alias("_a"), F.lit(None).cast("double").alias("_b")))
    return ab.select(key, label, F.when(F.col("_a").isNull(), 0.0).otherwise((F.col("_b") - F.col("_a")) / F.greatest("_a", "_b")).alias("sil"))


def cluster_names(keywords: DataFrame, key: str, words: str, top: int = 2) -> DataFrame:
    """(key, name): the first words that no earlier cluster took, filled up from the list's head. Clusters are few."""
    listed = keywords.agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("c"), F.col(words).alias("w")))).alias("all"))
    start = F.struct(F.array().cast("array<string>").alias("used"), F.array().cast("array<struct<c:bigint,name:string>>").alias("out"))

    def fold(s: Column, x: Column) -> Column:
        free = F.slice(F.filter(x["w"], lambda w: ~F.array_contains(s["used"], w)), 1, top)
        name = F.concat(free, F.slice(x["w"], 1, F.greatest(F.lit(top) - F.size(free), F.lit(0))))
        return F.struct(F.concat(s["used"], free).alias("used"), F.concat(s["out"], F.array(F.struct(x["c"].cast("long").alias("c"), F.array_join(name, "·").alias("name")))).alias("out"))

    return listed.select(F.explode(F.aggregate("all", start, fold, lambda s: s["out"])).alias("x")).select(F.col("x.c").alias(key), "x.name")


def stable_ids(clusters: DataFrame, cluster: str, sig: str, state: DataFrame | None = None, counters: dict[int, int] | None = None) -> DataFrame:
    """(cluster, sig, stable_id): known signatures keep their id, new ones count up within their polarity's thousand.

    Noise (ids that end in 999) passes through. Counters start at 1000 of each prefix; clusters of equal signature share
    an id. state: (sig, stable_id) of earlier runs, whose largest ids go on as counters unless counters are given.
    """
    spark = clusters.sparkSession
    if state is not None and counters is None:
        used = state.groupBy(F.floor(F.col("stable_id") / 1000).cast("int").alias("p")).agg(F.max(F.pmod("stable_id", F.lit(1000))).alias("n")).collect()
        counters = {0: 1000, 1: 1000, 2: 1000} | {r["p"]: 1000 + r["n"] for r in used}
    state = state if state is not None else spark.createDataFrame([], "sig string, stable_id long")
    c = F.col(cluster)
    noise = F.pmod(c, F.lit(1000)) == 999
    real = clusters.filter(~noise).select(c.cast("long").alias("_c"), F.col(sig).alias("sig"))
    known = real.join(state.select("sig", "stable_id"), "sig")
    new = real.join(state, "sig", "left_anti").groupBy("sig").agg(F.min("_c").alias("_c")).withColumn("_p", polarity_prefix(F.col("_c")))
    begin = F.create_map(*[x for k, v in (counters or {0: 1000, 1: 1000, 2: 1000}).items() for x in (F.lit(k), F.lit(v))])
    n = F.try_element_at(begin, F.col("_p")) + F.row_number().over(W.partitionBy("_p").orderBy("_c"))
    number = F.pmod(n, F.lit(1000))
    given = new.select("sig", (F.col("_p") * 1000 + F.when(number == 999, 998).otherwise(number)).cast("long").alias("stable_id"))
    all_ids = known.select("sig", "stable_id").distinct().unionByName(given)
    placed = real.join(all_ids, "sig").select(F.col("_c").alias(cluster), "sig", "stable_id")
    return placed.unionByName(clusters.filter(noise).select(c.cast("long").alias(cluster), F.col(sig).alias("sig"), c.cast("long").alias("stable_id")))


def tuner_params(df: DataFrame, n: Column, bucket: Column, epsilon: float = 0.05) -> DataFrame:
    """df with the parameters of reduction and clustering by the number of rows; halves round to even.

    A bucket, one of several datasets of a product, gets larger ones. min_dist is for reducers that take one.
    """
    pct = F.when(n < 6000, 0.010).otherwise(0.005)
    share = F.bround(n * pct, 0).cast("int")
    near = F.greatest(F.lit(5), F.least(F.lit(100), share))
    size = F.greatest(F.lit(5), share)
    samples = F.greatest(F.lit(2), F.bround(size * 0.5, 0).cast("int"))
    grown = lambda c, by: F.when(bucket, F.bround(c * by, 0).cast("int")).otherwise(c)
    return df.select(
        "*",
        grown(near, 1.15).alias("n_neighbors"),
        F.when(n < 500, 8).when(n < 2000, 10).when(n < 8000, 12).when(n < 16000, 13).otherwise(14).alias("n_components"),
        grown(size, 1.35).alias("min_cluster_size"),
        grown(samples, 1.15).alias("min_samples"),
        F.when(bucket, 0.08).otherwise(0.05).alias("min_dist"),
        F.when(bucket, epsilon + 0.02).otherwise(epsilon).alias("epsilon"),
    )


def knn_core_distance(df: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(key, core): the distance to the k-th nearest other row, exact: all pairs, block by block."""
    return pairs.nth_distance(df, key, vector, k, "core")


def mutual_reachability(df: DataFrame, core: DataFrame, key: str, vector: str) -> DataFrame:
    """(a, b, w) for a < b: the largest of both core distances and the distance. The result itself is all pairs."""
    return pairs.reachabilities(df.select(key, vector).join(core, key), key, vector, "core")
