"""Report tables and the sheets of the clause workbook."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlake.config import POLARITIES
from reviewlake.functions import text as T
from reviewlake.functions.labels import coerce_label

META = ("platform", "product", "date", "link", "source_type", "review")


def meta_join(clauses: DataFrame, reviews: DataFrame, key: str = "review_id") -> DataFrame:
    side = reviews.select(F.col(key).cast("string").alias(key), *[c for c in META if c in reviews.columns])
    return clauses.withColumn(key, F.col(key).cast("string")).join(side, key, "left")


def mode_by(df: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """(group, value): the commonest non-blank value; ties to the one that comes first by `order`; '' if all are blank."""
    counts = df.filter(F.trim(value) != "").groupBy(group, value).agg(F.count("*").alias("_n"), F.min(order).alias("_o"))
    best = counts.groupBy(group).agg(F.min_by(value, F.struct(-F.col("_n"), "_o")).alias(value))
    return df.select(group).distinct().join(best, group, "left").withColumn(value, F.coalesce(value, F.lit("")))


def rep_summary(df: DataFrame, reps: DataFrame, cluster: str, polarity: str, facet: str, order: str, exclude_noise: bool = False) -> DataFrame:
    """(polarity, facet, rep, cnt) of each cluster: modal polarity and facet, first representative and size."""
    df = df.filter(coerce_label(F.col(cluster)) >= 0)
    if exclude_noise:
        df = df.filter(F.pmod(F.col(cluster), F.lit(1000)) != 999)
    sizes = df.groupBy(cluster).agg(F.count("*").alias("cnt"))
    out = sizes.join(mode_by(df, cluster, polarity, order), cluster).join(mode_by(df, cluster, facet, order), cluster).join(reps, cluster, "left")
    rank = F.when(F.col(polarity) == POLARITIES[0], 0).when(F.col(polarity) == POLARITIES[1], 1).when(F.col(polarity) == POLARITIES[2], 2).otherwise(99)
    return out.select(F.col(polarity).alias("polarity"), F.col(facet).alias("facet"), F.coalesce("rep", F.lit("")).alias("rep"), "cnt").orderBy(rank, "facet", F.desc("cnt"), "rep")


def platform_block(reviews: DataFrame, clauses: DataFrame, platform: str = "platform", polarity: str = "polarity") -> DataFrame:
    """Long form (platform, collected, analysed, positive, neutral, negative), with the total under '전체'.

    Null platforms count as `unknown` in the counts, but have no share of their own; shares are percents of one decimal.
    """
    name = lambda c: F.coalesce(F.col(c), F.lit("unknown"))
    collected = reviews.groupBy(name(platform).alias("platform")).agg(F.count("*").alias("collected"))
    known = F.col(platform).isNotNull()
    shares = [F.count_if(known & (F.col(polarity) == p)).alias(f"_{p}") for p in POLARITIES]
    of_clauses = clauses.groupBy(name(platform).alias("platform")).agg(F.count("*").alias("analysed"), F.count_if(known).alias("_n"), *shares)
    both = collected.join(of_clauses, "platform", "full_outer").fillna(0)
    everywhere = [F.count_if(F.col(polarity) == p).alias(f"_{p}") for p in POLARITIES]
    total = reviews.agg(F.count("*").alias("collected")).crossJoin(clauses.agg(F.count("*").alias("analysed"), F.count("*").alias("_n"), *everywhere)).select(F.lit("전체").alias("platform"), "*")
    share = lambda p: F.bround(F.when(F.col("_n") > 0, F.col(f"_{p}") / F.col("_n")).otherwise(0.0) * 100, 1)
    return both.unionByName(total).select("platform", "collected", "analysed", *[share(p).alias(p) for p in reversed(POLARITIES)])


# The metric names of the client report.
METRICS = {"collected": "수집된 데이터 수", "analysed": "분석된 데이터 수", "positive": "긍정 비율 (%)", "neutral": "중립 비율 (%)", "negative": "부정 비율 (%)"}


def platform_metrics(block: DataFrame, platforms: Sequence[str]) -> DataFrame:
    """The block with metrics as rows and the given platforms as columns, the total first."""
    long = block.unpivot("platform", [F.col(c).cast("double").alias(c) for c in METRICS], "metric", "value")
    wide = long.groupBy("metric").pivot("platform", ["전체", *platforms]).agg(F.first("value"))
    names = F.create_map(*[x for k, v in METRICS.items() for x in (F.lit(k), F.lit(v))])
    order = F.array_position(F.array(*map(F.lit, METRICS)), F.col("metric"))
    return wide.orderBy(order).withColumn("metric", names[F.col("metric")]).withColumnRenamed("metric", "메트릭")


def platform_ratio(clauses: DataFrame, platform: str = "platform", polarity: str = "polarity") -> DataFrame:
    known = clauses.filter(F.col(platform).isNotNull())
    wide = known.groupBy(platform).agg(*[F.count_if(F.col(polarity) == p).alias(p) for p in POLARITIES], F.count(polarity).alias("_n"))
    return wide.select(F.col(platform).alias("platform"), *[F.when(F.col("_n") > 0, F.col(p) / F.col("_n")).otherwise(0.0).alias(p) for p in POLARITIES])


def year_ratio(reviews: DataFrame, date: Column) -> DataFrame:
    """(year, reviews, ratio): of parsed dates only; the share in percent of one decimal."""
    years = reviews.select(F.year(date.try_cast("timestamp")).alias("year")).filter("year is not null").groupBy("year").agg(F.count("*").alias("reviews"))
    total = F.sum("reviews").over(W.partitionBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return years.select("year", "reviews", F.bround(F.col("reviews") / total * 100, 1).alias("ratio")).orderBy("year")


def materialize_bucket(df: DataFrame) -> Column:
    """The facet of a row by the first column there is: facet_bucket, facet_top1, facet, bucket, or the head of facet_topk."""
    for c in ("facet_bucket", "facet_top1", "facet", "bucket"):
        if c in df.columns:
            return F.coalesce(F.col(c).cast("string"), F.lit(""))
    if "facet_topk" in df.columns:
        return F.coalesce(F.get_json_object("facet_topk", "$[0][0]"), F.get_json_object("facet_topk", "$[0]"), F.lit(""))
    return F.lit("")


def ensure_top1(df: DataFrame) -> DataFrame:
    """df with facet_top1: as it is, else a copy of facet_bucket, else null; and facet_topk, null where it is missing."""
    if "facet_top1" not in df.columns:
        df = df.withColumn("facet_top1", F.col("facet_bucket").cast("string") if "facet_bucket" in df.columns else F.lit(None).cast("string"))
    return df if "facet_topk" in df.columns else df.withColumn("facet_topk", F.lit(None).cast("string"))


def require_facets(df: DataFrame, facet: str) -> DataFrame:
    if df.filter(F.col(facet).isNotNull()).isEmpty():
        raise ValueError(f"no row has a value in {facet}")
    return df


def facet_coverage(df: DataFrame, column: str) -> DataFrame:
    filled = F.col(column).isNotNull() & (F.trim(column) != "")
    return df.agg(F.count("*").alias("total"), F.count(column).alias("not_null"), F.count_if(filled).alias("filled"), F.bround(F.avg(filled.cast("double")) * 100, 1).alias("pct"))


def first_seen(order: str, value: str) -> Column:
    """An aggregate: the distinct values of a group in the order of their first appearance."""
    return F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]))


def mapping(clauses: DataFrame, order: str, columns: dict[str, str], key: str = "review_id") -> DataFrame:
    """(key, lists): the labels of each review's clauses. columns: label column to list name.

    Clauses of equal labels are one row before a review's rows are gathered, so that its labels bound what is gathered.
    """
    once = clauses.groupBy(key, *columns).agg(F.min(order).alias("_o"))
    return once.groupBy(key).agg(*[first_seen("_o", c).alias(name) for c, name in columns.items()]).orderBy(key)


def reviews_sheet(reviews: DataFrame, mapped: DataFrame, lists: dict[str, str], key: str = "review_id") -> DataFrame:
    """Reviews with their labels as text, '' where they have none; product and review renamed."""
    out = reviews.join(mapped, key, "left")
    names = {"product": "product_name", "review": "comments"}
    kept = [F.col(c).alias(names.get(c, c)) for c in reviews.columns]
    return out.select(*kept, *[F.coalesce(F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ","), F.lit("")).alias(n) for c, n in lists.items()])


def clauses_sheet(clauses: DataFrame, preferred: Sequence[str]) -> DataFrame:
    first = [c for c in preferred if c in clauses.columns]
    return clauses.select(*first, *[c for c in clauses.columns if c not in first])


def clauses_summary(reps: DataFrame, keywords: DataFrame, key: str) -> DataFrame:
    """(key, representatives, keywords) of all clusters in either table; a missing list is empty."""
    none = F.array().cast("array<string>")
    both = reps.join(keywords, key, "full_outer")
    return both.select(key, F.coalesce("representatives", none).alias("representatives"), F.coalesce("keywords", none).alias("keywords")).orderBy(key)


def cluster_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(F.col(label).cast("string").alias("cluster_label")).agg(F.count("*").alias("count")).orderBy("cluster_label")


def cluster_stats(df: DataFrame, label: str) -> DataFrame:
    noise = coerce_label(F.col(label)) == -1
    return df.agg(F.count_distinct(F.when(~noise, F.col(label))).alias("n_clusters"), F.count_if(noise).alias("n_noise"), F.count("*").alias("n_samples"))


def cluster_quality(df: DataFrame, key: str, label: str, reduced: str, raw: str) -> DataFrame:
    """One row: silhouette_umap (Euclidean, of reduced vectors), silhouette_raw (cosine), and the counts of clusters, of
    noise and of rows used. Silhouettes are null with fewer than two clusters.

    Both are of all rows that are not noise; the Euclidean one compares all pairs.
    """
    from reviewlake.operators import clusters as C

    counted = df.select(coerce_label(F.col(label)).alias(label), key, reduced, raw)
    used = counted.filter(F.col(label) != -1)
    counts = counted.agg(F.count_distinct(F.when(F.col(label) != -1, F.col(label))).alias("n_clusters"), F.count_if(F.col(label) == -1).alias("n_noise_or_other"), F.count_if(F.col(label) != -1).alias("n_samples_used"))
    euclid = C.silhouette_euclid(used, key, label, reduced).agg(F.avg("sil").alias("silhouette_umap"))
    cosine = C.silhouette_cosine(used, key, label, raw).agg(F.avg("sil").alias("silhouette_raw"))
    enough = F.col("n_clusters") >= 2
    both = counts.crossJoin(euclid).crossJoin(cosine)
    return both.select(F.when(enough, F.col("silhouette_umap")).alias("silhouette_umap"), F.when(enough, F.col("silhouette_raw")).alias("silhouette_raw"), *counts.columns)


def representatives_json(reps: DataFrame, key: str, values: str) -> DataFrame:
    """(cluster, json): one object a cluster, {"label": number, "representatives": [...]}, the label as a whole number."""
    label = coerce_label(F.col(key))
    return reps.select(label.alias("cluster"), F.to_json(F.struct(label.alias("label"), F.col(values).alias("representatives"))).alias("json")).orderBy("cluster")


def text_lists(df: DataFrame) -> DataFrame:
    """Array columns as JSON text, as sheets hold them."""
    return df.withColumns({f.name: F.to_json(f.name) for f in df.schema.fields if f.dataType.typeName() == "array"}) if any(f.dataType.typeName() == "array" for f in df.schema.fields) else df


def workbook(clauses: DataFrame, mapped: DataFrame, reviews: DataFrame, meta: DataFrame | None = None, label: str = "cluster_id", key: str = "review_id") -> dict[str, DataFrame]:
    """The sheets clauses, mapping, reviews and, if given, meta: labels are whole numbers, ids and lists are text."""
    missing = [f"{name}.{c}" for name, df, own in (("clauses", clauses, (key, "clause", label)), ("mapping", mapped, (key,)), ("reviews", reviews, (key,))) for c in own if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    named = {"clauses": clauses.withColumn(label, coerce_label(F.col(label))), "mapping": mapped, "reviews": reviews}
    sheets = {name: text_lists(df.withColumn(key, F.col(key).cast("string"))) for name, df in named.items()}
    return sheets | ({"meta": text_lists(meta)} if meta is not None else {})


def columns_lost(before: DataFrame, after: DataFrame) -> list[str]:
    """The columns of `before` that `after` has no more, sorted: what a step has dropped."""
    return sorted(set(before.columns) - set(after.columns))


def clustered_reviews(reviews: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Reviews with their label, named label_2 if reviews have such a column already."""
    name = f"{label}_2" if label in reviews.columns else label
    return reviews.join(labels.select(key, F.col(label).alias("_l")), key, "left").withColumn(name, F.col("_l")).drop("_l")


def debug_head(df: DataFrame, order: str, columns: Sequence[str], rows: int = 200) -> DataFrame:
    return df.orderBy(order).limit(rows).select(*[c for c in columns if c in df.columns])


def blank_facets_to_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: T.blank_to_null(F.col(c), ("[]", "{}")) for c in columns})
