"""The whole runs: reviews to report, posts to kept sentences, and both over folders of datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlake.config import BASES, POLARITIES, Settings
from reviewlake.functions import text as T
from reviewlake.functions import vectors as V
from reviewlake.functions.labels import label_offset, refined_id
from reviewlake.operators import clusters as C
from reviewlake.operators import density, keywords, polarity, preprocess, relevance, report
from reviewlake.session import checkpointed, delete_path, small, spread
from reviewlake.sources import sinks
from reviewlake.sources.reviews import facet_vectors


def clause_rows(reviews: DataFrame, settings: Settings, text: str = "review", key: str = "review_id", smart: bool = True, gate: bool = False) -> DataFrame:
    """(key, clause_idx, clause): narrow expressions only, so it runs on streams as well.

    With `gate` a connective also cuts where the hashed vectors of its two sides are far apart.
    """
    parts = T.sentences(F.col(text))
    embedded = lambda c: V.hash_embed(T.tokens(F.lower(c), settings.language.token), settings.embedding_dims)
    distance = (lambda a, b: 1 - V.dot(embedded(a), embedded(b))) if gate else None
    if smart:
        parts = F.flatten(F.transform(parts, lambda s: T.clauses(s, settings, distance)))
    return reviews.select(key, F.posexplode(parts).alias("clause_idx", "clause"))


def polarized(reviews: DataFrame, settings: Settings, model=None, cache: str | None = None) -> DataFrame:
    """Confident clauses; with `cache` only clauses that it does not hold are classified."""
    rows = clause_rows(reviews, settings, gate=settings.split_embedding)
    if cache:
        told = sinks.cached(rows, ["clause"], lambda r: polarity.classify(r, settings, model=model).select("cache_key", "polarity", "confidence"), cache).drop("cache_key")
    else:
        told = polarity.classify(rows, settings, model=model)
    return polarity.confident(told, settings)


def embed(df: DataFrame, settings: Settings, text: str = "clause", embedder=None, cache: str | None = None) -> DataFrame:
    """df with `embedding`; embedder(df, text) may give it instead of the hashing one. `cache` is keyed by text and model."""
    if cache:
        named = df.withColumn("_model", F.lit(f"{settings.embedding_model}/{settings.embedding_dims}"))
        return sinks.cached(named, [text, "_model"], lambda r: embed(r, settings, text, embedder).select("cache_key", "embedding"), cache).drop("cache_key", "_model")
    if embedder is not None:
        return embedder(df, text)
    return df.withColumn("embedding", V.hash_embed(T.tokens(F.lower(text), settings.language.token), settings.embedding_dims))


def run_reviews(
    reviews: DataFrame, settings: Settings, order: str, facets: Sequence[dict] = (), aliases: Sequence[str] = (), model=None, embedder=None, min_cluster_size: int | None = None,
    min_samples: int | None = None, refine: bool = True, dataset: str = "", state_path: str | None = None, cache_dir: str | None = None, resume: bool = False, normalize=None,
) -> dict[str, DataFrame]:
    """Tables of one dataset: clauses, mapping, reviews, clauses_summary, rep_summary, representatives, cluster_stats,
    merge_candidates, platform_block and year_ratio.

    Polarity is a partition key all the way; only the density clustering and the local splits are grouped Python. Vectors
    are reduced and clustered by the parameters of the number of clauses; a dataset name of two underscores or more is a
    bucket. With state_path ids go on from the last run's and are written for the next. With cache_dir what the models
    gave is kept, and with resume it is used again.
    """
    spark = reviews.sparkSession
    caches = {}
    for name in ("polarity", "embedding") if cache_dir else ():
        caches[name] = f"{cache_dir}/{name}"
        if not resume:
            delete_path(spark, caches[name])
    base = checkpointed(preprocess.with_review_id(preprocess.preprocess(spread(reviews), order), order))
    told = embed(polarized(base, settings, model, caches.get("polarity")), settings, embedder=embedder, cache=caches.get("embedding"))
    rows = checkpointed(preprocess.numbered(told.withColumn("_o", F.struct("review_id", "clause_idx")), "_o", "row_idx").drop("_o"))
    sizes = rows.groupBy("polarity").agg(F.count("*").alias("n"))
    tuned = {r["polarity"]: r for r in C.tuner_params(sizes, F.col("n"), F.lit(dataset.count("_") >= 2), settings.selection_epsilon).collect()}
    labelled = stats = None
    for p in POLARITIES:
        if p not in tuned:
            continue
        t = tuned[p]
        own = checkpointed(density.reduce_pca(rows.filter(F.col("polarity") == p), "embedding", t["n_components"]))
        part = checkpointed(density.cluster_groups(own, "polarity", "row_idx", "reduced", min_cluster_size or t["min_cluster_size"], min_samples or t["min_samples"], t["epsilon"]))
        told = report.cluster_quality(own.join(part, ["polarity", "row_idx"]), "row_idx", "cluster_label", "reduced", "embedding").select(F.lit(p).alias("polarity"), "*")
        labelled = part if labelled is None else labelled.unionByName(part)
        stats = told if stats is None else stats.unionByName(told)
    if labelled is None:
        labelled = spark.createDataFrame([], "polarity string, row_idx long, cluster_label int")
    rows = rows.join(labelled, ["polarity", "row_idx"]).withColumn("cluster_id", label_offset(F.col("cluster_label"), F.col("polarity")))
    rows = checkpointed(rows)
    real = rows.filter("cluster_label <> -1")
    reps = C.representatives(real, "cluster_id", "embedding", "row_idx", settings.top_representatives)
    listed = reps.groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "clause"))), lambda x: x["clause"]).alias("representatives"), F.first("polarity").alias("polarity"))
    listed = checkpointed(listed.withColumn("representatives", relevance.alias_first(F.col("representatives"), aliases)))
    centres = C.centroids(reps, "cluster_id", "embedding", unit=True).join(listed.select("cluster_id", "polarity"), "cluster_id")
    cutoff = settings.merge_threshold
    if settings.merge_percentile is not None:
        cutoff = C.dynamic_threshold(C.merge_candidates(centres, "cluster_id", "centroid", -2.0, facet="polarity"), settings.merge_percentile).first()["threshold"]
    pairs = checkpointed(C.merge_candidates(centres, "cluster_id", "centroid", cutoff, facet="polarity"))
    merged = checkpointed(C.merge_map(centres, pairs, "cluster_id"))
    # New labels count within a polarity, so that they stay in its thousand.
    within = merged.join(listed.select(F.col("cluster_id").alias("old"), "polarity"), "old").withColumn("new", (F.dense_rank().over(W.partitionBy("polarity").orderBy("new")) - 1).cast("int"))
    bases = F.create_map(*[x for k, v in BASES.items() for x in (F.lit(k), F.lit(v))])
    within = within.select("old", (F.col("new") + bases[F.col("polarity")]).alias("new"))
    rows = C.apply_map(rows, "cluster_id", within)
    reps_of = C.merged_reps(listed.withColumnRenamed("cluster_id", "_c"), within, "_c", "representatives").withColumnRenamed("new", "cluster_id")
    docs = reps_of.select("cluster_id", F.posexplode("representatives").alias("_i", "_d")).withColumn("_k", F.concat_ws("-", "cluster_id", "_i"))
    words = keywords.tfidf_keywords(docs, "cluster_id", "_k", "_d", settings.language.keyword, settings.language.stopwords, settings.top_keywords, normalize)
    words = words.groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]).alias("keywords"))
    if facets and refine:
        table = facet_vectors(spark, facets, lambda df, text: embed(df, settings, text, embedder))
        rows = C.facet_annotate(rows, "row_idx", "embedding", table, settings.facet_top_k, settings.facet_threshold)
    rows = report.ensure_top1(rows)
    if refine:
        local = rows.withColumn("_local", F.pmod(F.col("cluster_id"), F.lit(1000)))
        split = density.refine_split(local.filter("cluster_label <> -1"), "cluster_id", "row_idx", "embedding", settings.min_split_size, settings.hetero_threshold, settings.max_local_k, settings.seed)
        own = split.select("row_idx", (F.col("refined_label") != F.col("cluster_id")).alias("_cut"), F.pmod(F.col("refined_label") - F.col("cluster_id") * 10, F.lit(10)).alias("_s"))
        local = local.join(own, "row_idx", "left")
        label = F.when(F.col("cluster_label") == -1, -1).when(F.col("_cut"), F.col("_local") * 10 + F.col("_s")).otherwise(F.col("_local"))
        prefix = F.floor(F.col("cluster_id") / 1000).cast("int")
        rows = local.withColumn("refined_label", label.cast("int")).withColumn("refined_cluster_id", refined_id(prefix, F.col("refined_label"))).drop("_local", "_cut", "_s")
    else:
        rows = rows.withColumn("refined_label", F.col("cluster_label")).withColumn("refined_cluster_id", F.col("cluster_id"))
    rows = checkpointed(rows)
    sigs = rows.select(F.col("refined_cluster_id").alias("c")).distinct().join(reps_of.withColumnRenamed("cluster_id", "c"), "c", "left").withColumn("sig", T.signature(F.col("representatives"), F.col("c")))
    state = sinks.read_state(spark, state_path) if state_path else None
    ids = checkpointed(C.stable_ids(sigs.select("c", "sig"), "c", "sig", state))
    if state_path:
        new = ids.filter(F.pmod("c", F.lit(1000)) != 999).select("sig", "stable_id")
        sinks.write_state(new if state is None else state.unionByName(new), state_path)
    rows = rows.join(small(ids.select(F.col("c").alias("refined_cluster_id"), F.col("stable_id").alias("stable_cluster_id"))), "refined_cluster_id", "left")
    full = report.meta_join(rows.drop("embedding"), base)
    mapped = report.mapping(full, "row_idx", {"cluster_id": "cluster_labels", "refined_cluster_id": "refined_cluster_ids", "stable_cluster_id": "stable_cluster_ids"})
    first = reps_of.select("cluster_id", F.element_at("representatives", 1).alias("rep"))
    out = {
        "clauses": report.clauses_sheet(full, ("review_id", "clause", "polarity", "confidence", "cluster_id", "facet_top1", "facet_topk", "refined_label", "refined_cluster_id", "stable_cluster_id")),
        "mapping": mapped,
        "reviews": report.reviews_sheet(base, mapped, {"cluster_labels": "cluster", "refined_cluster_ids": "refined_cluster", "stable_cluster_ids": "stable_cluster"}),
        "representatives": report.representatives_json(reps_of, "cluster_id", "representatives"),
        "merge_candidates": pairs,
        "clauses_summary": report.clauses_summary(reps_of, words, "cluster_id"),
        "rep_summary": report.rep_summary(full.withColumn("facet", F.coalesce("facet_top1", F.lit(""))), first, "cluster_id", "polarity", "facet", "row_idx"),
    }
    if stats is not None:
        out["cluster_stats"] = stats
    if "platform" in base.columns:
        out["platform_block"] = report.platform_block(base, full)
    if "date" in base.columns:
        out["year_ratio"] = report.year_ratio(base, F.col("date"))
    return out


def run_posts(posts: DataFrame, settings: Settings, aliases: Sequence[str], terms: Sequence[str], ban_terms: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept sentences as reviews, filter statistics, all scored sentences) of community posts."""
    parts = relevance.summarize_row(F.col("title"), F.col("body"), F.col("summary"), settings.community_summary_max)
    told = spread(posts).withColumn("_told", parts).drop("title", "body", "summary")
    rows = relevance.flatten_sentences(told, F.col("_told"), "post_id").drop("_told")
    token, dims = settings.language.token, settings.embedding_dims
    rows = rows.withColumn("_v", V.hash_embed(T.tokens(F.lower("sentence"), token), dims))
    scored = relevance.dual_relevance(rows, "_v", "sentence", aliases, terms, terms, token, dims, settings.alias_query_cap, settings.facet_query_cap).drop("_v")
    keep = relevance.gate(F.col("sentence"), F.col("alias_sim"), F.col("total"), aliases, ban_terms, settings.community_rel_tau, settings.community_alias_tau, settings.community_ban_mode)
    scored = checkpointed(scored.withColumn("kept", keep).withColumn("alias_hit", T.contains_any(F.col("sentence"), aliases)).withColumn("banned", T.contains_any(F.col("sentence"), ban_terms)))
    kept = scored.filter("kept").select(F.concat("post_id", F.lit("-s"), "serial").alias("review_id"), F.col("sentence").alias("review"), "platform", "product", "date", "link", F.lit("community").alias("source_type"), "serial")
    return kept, relevance.filter_stats(scored), scored


def run_community(posts: DataFrame, settings: Settings, aliases: Sequence[str], terms: Sequence[str], ban_terms: Sequence[str] = (), **more) -> dict[str, DataFrame]:
    """Posts through the filter, then as reviews with alias-preferring representatives."""
    kept, stats, _ = run_posts(posts, settings, aliases, terms, ban_terms)
    return {**run_reviews(kept, settings, "serial", aliases=aliases, **more), "filter_stats": stats}
