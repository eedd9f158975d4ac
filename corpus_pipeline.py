"""Corpus pipeline: quality, language, near duplicates, mixing by source, packing into sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
documents; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import language_id, mixing, ngram_join, packing, quality, sharding
from reviewlake.session import delete_path, scratch_path

#: A document is rejected below this score.
MIN_QUALITY = 0.3
#: And below these parts of the cosine, and of its lead over the second language, that learning documents typically have.
MIN_COSINE, MIN_LEAD = 0.25, 0.05


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the additive model, fitted on labelled ones, takes for bad.

    A null text is judged as an empty one, repeated rows alike. Without labels of both kinds all get the share of good ones.
    """
    model = quality.learn(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, model, tuple(docs.columns), threshold=MIN_QUALITY, out=("_score", "_predicted"))
    return scored.filter("_predicted = 1").select(*docs.columns)


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without a letter, in no learned language or whose best language hardly stands out.

    Documents of fewer than language_id.LEAST_TRIGRAMS trigrams do not tell and stay if they have a letter. A null or empty
    text goes. Repeated rows are judged alike; an empty table, or one without a language, gives an empty one.
    """
    names, prototypes = language_id.learn(docs)
    usual = language_id.typical(docs, names, prototypes)
    told = language_id.predict(docs, names, prototypes, tuple(docs.columns), out=("_lang", "_score", "_cosine", "_lead", "_n"))
    near = language_id.stands_out(usual, "_lang", "_cosine", "_lead", "_n", MIN_COSINE, MIN_LEAD)
    return told.filter((F.col("_lang") != "und") & near).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group linked by five-word n-grams from a similarity of 0.8 on.

    Rows of equal doc_id and text are one document, by the first of their other columns. Rows that share a doc_id with
    different texts are documents of their own, and so are rows without a doc_id, which come last in a group.
    """
    from reviewlake.session import checkpointed

    repeated = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    if docs.filter("doc_id is null").isEmpty() and repeated.isEmpty():
        groups = checkpointed(ngram_join.jaccard_components(docs.select("doc_id", "text"), 5, 80))
        copies = groups.filter("doc_id <> component_id").select("doc_id").distinct()
        return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    once = docs.groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("_rest")) if rest else docs.distinct()
    once = once.select(*(F.col(f"_rest.{c}").alias(c) if c in rest else F.col(c) for c in docs.columns))
    keyed = checkpointed(sharding.number_within(once.withColumn("_all", F.lit(0)), "_all", "doc_id", 1, slot="_key"))
    groups = ngram_join.jaccard_components(keyed.select(F.col("_key").alias("doc_id"), "text"), 5, 80)
    placed = keyed.select("_key", F.col("doc_id").alias("_id")).join(groups.select(F.col("doc_id").alias("_key"), "component_id"), "_key")
    first = placed.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_key")).alias("m"))
    return keyed.join(first.select(F.col("m._key").alias("_key")), "_key", "left_semi").select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, twice where it takes them twice.

    A null source is a source of its own; a document without words has size 0 and goes with its hash; rows of equal doc_id
    are taken alike.
    """
    return mixing.mixed_rows(docs, mixing.words(F.col("text")))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens; a null or empty text is one piece, its end id."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mixing),
    ("packing", sequence_packing),
]

#: SQL cannot tokenise nor fit the models; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each stage's rows are written to the shared folder and read again by the next one."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
