"""Relevance scores to the last bit, as the SQL's list_inner_product rounds them."""

import math

import duckdb
import numpy as np

from reviewlake.functions import vectors as V
from reviewlake.operators import relevance
from reviewlake.plans import catalogue

QUERIES, TOKEN, DIMS = ["und der haus", "the and que", "nothing"], "[A-Za-z]{2,}", 16


def fused(v, q):
    s = 0.0
    for x, y in zip(v, q):
        s = math.fma(x, y, s)
    return s


def test_similarities_are_rounded_once_a_product(spark):
    x = np.random.default_rng(0).random((200, DIMS))
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([*((i, v.tolist()) for i, v in enumerate(x)), (200, None)], "k int, v array<double>")
    got = {r.k: r.s for r in df.select("k", relevance.max_similarity(df.v, QUERIES, TOKEN, DIMS).alias("s")).collect()}
    embedded = [V.hash_embed_text(q, TOKEN, DIMS) for q in QUERIES]
    assert [got[i] for i in range(200)] == [max(fused(v.tolist(), q) for q in embedded) for v in x]
    assert got[200] is None
    blank = df.limit(1).select(relevance.max_similarity(df.v, ["!"], TOKEN, DIMS).alias("s"))
    assert blank.first().s == 0.0


def test_keep_mask_on_the_threshold(spark, tmp_path):
    """(4 + 5) / sqrt(2 * 162) is a half; the sum falls just below it if its second product is not rounded on its own."""
    texts = [(0, "UND " * 4 + "DER " * 5 + "moon " * 11), (1, "UND DER moon"), (2, "moon")]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(r.doc_id for r in catalogue.keep_mask(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == sorted(r[0] for r in con.sql(catalogue.oracle_sql()["keep_mask"]).fetchall()) == [1]
