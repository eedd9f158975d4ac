from collections import Counter

from pyspark.sql import functions as F

from reviewlake.llm import sharding


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_matches_the_published_loop(spark):
    keys = [0, 1, -1, 7, 256, 2**62 + 3, -(2**63), 2**63 - 1, *range(1000, 1300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 10, 16, 17):
        got = {x.k: x.s for x in df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k, n) for k in keys}


def test_appending_a_shard_moves_rows_only_into_it(spark):
    rows = sharding.assign_shards(spark.range(4000), "id", 16, grown="g").collect()
    moved = [x for x in rows if x.shard != x.g]
    assert all(x.g == 16 for x in moved) and 100 < len(moved) < 450
    assert max(Counter(x.shard for x in rows).values()) < 350


def test_nulls_repeats_empty_and_clashes(spark, tmp_path):
    rows = [(1, None, "x"), (1, None, "x"), (None, "", None), (None, "é" * 30000, None), (3, "a", "y")]
    spark.createDataFrame(rows, "doc_id long, text string, shard string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sharding.op9_jump_shards(spark, str(tmp_path)).collect()
    assert sorted((x.size, x.text_crc32 is None) for x in got) == [(1, False), (1, True), (1, True), (2, False), (60001, False)]
    for s, n in Counter(x.shard for x in got).items():
        assert sorted(x.slot for x in got if x.shard == s) == list(range(n))
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/e/documents.parquet")
    assert sharding.op9_jump_shards(spark, f"{tmp_path}/e").count() == 0


def test_many_shards_and_both_counts_from_one_walk(spark):
    keys = [0, -5, 2**63 - 1, *range(300)]
    df = spark.createDataFrame([(k, "t") for k in keys], "k long, t string")
    got = sharding.assign_shards(df, "k", 1000, shard="t", grown="g").collect()
    assert [(x.t, x.g) for x in got] == [(jump(x.k, 1000), jump(x.k, 1001)) for x in got] and len(got) == len(keys)
