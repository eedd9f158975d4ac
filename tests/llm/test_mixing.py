import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from reviewlake.llm import mixing


def brute(rows, cycle=(3, 1, 2)):
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: cycle[i % 3] for i, s in enumerate(order)}
    total, target = 1.5 * sum(sizes.values()), {}
    open_ = set(order)
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] <= level * weight[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    taken = {}
    for s in order:
        n = sizes[s]
        times = int(target[s] // n) if n else 0
        left, upto = target[s] - times * n, 0
        by = defaultdict(int)
        for k, t, m in rows:
            if t == s:
                by[int(hashlib.md5(("" if k is None else str(k)).encode()).hexdigest()[:15], 16)] += m
        for h in sorted(by):
            upto += by[h]
            taken[s, h] = times + (upto - by[h] / 2 <= left)
    return target, {(k, s): m * taken[s, int(hashlib.md5(("" if k is None else str(k)).encode()).hexdigest()[:15], 16)] for k, s, m in rows}


def test_mix_matches_water_filling_by_hand(spark):
    rows = [(i, f"s{i % 7 if i % 3 else 0}", (i * 37) % 90) for i in range(400)] + [(None, None, 11), (1001, "zero", 0), (5000, "big", 4000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long")
    got = mixing.mix(df, F.col("n")).collect()
    target, taken = brute(rows)
    for x in got:
        assert abs(x.target - target[x.source]) < 1e-6
        assert x.taken == taken[x.doc_id, x.source]
        assert x.taken <= 2 * x.size


def test_words_and_odd_inputs(spark, tmp_path):
    rows = [(1, None, "a"), (1, None, "a"), (2, "", None), (3, " a\tb\n\nc d ", "b"), (4, "x " * 50000, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x.size for x in mixing.op4_mix_sources(spark, str(tmp_path)).collect()}
    assert got == {1: 0, 2: 0, 3: 3, 4: 50000}
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/e/documents.parquet")
    assert mixing.op4_mix_sources(spark, f"{tmp_path}/e").count() == 0
