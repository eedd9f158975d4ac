import numpy as np
import pytest

from reviewlake.llm import forest_search as fs


def brute(ids, x, q, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u[ids.index(q)]
    return sorted(((-round(float(v), 12), i) for v, i in zip(s, ids, strict=True) if i != q))[:k]


@pytest.mark.parametrize("leaf_rows, block", [(128, 1024), (10, 7)])
def test_neighbours_match_exhaustive_search(spark, monkeypatch, leaf_rows, block):
    monkeypatch.setattr(fs, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(fs, "BLOCK", block)
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 16)).astype(np.float32)
    x[100:250] = x[100]
    x[300] = 2 * x[100]
    ids = [3 * i for i in range(600)]
    rows = spark.createDataFrame([(i, v.tolist(), 7) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>, score int")
    got = fs.nearest(rows, rows.filter("vec_id % 50 = 0"), 5, recall=1.0).collect()
    hit = 0
    for q in (i for i in ids if i % 50 == 0):
        mine = sorted((a for a in got if a.query_id == q), key=lambda a: a.rank)
        assert [a.rank for a in mine] == [1, 2, 3, 4, 5]
        want = brute(ids, x.astype(float), q, 5)
        if 300 <= q < 750:
            assert [a.vec_id for a in mine] == [i for _, i in want]
        hit += len({a.vec_id for a in mine} & {i for _, i in want})
        assert all(abs(a.score - float(np.dot(x[ids.index(a.vec_id)] / np.linalg.norm(x[ids.index(a.vec_id)].astype(float)), x[ids.index(q)] / np.linalg.norm(x[ids.index(q)].astype(float))))) < 1e-6 for a in mine)
    assert hit >= 0.9 * 5 * 12


def test_queue_gives_leaves_by_margin_and_the_own_leaf_first():
    x = np.random.default_rng(0).normal(size=(500, 8))
    forest = fs.Forest(x, 3, 20)
    for n in range(5):
        margins = [t.margins(x[n : n + 1])[0] for t in forest.trees]
        order = list(forest.search(margins, 10**6))
        assert sorted(order) == list(range(forest.base[-1]))
        assert set(order[:3]) == set(forest.place(x[n : n + 1])[0])


def test_odd_vectors_and_few_candidates(spark, tmp_path):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (50, [1.0, 1.0]), (100, None), (150, [0.0, 0.0]), (200, [nan, 1.0]), (7, [1.0, 0.0]), (8, [None, 1.0]), (None, [1.0, 0.0]), (250, [3e38, 0.0]), (300, [1.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [(x.query_id, x["rank"], x.vec_id) for x in fs.op1_projection_forest(spark, str(tmp_path)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7), (0, 2, 250), (0, 3, 50), (50, 1, 0), (50, 2, 7), (50, 3, 250), (250, 1, 0), (250, 2, 7), (250, 3, 50)]
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/e/embeddings.parquet")
    assert fs.op1_projection_forest(spark, f"{tmp_path}/e").count() == 0
    spark.createDataFrame([(50, [1.0, 2.0])], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/o/embeddings.parquet")
    assert fs.op1_projection_forest(spark, f"{tmp_path}/o").count() == 0


def test_rows_of_one_key_with_other_vectors_are_candidates_each(spark):
    rows = [(50, [1.0, 0.0]), (7, [1.0, 0.1]), (7, [0.0, 1.0]), (50, [0.0, 1.0]), (7, [1.0, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((x.query_id, x["rank"], x.vec_id, round(x.score, 3)) for x in fs.nearest(df, df.filter("vec_id = 50"), 5).collect())
    assert got == [(50, 1, 7, 0.995), (50, 1, 7, 1.0), (50, 2, 7, 0.0), (50, 2, 7, 0.1)]


def test_recall_at_the_shipped_parameter_and_fewer_leaves_of_larger_tables(spark, caplog):
    """Vectors in loose groups, as embeddings are. The share of leaves that a query opens falls as the table grows."""
    r, shares = np.random.default_rng(5), []
    for n in (2000, 20_000):
        x = (r.normal(size=(n // 20, 1, 64)) + 0.5 * r.normal(size=(n // 20, 20, 64))).reshape(n, 64)
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
        with caplog.at_level("INFO", logger=fs.__name__):
            got = fs.nearest(df, df.filter("vec_id % 50 = 0"), 5).collect()
        told = caplog.records[-1].args
        shares.append(told[2] / told[1])
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        s = u[::50] @ u.T
        s[np.arange(len(s)), np.arange(0, n, 50)] = -2
        true = np.argsort(-s, axis=1)[:, :5]
        mine = {}
        for a in got:
            mine.setdefault(a.query_id, set()).add(a.vec_id)
        recall = np.mean([len(mine[50 * i] & set(t.tolist())) / 5 for i, t in enumerate(true)])
        print(f"{n} vectors: {told[2]} of {told[1]} leaves opened, recall {recall:.3f}")
        assert recall >= 0.95
    assert shares[1] < shares[0]
