"""All pairs block by block, against plain NumPy over the whole matrix."""

import numpy as np

from reviewlake.operators import clusters as C
from reviewlake.operators import pairs, report


def made(spark, n, dims=5, labels=4):
    """Rows in several blocks, a third of them copies of one vector, and one without a vector."""
    r = np.random.default_rng(3)
    x = r.normal(size=(n, dims)) + 100
    x[: n // 3] = x[0]
    y = r.integers(0, labels, n)
    rows = [(i, int(l), v.tolist()) for i, (l, v) in enumerate(zip(y, x))]
    df = spark.createDataFrame([*rows, (n, 0, None)], "k int, l int, v array<double>").repartition(3)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    return df, y, d


def test_silhouettes_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK", 128)
    df, y, d = made(spark, 300)
    got = {s.k: s.sil for s in C.silhouette_euclid(df, "k", "l", "v").collect()}
    for i in range(300):
        own = (y == y[i]) & (np.arange(300) != i)
        a, b = d[i, own].mean(), min(d[i, y == o].mean() for o in set(y) - {y[i]})
        assert abs(got[i] - (b - a) / max(a, b)) < 1e-9
    assert len(got) == 301 and got[300] == 0
    monkeypatch.undo()
    # More rows than were allowed before, none of them refused.
    many = spark.range(20_100).selectExpr("id as k", "cast(id % 2 as int) as l", "array(double(id % 2)) as v")
    assert C.silhouette_euclid(many, "k", "l", "v").filter("sil = 1.0").count() == 20_100


def test_nth_distances_of_several_blocks(spark, monkeypatch):
    """The join of all rows with all rows made n * n rows of Spark; now none is made but the lists of the nearest."""
    monkeypatch.setattr(pairs, "BLOCK", 128)
    df, _, d = made(spark, 300)
    out = C.knn_core_distance(df, "k", "v", 5)
    got = {s.k: s.core for s in out.collect()}
    assert np.allclose([got[i] for i in range(300)], np.sort(d, axis=1)[:, 5], atol=1e-12) and got[0] == 0 and got[300] is None
    assert C.knn_core_distance(df.limit(5), "k", "v", 5).count() == 0
    monkeypatch.undo()
    many = spark.range(20_000).selectExpr("id as k", "array(double(id)) as v")
    assert C.knn_core_distance(many, "k", "v", 4).filter("core = 2").count() == 19_996


def test_reachability_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK", 128)
    df, _, d = made(spark, 300)
    df = df.filter("v is not null")
    rows = C.mutual_reachability(df, C.knn_core_distance(df, "k", "v", 5), "k", "v").toPandas()
    core = np.sort(d, axis=1)[:, 5]
    a, b = rows.a.to_numpy(), rows.b.to_numpy()
    assert len(rows) == len(set(zip(a, b))) == 300 * 299 // 2 and (a < b).all()
    assert np.allclose(rows.w, np.maximum(np.maximum(core[a], core[b]), d[a, b]), atol=1e-9)
    monkeypatch.undo()
    many = spark.range(4_000).selectExpr("id as k", "array(double(id)) as v", "0d as core")
    assert C.mutual_reachability(many.drop("core"), many.drop("v"), "k", "v").count() == 4_000 * 3_999 // 2


def test_quality_takes_every_row(spark):
    """Rows beyond 20,000 count: a sample would give half of them a place in it and the wrong mean."""
    n = 20_400
    df = spark.range(n).selectExpr("id as k", "cast(id % 2 as string) as l", "array(double(id % 2) * 10 + if(id = 7, 9, 0)) as u", "array(double(id % 2), 1 - double(id % 2)) as v")
    got = report.cluster_quality(df, "k", "l", "u", "v").first()
    x = np.arange(n) % 2 * 10.0
    x[7] += 9
    far = lambda p, own: np.abs(own - p).sum()
    want = []
    for i in (0, 1, 7):
        mine, other = x[i % 2 :: 2], x[1 - i % 2 :: 2]
        a, b = far(x[i], mine) / (n // 2 - 1), far(x[i], other) / (n // 2)
        want.append((b - a) / max(a, b))
    assert abs(got.silhouette_umap - (want[0] * (n // 2) + want[1] * (n // 2 - 1) + want[2]) / n) < 1e-9 and got.n_samples_used == n
