import numpy as np
import pytest

from reviewlake.llm import multi_index


def brute(ids, x, threshold=0.9):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= threshold
    comp = {i: i for i in ids}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, b in zip(*np.nonzero(hit), strict=True):
        p, q = find(ids[a]), find(ids[b])
        comp[max(p, q)] = min(p, q)
    return {i: (int(hit[k].sum()) - 1, find(i)) for k, i in enumerate(ids)}


def made(seed, n, dims, groups):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dims)).astype(np.float32)
    for size in groups:
        at = r.choice(n, size, replace=False)
        x[at] = x[at[0]] + 0.02 * r.normal(size=(size, dims)).astype(np.float32)
    x[n // 2] = x[3] * 2
    x[n // 2 + 1 : n // 2 + 9] = x[4]
    return x


@pytest.mark.parametrize("dims, block", [(32, 1024), (17, 20)])
def test_links_and_groups_match_all_pairs(spark, monkeypatch, dims, block):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    x = made(dims, 400, dims, [2, 3, 5, 90])
    ids = [7 * i + 1 for i in range(len(x))]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in multi_index.near_duplicates(df).collect()}
    assert got == brute(ids, x.astype(float))


def test_traversal_is_in_order_and_complete():
    r = np.random.default_rng(0)
    f, s = r.random(9), r.random(7)
    got = list(multi_index.traverse(f, s, 10))
    sums = [f[i] + s[j] for i, j in got]
    assert sums == sorted(sums) and len(set(got)) == 63
    near = list(multi_index.traverse(f, s, 0.3))
    assert near == [c for c, t in zip(got, sums, strict=True) if t <= sums[0] + 0.3]


def test_odd_vectors(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [nan, 1.0, 0.0]), (6, [inf, 1.0, 0.0]), (7, [None, 1.0, 0.0]), (8, []), (9, [1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (10, [3e38, 0.0, 0.0]), (11, [0.0, 1e-40, 0.0])]
    spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<float>, w int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in multi_index.op10_multi_index(spark, str(tmp_path)).collect()))
    linked = {1: (3, 1), 2: (3, 1), 10: (3, 1)}
    assert got == sorted((i or 0, *linked.get(i, (0, i or 0)), i is None or linked.get(i, (0, i))[1] == i) for i, _ in rows)
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/e/embeddings.parquet")
    assert multi_index.op10_multi_index(spark, f"{tmp_path}/e").count() == 0


def test_rare_links_at_the_threshold_are_met_beside_many_close_ones(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "PROBE_ROWS", 64)
    r = np.random.default_rng(6)

    def mates(x, cosine):
        noise = r.normal(size=x.shape)
        noise -= (noise * x).sum(1, keepdims=True) * x
        return cosine * x + np.sqrt(1 - cosine**2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)

    base = r.normal(size=(4000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    x = np.concatenate([base, mates(base[:1500], 0.999), mates(base[-12:], r.uniform(0.901, 0.92, (12, 1)))])
    ids = [7 * i + 1 for i in range(len(x))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = {a.vec_id: (a.n_links, a.component_id) for a in multi_index.near_duplicates(df).collect()}
    assert got == brute(ids, x)


def test_rows_of_one_key_with_other_vectors_count_each(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (7, [1.0, 0.01]), (3, [0.01, 1.0]), (5, [1.0, 0.0])]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in multi_index.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    assert got == [(3, 1, 3, True), (5, 1, 3, False), (5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False)]


def test_codewords_follow_the_table(spark):
    assert [multi_index.codewords_for(n) for n in (0, 50_000, 1_000_000, 10**10)] == [16, 20, 88, 1024]
    x = made(3, 3000, 24, [40, 2, 2, 2])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in multi_index.near_duplicates(df, codewords=200).collect()}
    assert got == brute(list(range(3000)), x.astype(float))
