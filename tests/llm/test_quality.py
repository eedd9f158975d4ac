import numpy as np

from reviewlake.llm import quality


def test_features_by_hand(spark):
    text = "Aa bb BB\naa bb bb\n\nxx1 !!! ##"
    got = quality.features(spark.createDataFrame([(1, text), (2, None), (3, ""), (4, text)], "k long, text string"), ("k",)).collect()
    x = {r.k: dict(zip(quality.FEATURES, r.x)) for r in got}
    f = x[1]
    assert f == x[4] and set(x[2].values()) == set(x[3].values()) == {0.0}
    assert np.isclose(f["log_words"], np.log1p(9)) and np.isclose(f["mean_word"], 20 / 9) and np.isclose(f["top_word"], 4 / 9)
    assert np.isclose(f["distinct_words"], 5 / 9) and np.isclose(f["repeated_next"], 2 / 9) and np.isclose(f["mark_runs"], 2 / 9)
    assert np.isclose(f["lines_a_word"], 4 / 9) and np.isclose(f["distinct_lines"], 2 / 3) and np.isclose(f["sentence_ends"], 1 / 9)


def test_model_learns_an_interaction():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    m = quality.fit(x[:2000], y[:2000])
    assert (0, 1) in m.pairs
    assert ((m.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9


def test_query_on_odd_rows(spark, tmp_path):
    good, bad = "Some words of a plain text, here. ", "BUY!! NOW!! BUY!! "
    rows = [(i, (good if i % 3 else bad) * (1 + i % 5)) for i in range(200)] + [(500, None), (501, ""), (502, good * 9000), (None, bad), (7, good)]
    labels = [(i, int(bool(i % 3)), 0) for i in range(0, 200, 2)] + [(None, 1, 0), (3, None, 1)]
    spark.createDataFrame([(*x, 5) for x in rows], "doc_id long, text string, quality int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = quality.op7_additive_quality(spark, str(tmp_path)).collect()
    assert len(got) == 205 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in got)
    assert all(x.predicted == int(bool(x.doc_id % 3)) for x in got if x.doc_id is not None and x.doc_id < 200 and x.doc_id != 7)
    for name, schema in (("documents", "doc_id long, text string"), ("labels", "doc_id long, quality int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/e/{name}.parquet")
    assert quality.op7_additive_quality(spark, f"{tmp_path}/e").count() == 0


def slow_fit(x, y):
    """The additive model by plain loops over rows, bins and cuts: edges, cyclic trees of one feature, then of the best pairs."""
    n, width = x.shape
    edges = []
    for i in range(width):
        found = []
        for q in range(1, quality.BINS):
            v = float(np.quantile(x[:, i], q / quality.BINS))
            if v not in found:
                found.append(v)
        edges.append(sorted(found))
    bins = [[sum(1 for e in edges[i] if e <= x[r, i]) for i in range(width)] for r in range(n)]
    bias = np.log(y.mean() / (1 - y.mean()))
    f = [bias] * n
    tables = [[0.0] * (len(e) + 1) for e in edges]

    def gradients():
        p = [1 / (1 + np.exp(-v)) for v in f]
        return [a - b for a, b in zip(y, p)], [b * (1 - b) for b in p]

    def tree(g, h, leaves):
        parts = [(0, len(g))]

        def gain(a, c, b):
            one = lambda lo, hi: sum(g[lo:hi]) ** 2 / (sum(h[lo:hi]) + 1)
            return one(a, c) + one(c, b) - one(a, b)

        while len(parts) < leaves:
            options = [(gain(a, c, b), k, c) for k, (a, b) in enumerate(parts) for c in range(a + 1, b)]
            top = max((o[0] for o in options), default=-1.0)
            if top <= 1e-9:
                break
            # The first best cut of a part; of equal parts the one with the later cut, then the later part.
            best = max(((v, c, k) for k in range(len(parts)) for v, c in [max(((v, -c) for v, kk, c in options if kk == k), default=(-1.0, 0))] for c in [-c]))
            _, c, k = best
            a, b = parts[k]
            parts[k : k + 1] = [(a, c), (c, b)]
        out = [0.0] * len(g)
        for a, b in parts:
            for t in range(a, b):
                out[t] = sum(g[a:b]) / (sum(h[a:b]) + 1)
        return out

    def by(keys, values, size):
        out = [0.0] * size
        for k, v in zip(keys, values):
            out[k] += v
        return out

    for _ in range(quality.ROUNDS):
        for i in range(width):
            g, h = gradients()
            own = [b[i] for b in bins]
            step = tree(by(own, g, len(tables[i])), by(own, h, len(tables[i])), quality.LEAVES)
            tables[i] = [t + quality.RATE * s for t, s in zip(tables[i], step)]
            f = [v + quality.RATE * step[k] for v, k in zip(f, own)]
    m = quality.BINS // 4
    coarse = [[b // 4 for b in row] for row in bins]
    g, h = gradients()
    gains = []
    for i in range(width):
        for j in range(i + 1, width):
            keys = [r[i] * m + r[j] for r in coarse]
            gains.append((sum(a * a / (b + 1) for a, b in zip(by(keys, g, m * m), by(keys, h, m * m))), i, j))
    pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[: quality.PAIRS]]
    pair_tables = [np.zeros((m, m)) for _ in pairs]
    for _ in range(quality.PAIR_ROUNDS):
        for t, (i, j) in zip(pair_tables, pairs):
            g, h = gradients()
            gg, hh = np.zeros((m, m)), np.zeros((m, m))
            for r, a, b in zip(coarse, g, h):
                gg[r[i], r[j]] += a
                hh[r[i], r[j]] += b
            rows = np.array(tree(gg.sum(1).tolist(), hh.sum(1).tolist(), 2))
            step = np.zeros((m, m))
            for v in sorted(set(rows.tolist())):
                side = rows == v
                step[side] = tree(gg[side].sum(0).tolist(), hh[side].sum(0).tolist(), 2)
            t += quality.RATE * step
            f = [v + quality.RATE * step[r[i], r[j]] for v, r in zip(f, coarse)]
    return f


def test_fit_and_score_equal_plain_loops(monkeypatch):
    for name, value in (("ROUNDS", 4), ("PAIR_ROUNDS", 3), ("PAIRS", 2), ("BINS", 16)):
        monkeypatch.setattr(quality, name, value)
    r = np.random.default_rng(7)
    x = np.round(r.normal(size=(160, 4)), 2)
    x[:, 3] = r.integers(0, 3, 160)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * r.normal(size=160)) > 0).astype(float)
    model = quality.fit(x, y)
    slow = np.array(slow_fit(x, y))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-slow)), atol=1e-9)


def test_held_out_ranking_of_the_made_documents(spark):
    labels = {x.doc_id: x.quality for x in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = [(x.score, labels[x.doc_id]) for x in quality.op7_additive_quality(spark, "/root/testdata/sf0.01").collect() if x.held_out and x.doc_id in labels]
    good, bad = [s for s, q in got if q == 1], [s for s, q in got if q == 0]
    assert len(good) > 20 and len(bad) > 5
    assert np.mean([[a > b for b in bad] for a in good]) > 0.97
