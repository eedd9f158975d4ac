"""Hand-made edge cases of the review operators."""

import json
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.config import EUROPEAN, KOREAN, Settings
from reviewlake.functions import labels as L
from reviewlake.functions import text as T
from reviewlake.functions import vectors as V
from reviewlake.operators import clusters as C
from reviewlake.operators import density, keywords, polarity, preprocess, relevance, report
from reviewlake.plans import reviews as plans
from reviewlake.sources import reviews as S
from reviewlake.sources import sinks

KO = Settings()
#: Function words stand in for praise and blame, as in the made-up tables.
MADE_UP = replace(EUROPEAN, positive=("the", "der"), negative=("not", "nicht"))
EN = Settings(language=MADE_UP)


def col(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_cleaning(spark):
    given = ["ㅋㅋ", "ㅋㅋㅋ", "ㅋㅋㅋㅋㅋㅋ!", "hm!! ok?!?!", "a😀,b ", " ½x_é ", None, "😀"]
    assert col(spark, given, T.clean) == ["ㅋㅋ", "ㅋㅋ", "ㅋㅋ!", "hm! ok!", "ab", "½x_é", "", ""]
    once = col(spark, given, T.clean)
    assert col(spark, [x.strip() for x in once], T.clean) == [x.strip() for x in once]


def test_dedupe_and_ids(spark):
    df = spark.createDataFrame([(2, "a!!"), (1, "a!"), (3, "b"), (0, "😀")], "n long, review string")
    got = preprocess.with_review_id(preprocess.preprocess(df, "n"), "n").orderBy("n").collect()
    assert [(r.n, r.review, r.review_id) for r in got] == [(1, "a!", "0"), (3, "b", "1")]
    many = preprocess.numbered(spark.range(1000).repartition(7), "id", "k")
    assert many.filter("id <> k").count() == 0


def test_headers(spark):
    df = spark.createDataFrame([("p", "x", None, "y", 1)], ["` `".strip("`") + "Platfrom ", "Product_Name", "Review_Text", "Comments", "Unnamed: 0"][0:5] and "` Platfrom ` string, Product_Name string, Review_Text string, Comments string, `Unnamed: 0` int")
    out = S.load_reviews(df)
    assert out.columns == ["platform", "product", "review"] and out.first() == ("p", "x", "y")
    assert S.load_reviews(spark.createDataFrame([("b",)], "body string")).columns == ["review"]
    with pytest.raises(ValueError, match="review"):
        S.load_reviews(spark.createDataFrame([(1,)], "z int"))


def test_posts_and_rules(spark, tmp_path):
    df = spark.createDataFrame([("네이버", None, "제목1", "본문1")], "`플랫폼` string, `링크` string, `제목` string, `본문` string")
    row = S.load_posts(df, "apple").first()
    assert row.summary == "" and row.date is None and row.post_id.startswith("C-apple-") and len(row.post_id) == 18
    with pytest.raises(ValueError, match="title"):
        S.load_posts(df.drop("제목"), "apple")
    facets = [{"id": "a b", "desc": "x"}]
    for given in (facets, {"buckets": facets}, {"facets": facets}, {"a b": {"desc": "x"}}):
        assert S.parse_facets(given)[0]["id"] == "ab"
    (tmp_path / "facets_apple.yml").write_text("buckets: []")
    assert S.rules_for("Apple", str(tmp_path)) == (f"{tmp_path}/facets_apple.yml", f"{tmp_path}/thresholds.yml")
    settings, on = S.with_thresholds(Settings(), {"refinement": {"enabled": False, "top_k_facets": 1, "hetero_sil_threshold": 0.2}})
    assert (settings.facet_top_k, settings.hetero_threshold, on) == (1, 0.2, False)


def test_settings_from_environment(monkeypatch):
    monkeypatch.setenv("COMMUNITY_REL_TAU", "0.7")
    assert Settings.from_env().community_rel_tau == 0.7 and Settings.from_env(community_rel_tau=0.1).community_rel_tau == 0.1


def split(spark, text, settings=KO):
    return col(spark, [text], lambda c: T.clauses(c, settings))[0]


def test_clauses(spark):
    assert split(spark, "맛은 정말 좋아요 하지만 배송이 느려요") == ["맛은 정말 좋아요", "하지만 배송이 느려요"]
    assert split(spark, "하나로 묶은 문장") == ["하나로 묶은 문장"]
    assert split(spark, "비가 온다면 집에서 쉬겠어요") == ["비가 온다면 집에서 쉬겠어요"]
    assert split(spark, "맛 하지만 배송이 느려요") == ["맛 하지만 배송이 느려요"]
    assert split(spark, "맛도 좋고 향도 아주 좋아요") == ["맛도 좋고", "향도 아주 좋아요"]
    five = " 그리고 ".join(f"단어{k}가나다 문장{k}라마" for k in "가나다라마")
    assert len(split(spark, five)) == 4
    rows = plans.clause_rows(spark.createDataFrame([("1", None), ("2", "  "), ("3", "A one. B two!")], "review_id string, review string"), KO).collect()
    assert [(r.review_id, r.clause_idx, r.clause) for r in rows] == [("3", 0, "A one."), ("3", 1, "B two!")]


def test_connectives_in_order(spark):
    got = col(spark, ["그리고 하지만 그리고", ""], lambda c: T.connectives(c, KOREAN))
    assert [(x.idx, x.kind) for x in got[0]] == [(0, "additive"), (4, "contrast"), (8, "additive")] and got[1] == []


def test_jaccard_and_queries(spark):
    df = spark.createDataFrame([([], []), (["a"], []), (["a", "b"], ["b", "c"])], "a array<string>, b array<string>")
    assert [round(r.j, 3) for r in df.select(T.jaccard(F.col("a"), F.col("b")).alias("j")).collect()] == [1.0, 0.0, 0.333]
    assert T.build_queries(["a", "", None, "a", *map(str, range(50))], 32) == ["a", *map(str, range(31))]
    bonus = col(spark, ["x", "xyz", "x y z w v"], lambda c: F.round(T.lexical_bonus(c, ["x", "x", "y", "z", "w"]), 6))
    assert bonus == [0.2, 0.3, 0.3]


def test_gate(spark):
    df = spark.createDataFrame([("사과 별로", 0.0, 0.9), ("금지", 0.9, 0.9), ("사과 금지", 0.1, 0.4), ("x", 0.39, 0.9), (None, 0.5, 0.5)], "s string, a double, t double")
    run = lambda mode: [r.k for r in df.select(relevance.gate(F.col("s"), F.col("a"), F.col("t"), ["사과"], ["금지"], 0.4, 0.4, mode).alias("k")).collect()]
    assert run("strict") == run("soft") == [True, False, True, False, True]
    assert run("off") == [True, True, True, False, True]
    with pytest.raises(ValueError):
        run("no")
    stats = relevance.filter_stats(spark.createDataFrame([], "kept boolean, alias_hit boolean, banned boolean")).first()
    assert tuple(stats) == (0, 0, 0.0, 0.0, 0.0, 0)


def test_summaries(spark):
    many = "\n".join(f"{'같은 머리말로 시작하는 아주 긴 문장이며 삼십이 글자를 넘기는 것 ' if i < 3 else ''}문장 {i} {'가' * i}." for i in range(14))
    got = col(spark, [many, "a\nb", "", "one. two"], lambda c: relevance.extractive_summary(T.community_sentences(c), 10))
    assert len(got[0]) == 10 and sum(s.startswith("같은") for s in got[0]) == 1 and got[1] == ["a", "b"] and got[2] == [] and got[3] == ["one.", "two"]
    rows = spark.createDataFrame([("t", "b1. b2.", " s1. s2. "), ("t", "b", " "), (None, None, None)], "t string, b string, s string")
    out = [r.y for r in rows.select(relevance.summarize_row(F.col("t"), F.col("b"), F.col("s"), 1).alias("y")).collect()]
    assert out == [["s1."], ["t"], []]


def test_labels(spark):
    assert col(spark, ["other", "-1", "nan", None, "7", " 7 ", "x", "7.5"], L.coerce_label) == [-1, -1, -1, -1, 7, 7, -1, -1]
    df = spark.createDataFrame([(-1, "negative"), (3, "neutral"), (-1, "positive"), (2, "?")], "l int, p string")
    assert [r.y for r in df.select(L.label_offset(F.col("l"), F.col("p")).alias("y")).collect()] == [999, 1003, 2999, 2]


def test_merge_chain_and_empty(spark):
    items = spark.createDataFrame([(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in ((5, 0.0), (7, 0.3), (9, 0.6), (11, 2.0))], "c long, v array<double>")
    pairs = C.merge_candidates(items, "c", "v", 0.93)
    assert sorted((r.cid1, r.cid2) for r in pairs.collect()) == [(5, 7), (7, 9)]
    assert sorted(tuple(r) for r in C.merge_map(items, pairs, "c").collect()) == [(5, 0), (7, 0), (9, 0), (11, 1)]
    assert C.merge_map(items.limit(0), pairs.limit(0), "c").count() == 0
    assert C.dynamic_threshold(pairs.limit(0), 90).first().threshold == 0.999


def test_facets_keep_given_values(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0], "old", "[]"), (2, [0.0, 1.0], " ", '[["z",1]]'), (3, [-1.0, -1.0], None, None)], "k int, v array<double>, facet_top1 string, facet_topk string")
    facets = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "id string, emb array<double>")
    got = [tuple(r) for r in C.facet_annotate(rows, "k", "v", facets, 5, 0.32).orderBy("k").select("facet_top1", "facet_topk").collect()]
    assert got == [("old", '[["a",1.0000]]'), ("b", '[["z",1]]'), (None, None)]


def test_stable_ids_over_runs(spark):
    first = spark.createDataFrame([(0, "s0"), (3, "s3"), (5, "s3"), (999, "n"), (1001, "t")], "c long, sig string")
    a = {r.c: r.stable_id for r in C.stable_ids(first, "c", "sig").collect()}
    assert a == {0: 1, 3: 2, 5: 2, 999: 999, 1001: 1001}
    state = spark.createDataFrame([("s3", 2), ("s0", 1), ("t", 1001)], "sig string, stable_id long")
    second = spark.createDataFrame([(9, "s3"), (4, "new"), (1005, "t")], "c long, sig string")
    b = {r.c: r.stable_id for r in C.stable_ids(second, "c", "sig", state, {0: 1002, 1: 1001, 2: 1000}).collect()}
    assert b == {9: 2, 4: 3, 1005: 1001}
    full = C.stable_ids(second.limit(2), "c", "sig", None, {0: 1998, 1: 0, 2: 0}).collect()
    assert sorted(r.stable_id for r in full) == [0, 998]


def test_report_edges(spark):
    reviews = spark.createDataFrame([("a", "2023-01-02"), ("a", "bad"), (None, "2024-05-01 10:00:00"), ("b", None)], "platform string, date string")
    said = spark.createDataFrame([("a", "positive"), ("a", "negative"), ("a", "negative"), (None, "neutral")], "platform string, polarity string")
    block = {r.platform: tuple(r)[1:] for r in report.platform_block(reviews, said).collect()}
    assert block == {"a": (2, 3, 33.3, 0.0, 66.7), "b": (1, 0, 0.0, 0.0, 0.0), "unknown": (1, 1, 0.0, 0.0, 0.0), "전체": (4, 4, 25.0, 25.0, 50.0)}
    wide = report.platform_metrics(report.platform_block(reviews, said), ["a", "b"]).collect()
    assert wide[0]["메트릭"] == "수집된 데이터 수" and wide[0]["전체"] == 4.0 and wide[2]["a"] == 33.3
    assert [tuple(r) for r in report.year_ratio(reviews, F.col("date")).collect()] == [(2023, 1, 50.0), (2024, 1, 50.0)]
    with pytest.raises(ValueError):
        report.require_facets(spark.createDataFrame([(None,)], "f string"), "f")
    modes = spark.createDataFrame([(1, "b", 0), (1, "a", 1), (2, " ", 2), (2, None, 3)], "g int, v string, o int")
    assert {r.g: r.v for r in report.mode_by(modes, "g", "v", "o").collect()} == {1: "b", 2: ""}


def test_silhouettes_agree_with_numpy(spark):
    r = np.random.default_rng(2)
    x, y = r.normal(size=(40, 5)), np.array([0] * 15 + [1] * 24 + [2])
    df = spark.createDataFrame([(i, int(l), v.tolist()) for i, (l, v) in enumerate(zip(y, x))], "k int, l int, v array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for made, d in ((C.silhouette_cosine, 1 - u @ u.T), (C.silhouette_euclid, density._distances(x))):
        got = np.mean([s.sil for s in made(df, "k", "l", "v").collect()])
        assert abs(got - density.silhouette(d, y)) < 1e-6
    with pytest.raises(ValueError):
        C.silhouette_euclid(df, "k", "l", "v", rows=10)


def test_density_clusters(spark):
    r = np.random.default_rng(0)
    x = np.vstack([r.normal(size=(50, 3)) * 0.1 + c for c in ([0, 0, 0], [3, 0, 0], [0, 3, 0])] + [r.uniform(-9, 9, (12, 3))])
    labels = density.hdbscan(x, 10, 5)
    assert [len(set(labels[i : i + 50])) for i in (0, 50, 100)] == [1, 1, 1] and len(set(labels[:150])) == 3 and (labels[150:] == -1).mean() > 0.7
    assert (density.hdbscan(x[:3], 10, 5) == -1).all()
    assert (density.hdbscan(np.zeros((40, 2)), 5, 3) >= -1).all()
    k, s, _ = density.best_split(x[:100], 4)
    assert k == 2 and s > 0.8 and density.best_split(x[:5], 4)[0] == 1
    w = density._distances(x[:30])
    assert abs(sum(e[0] for e in density.spanning_tree(30, lambda i: w[i])) - _kruskal(w)) < 1e-9
    assert np.allclose(density.core_distances(x, 5), np.sort(density._distances(x), axis=1)[:, 5], atol=1e-6)
    df = spark.createDataFrame([(1, i, v.tolist()) for i, v in enumerate(x[:100])], "c int, k int, v array<double>")
    parts = density.refine_split(df, "c", "k", "v", 35, 0.16).toPandas()
    assert set(parts.refined_label) == {10, 11}


def test_large_groups_are_labelled_whole(spark):
    """Beyond max_rows a bounded part is fitted and every further row finds its cluster or noise; no row is lost."""
    r = np.random.default_rng(1)
    centres = np.array([[0, 0], [8, 0], [0, 8]])
    x = np.vstack([r.normal(size=(300, 2)) * 0.3 + c for c in centres] + [[[40.0, 40.0]]])
    df = spark.createDataFrame([(1, i, v.tolist()) for i, v in enumerate(x)], "c int, k int, v array<double>").repartition(4)
    got = {t.k: t.cluster_label for t in density.cluster_groups(df, "c", "k", "v", 20, 5, max_rows=300).collect()}
    assert len(got) == 901 and got[900] == -1
    tops = []
    for b in range(3):
        own = [got[i] for i in range(300 * b, 300 * b + 300)]
        tops.append(max(set(own), key=own.count))
        assert own.count(tops[-1]) > 240 and tops[-1] >= 0
    assert len(set(tops)) == 3
    two = spark.createDataFrame([(3, i, x[i % 600].tolist()) for i in range(600)], "c int, k int, v array<double>")
    parts = {t.k: t.refined_label for t in density.refine_split(two, "c", "k", "v", 35, 0.16, max_rows=100).collect()}
    assert len(parts) == 600 and {parts[i] for i in range(300)} != {parts[i] for i in range(300, 600)} and set(parts.values()) == {30, 31}
    whole = density.heterogeneity(two, "c", "k", "v", max_rows=100).first()
    assert whole.n == 600 and whole.best_k == 2


def _kruskal(w):
    root, total = list(range(len(w))), 0.0

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in sorted(((i, j) for i in range(len(w)) for j in range(i)), key=lambda p: w[p]):
        x, y = find(a), find(b)
        if x != y:
            root[x], total = y, total + w[a, b]
    return total


def test_tuner(spark):
    sizes = [0, 1, 499, 500, 1999, 2000, 5999, 6000, 7999, 8000, 15999, 16000]
    df = spark.createDataFrame([(n,) for n in sizes], "n int")
    got = {r.n: r for r in C.tuner_params(df, F.col("n"), F.lit(False)).collect()}
    assert [got[n].n_components for n in sizes] == [8, 8, 8, 10, 10, 12, 12, 12, 12, 13, 13, 14]
    assert (got[5999].min_cluster_size, got[6000].min_cluster_size, got[0].min_samples) == (60, 30, 2)


def test_keywords(spark):
    df = spark.createDataFrame([("a", 1, "apple apple pear"), ("a", 2, "pear"), ("b", 3, "12"), ("b", 4, None)], "c string, d int, t string")
    got = keywords.tfidf_keywords(df, "c", "d", "t", "[a-z]{4,}", [], 1).collect()
    assert [(r.c, r.term) for r in got] == [("a", "pear")]


def test_embedding_and_cosine(spark):
    v = col(spark, [["a", "b", "a"], [], None], lambda c: V.hash_embed(c, 8), "array<string>")
    assert abs(sum(x * x for x in v[0]) - 1) < 1e-9 and v[1] == [0.0] * 8


def test_names(spark):
    df = spark.createDataFrame([(0, ["a", "b"]), (1, ["a", "b", "c"]), (2, ["a"]), (3, [])], "c long, w array<string>")
    assert {r.c: r.name for r in C.cluster_names(df, "c", "w").collect()} == {0: "a·b", 1: "c·a", 2: "a", 3: ""}


def made_reviews(spark, n=160):
    r = random.Random(4)
    good, bad = "the pears taste sweet and fresh today", "not a crisp box it came late nicht gut"
    rows = [(i, (good if i % 2 else bad) + f" {r.choice(['red', 'green', 'blue'])} {i}", ["p", "q", None][i % 3], f"202{i % 4}-01-01") for i in range(n)]
    return spark.createDataFrame(rows, "row_idx long, review string, platform string, date string")


def test_whole_runs(spark, tmp_path):
    facets = [{"id": "taste", "name": "taste", "desc": "sweet fresh pears"}, {"id": "delivery", "name": "delivery", "desc": "late box came"}]
    out = plans.run_reviews(made_reviews(spark), EN, "row_idx", facets=facets, min_cluster_size=20)
    told = out["clauses"].toPandas()
    assert len(told) and told.stable_cluster_id.notna().all() and set(told.polarity) <= {"negative", "positive", "neutral"}
    assert out["mapping"].count() == told.review_id.nunique() and out["reviews"].count() == 160
    assert out["rep_summary"].count() >= 2 and out["year_ratio"].count() == 4
    paths = sinks.write_sheets({k: out[k] for k in ("rep_summary", "platform_block")}, f"file://{tmp_path}/s")
    assert spark.read.parquet(paths["rep_summary"]).count() == out["rep_summary"].count()
    sinks.write_manifest(f"{tmp_path}/m.json", Settings(), input="x")
    assert json.loads((tmp_path / "m.json").read_text())["settings"]["confidence"] == 0.6
    empty = plans.run_reviews(made_reviews(spark).limit(0), EN, "row_idx")
    assert empty["clauses"].count() == 0


def test_community_run(spark):
    posts = spark.createDataFrame([("p", f"l{i}", None, f"Apple talk {i}", f"the apple is sweet {i}. nothing here {i}.", "", "apple", f"C-{i}") for i in range(8)], "platform string, link string, date string, title string, body string, summary string, product string, post_id string")
    kept, stats, scored = plans.run_posts(posts, EN, ["apple"], ["sweet"], ["banned"])
    assert scored.count() == stats.first().total_sentences and 0 < kept.count() <= scored.count()
    assert all(r.review_id.startswith("C-") and "-s" in r.review_id for r in kept.collect())


def test_confidence_filter(spark):
    df = spark.createDataFrame([("the the",), ("not",), ("zzz the not",)], "clause string")
    rows = polarity.classify(df, EN).collect()
    assert [(r.polarity, round(r.confidence, 3)) for r in rows] == [("positive", 0.833), ("negative", 0.75), ("neutral", 0.333)]


def test_korean_polarity_by_stems(spark):
    df = spark.createDataFrame([("정말 맛있어요 신선하고 좋습니다",), ("별로예요 실망했어요 썩었네요",), ("보통이에요",)], "clause string")
    assert [r.polarity for r in polarity.classify(df, KO).collect()] == ["positive", "negative", "neutral"]


def test_state_and_caches_over_runs(spark, tmp_path):
    seen = []

    def model(df, clause):
        seen.append(df.count())
        return polarity.classify(df, EN, clause)

    run = lambda resume: plans.run_reviews(
        made_reviews(spark, 80), EN, "row_idx", model=model, min_cluster_size=15, dataset="a", state_path=f"file://{tmp_path}/state", cache_dir=f"file://{tmp_path}/cache", resume=resume
    )["clauses"].select("review_id", "clause", "stable_cluster_id").collect()
    first, again = sorted(map(tuple, run(False))), sorted(map(tuple, run(True)))
    assert first == again and len(first) > 0
    assert seen[0] > 0 and seen[1] == 0
    state = sinks.read_state(spark, f"file://{tmp_path}/state")
    assert {r.stable_id for r in state.collect()} >= {x[2] for x in first if x[2] % 1000 != 999}


def test_percentile_threshold_and_gate(spark):
    out = plans.run_reviews(made_reviews(spark, 80), replace(EN, merge_percentile=0.0), "row_idx", min_cluster_size=15)
    labels = {r.cluster_id for r in out["clauses"].select("cluster_id").distinct().collect()}
    assert all(len({x for x in labels if x // 1000 == p and x % 1000 != 999}) <= 1 for p in range(3))
    rows = spark.createDataFrame([("1", "맛은 정말 좋아요 그리고 맛은 정말 좋아요 별로")], "review_id string, review string")
    assert plans.clause_rows(rows, KO).count() <= plans.clause_rows(rows, KO, gate=True).count()


def test_sheets_and_small_reports(spark):
    clauses = spark.createDataFrame([(1, "a", "other", ["x"]), (2, "b", "3", None)], "review_id int, clause string, cluster_id string, l array<string>")
    reviews = spark.createDataFrame([(1,), (2,)], "review_id int")
    sheets = report.workbook(clauses, reviews, reviews, meta=spark.createDataFrame([("k", "v")], "key string, value string"))
    assert [tuple(r) for r in sheets["clauses"].orderBy("review_id").collect()] == [("1", "a", -1, '["x"]'), ("2", "b", 3, None)] and set(sheets) == {"clauses", "mapping", "reviews", "meta"}
    with pytest.raises(ValueError, match="clause"):
        report.workbook(reviews, reviews, reviews)
    assert report.columns_lost(clauses, reviews) == ["clause", "cluster_id", "l"]
    one = spark.createDataFrame([("b",)], "facet_bucket string")
    assert tuple(report.ensure_top1(one).first()) == ("b", "b", None) and report.ensure_top1(reviews).first().facet_top1 is None
    assert tuple(report.cluster_quality(spark.createDataFrame([(1, "other", [1.0], [1.0])], "k int, l string, u array<double>, v array<double>"), "k", "l", "u", "v").first()) == (None, None, 0, 1, 0)
    moved = L.relabel(spark.createDataFrame([("2", "positive"), ("other", "neutral")], "k string, p string"), "k", "p")
    assert [r.k for r in moved.collect()] == [2002, 1999]
    noise = spark.createDataFrame([(5, "positive", "f", 0), (999, "neutral", "f", 1)], "c int, p string, f string, o int")
    reps = spark.createDataFrame([(5, "r")], "c int, rep string")
    assert report.rep_summary(noise, reps, "c", "p", "f", "o").count() == 2 and report.rep_summary(noise, reps, "c", "p", "f", "o", exclude_noise=True).count() == 1
    assert S.load_reviews(spark.createDataFrame([("a", "p")], "review string, platform string"), keep_meta=False).columns == ["review"]


def test_keywords_by_hook_and_by_vectors(spark):
    df = spark.createDataFrame([("a", 1, "apples apples pear"), ("a", 2, "pears")], "c string, d int, t string")
    stem = lambda c: F.transform(T.tokens(c, "[a-z]+"), lambda t: F.regexp_replace(t, "s$", ""))
    assert [r.term for r in keywords.tfidf_keywords(df, "c", "d", "t", "x", [], 1, normalize=stem).collect()] == ["pear"]
    near = keywords.keybert_like(df, "c", "d", "t", "[a-z]+", 16, top=2, multiplier=1).collect()
    apart = keywords.keybert_like(df, "c", "d", "t", "[a-z]+", 16, top=2, multiplier=2).collect()
    assert len(near) == len(apart) == 2 and {r.term for r in apart} <= {"apples", "pear", "pears"}
    vectors = {t: np.array(V.hash_embed_text(t, "[a-z]+", 16)) for t in ("apples", "pear", "pears")}
    least = min(float(vectors[a] @ vectors[b]) for a, b in (("apples", "pear"), ("apples", "pears"), ("pear", "pears")))
    assert abs(float(vectors[apart[0].term] @ vectors[apart[1].term]) - least) < 1e-9


def test_counted_tokens(spark):
    got = col(spark, [["b", "a", "b"], [], None], T.counted, "array<string>")
    assert [[(x.term, x.n) for x in g or []] for g in got] == [[("a", 1), ("b", 2)], [], []]


def test_queries_on_the_driver_equal_the_column(spark):
    text = "Pears and apples and nuts"
    row = spark.range(1).select(V.hash_embed(T.tokens(F.lit(text), "[A-Za-z]{2,}"), 8).alias("v")).first()
    assert np.allclose(row.v, V.hash_embed_text(text, "[A-Za-z]{2,}", 8))


def test_models_are_adapters(spark):
    from reviewlake.functions import models

    embed = models.embedder("lengths", lambda: lambda texts: [[len(t), 0.0] for t in texts], batch=2)
    df = spark.createDataFrame([("abc",), (None,), ("x",)], "t string")
    assert [r.embedding for r in embed(df, "t").collect()] == [[1.0, 0.0], [0.0, 0.0], [1.0, 0.0]]
    with pytest.raises(ValueError, match="no text"):
        embed(df.limit(0), "t")
    told = models.classifier("upper", lambda: lambda texts: [("Positive" if "a" in t else "odd", 0.9) for t in texts], batch=1)(df, "t")
    assert [(r.polarity, r.confidence) for r in told.collect()] == [("positive", 0.9), ("neutral", 0.0), ("neutral", 0.0)]


def test_sentences_are_numbered_by_posts(spark):
    from reviewlake.operators.relevance import flatten_sentences
    from reviewlake.session import spread

    rows = [("b", ["x", "y"]), ("a", ["z"]), ("d", None), ("c", []), ("e", ["u", "v", "w"])]
    posts = spark.createDataFrame(rows, "id string, own array<string>")
    got = flatten_sentences(spread(posts), F.col("own"), "id").orderBy("serial").select("id", "sent_pos", "sentence", "serial").collect()
    assert [tuple(r) for r in got] == [("a", 0, "z", 1), ("b", 0, "x", 2), ("b", 1, "y", 3), ("e", 0, "u", 4), ("e", 1, "v", 5), ("e", 2, "w", 6)]
    assert flatten_sentences(spread(posts.limit(0)), F.col("own"), "id").count() == 0
