import zipfile
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reviewlake import cli
from reviewlake.config import EUROPEAN, Settings
from reviewlake.sources import reviews as S
from reviewlake.sources import sinks
from reviewlake.streaming import live

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook(path, rows):
    cells = lambda r, k: "".join(f'<c r="{chr(65 + j)}{k}" t="s"><v>{v}</v></c>' for j, v in enumerate(r) if v is not None)
    texts = list(dict.fromkeys(v for r in rows for v in r if v is not None))
    body = "".join(f'<row r="{k}">{cells([None if v is None else texts.index(v) for v in r], k)}</row>' for k, r in enumerate(rows, 1))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets><sheet name="clauses" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">' + "".join(f"<si><t>{t}</t></si>" for t in texts) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>')


def test_xlsx(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", [["Review_Text", "Platfrom"], ["좋아요", "p"], [None, "q"]])
    rows = S.load_reviews(S.read_table(spark, f"file://{tmp_path}/a.xlsx")).orderBy("row_idx").collect()
    assert [(r.review, r.platform, r.source_file) for r in rows] == [("좋아요", "p", "a.xlsx"), (None, "q", "a.xlsx")]
    (tmp_path / "~$a.xlsx").touch()
    assert S.discover(str(tmp_path)) == [f"{tmp_path}/a.xlsx"]


def test_merged_files(spark, tmp_path):
    for name in ("x_clauses_clustered_1", "y_clauses_clustered_2", "other"):
        spark.createDataFrame([(name,)], "v string").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    frames = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("y_clauses_clustered_2", "x_clauses_clustered_1")}
    assert [(r.source_file, r.v) for r in S.merge_all(frames).collect()] == [(n, n) for n in sorted(frames)]
    assert sorted(r.source_file for r in S.read_merged(spark, str(tmp_path), "*.parquet").collect()) == ["other", "x_clauses_clustered_1", "y_clauses_clustered_2"]
    workbook(tmp_path / "z_clauses_clustered_3.xlsx", [["v"], ["z"]])
    (tmp_path / "a_clauses_clustered_0.xlsx").write_bytes(b"no workbook")
    read = S.read_merged(spark, str(tmp_path), "*_clauses_clustered_*", "xlsx").collect()
    assert [(r.source_file, r.v) for r in read] == [("z_clauses_clustered_3.xlsx", "z")]
    from reviewlake import tools

    out = tools.merge_all(spark, str(tmp_path), f"file://{tmp_path}/out", "parquet", "*.parquet")
    assert out.endswith("clauses_all") and spark.read.parquet(out).count() == 3


def test_rule_files_and_product_names(tmp_path, capsys):
    from reviewlake import tools

    assert S.product_key(" 청송 Apple_1! ") == "청송apple_1"
    (tmp_path / "facets_사과.yml").write_text("buckets: []")
    assert S.rules_for("사과", str(tmp_path), "given.yml", "t.yml") == (f"{tmp_path}/facets_사과.yml", "t.yml")
    assert S.rules_for("pear", str(tmp_path), "given.yml")[0] == "given.yml"
    assert tools.main(["resolve_rules", "사과", "pear", "--rules_dir", str(tmp_path)]) == 0
    told = capsys.readouterr().out.splitlines()
    assert len(told) == 3 and told[1].startswith("사과") and f"{tmp_path}/facets.yml" in told[2]


def test_clustered_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, l string")
    sinks.write_clustered(df, 1, f"file://{tmp_path}/c.csv")
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/c.csv").columns == ["k", "l"]
    for rows, name in ((2, "c.csv"), (1, "c.docx")):
        with pytest.raises(ValueError):
            sinks.write_clustered(df, rows, f"file://{tmp_path}/{name}")
    assert sinks.stamped("clauses", datetime(2024, 1, 31, 23, 59, 58)) == "clauses_240131_235958"


def test_state_versions(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    assert sinks.read_state(spark, path) is None
    for n in range(1, 4):
        sinks.write_state(spark.createDataFrame([("s", n), ("s", n)], "sig string, stable_id long"), path)
        assert [tuple(r) for r in sinks.read_state(spark, path).collect()] == [("s", n)]
    (tmp_path / "state/v000000009").mkdir()
    assert sinks.read_state(spark, path).first().stable_id == 3
    spark.createDataFrame([("s", 1, 99)], "sig string, stable_id long, version int").write.parquet(f"{path}/v000000010")
    assert sinks.read_state(spark, path) is None


def test_cache_computes_what_is_missing(spark, tmp_path):
    seen = []
    compute = lambda rows: (seen.append(rows.count()), rows.select("cache_key", "k"))[1]
    path = f"file://{tmp_path}/c"
    df = spark.range(10).withColumnRenamed("id", "k")
    assert sinks.cached(df.filter("k < 4"), ["k"], compute, path).count() == 4
    assert sinks.cached(df, ["k"], compute, path).count() == 10 and seen == [4, 6]
    odd = spark.createDataFrame([("a", None), ("a", None), (None, "a"), ("a", "")], "k string, l string")
    told = sinks.cached(odd, ["k", "l"], lambda r: r.select("cache_key", F.concat_ws("-", "k", "l").alias("n")), f"file://{tmp_path}/d")
    assert sorted(r.n for r in told.collect()) == ["a", "a", "a", "a-"]


def test_streams(spark, tmp_path):
    spark.createDataFrame([("1", "the pears. not good!!"), ("2", "zzz")], "review_id string, review string").write.parquet(f"{tmp_path}/in")
    src = spark.readStream.schema("review_id string, review string").parquet(f"{tmp_path}/in")
    q = live.polarized_stream(src, Settings(language=replace(EUROPEAN, positive=("the",), negative=("not",)))).writeStream.format("memory").queryName("told").start()
    q.processAllAvailable()
    q.stop()
    assert {(r.review_id, r.polarity) for r in spark.table("told").collect()} == {("1", "positive"), ("1", "negative"), ("2", "neutral")}
    spark.createDataFrame([("2024-01-01 00:01:00", "a"), ("2024-01-01 00:02:00", "a"), ("2024-01-01 02:00:00", "b")], "t string, k string").withColumn("t", F.col("t").cast("timestamp")).write.parquet(f"{tmp_path}/ev")
    ev = spark.readStream.schema("t timestamp, k string").parquet(f"{tmp_path}/ev")
    q = live.windowed_counts(ev, "t", "k").writeStream.outputMode("append").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert [(r.k, r.n) for r in spark.table("counts").collect()] == [("a", 2)]


def test_ids_of_repeated_batches(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    batch = spark.createDataFrame([(0, "a"), (1, "b"), (1003, "c"), (999, "n")], "c long, sig string")
    first = {r.c: r.stable_id for r in live.extend_stable_ids(batch, path, "c", "sig").collect()}
    again = {r.c: r.stable_id for r in live.extend_stable_ids(batch, path, "c", "sig").collect()}
    assert first == again == {0: 1, 1: 2, 1003: 1001, 999: 999}
    more = spark.createDataFrame([(5, "d"), (6, "b")], "c long, sig string")
    assert {r.c: r.stable_id for r in live.extend_stable_ids(more, path, "c", "sig").collect()} == {5: 3, 6: 2}


def test_command_line(spark, tmp_path):
    rows = [(("good pears taste sweet " if i % 2 else "bad and late gut ") + str(i), "p") for i in range(60)]
    spark.createDataFrame(rows, "review string, platform string").write.parquet(f"{tmp_path}/apple.parquet")
    args = ["--files", f"{tmp_path}/apple.parquet", "--output_dir", f"{tmp_path}/out", "--language", "european", "--rules_dir", str(tmp_path)]
    ids = []
    for more in ([], ["--resume"]):
        assert cli.main([*args, *more]) == 0
        told = spark.read.parquet(f"{tmp_path}/out/apple/clauses")
        ids.append(sorted(map(tuple, told.select("review_id", "clause", "stable_cluster_id").collect())))
    assert ids[0] == ids[1] and len(ids[0]) > 0
    assert (tmp_path / "out/apple/manifest.json").exists() and (tmp_path / "out/apple/cluster_stats").exists()


def test_all_datasets_of_both_folders(spark, tmp_path):
    for kind in ("review", "community"):
        (tmp_path / "data" / kind).mkdir(parents=True)
    workbook(tmp_path / "data/review/pear_1.xlsx", [["Review", "Platform"], *([f"맛이 좋아요 {i}", "p"] for i in range(12))])
    for n in (1, 2):
        workbook(tmp_path / f"data/community/pear_{n}.xlsx", [["플랫폼", "링크", "제목", "본문"], *(["p", f"l{n}{i}", f"배 이야기 {n} {i}", f"배 맛이 좋아요 {n}{i}."] for i in range(6))])
    (tmp_path / "community.yml").write_text("products: {pear: {aliases: ['배']}}\nfacets: {taste: ['맛']}\nban_terms: []\n")
    args = ["--all", "--data_dir", str(tmp_path / "data"), "--rules_dir", str(tmp_path), "--output_dir", f"{tmp_path}/out", "--rel_tau", "0.0", "--save_filter_debug"]
    assert cli.main(args) == 0
    assert spark.read.parquet(f"{tmp_path}/out/pear_1/reviews").count() == 12
    # Both post files are one run.
    assert spark.read.parquet(f"{tmp_path}/out/pear_community/filter_stats").first().total_sentences >= 12
    assert spark.read.parquet(f"{tmp_path}/out/pear_community/filter_debug").count() >= 12
    with pytest.raises(SystemExit):
        cli.main(["--all", "--mode", "community_filtered"])
