import numpy as np

from reviewlake.llm import language_id as li

TEXTS = ["Hallo Welt, wie geht's?", "the cat and the dog", "a", "é", "", None, "123 !!", "ab" * 40000, "İstanbul Straße", "Добрый день, мир", "\U00030000\U00030001", "日本語のテキスト"]


def brute_vector(text, dimensions):
    """The sum of explicit trigram vectors, letter by letter."""
    s, out = [0], np.zeros(dimensions)
    for c in (text or "").lower():
        x = ord(c) if c.isalpha() else 0
        if x or s[-1]:
            s.append(x)
    if s[-1]:
        s.append(0)
    own = {x: li.letter_vectors(np.array([x]), dimensions)[0].astype(float) for x in set(s)}
    for a, b, c in zip(s, s[1:], s[2:]):
        if b:
            out += np.roll(own[a], 2) * np.roll(own[b], 1) * own[c]
    return out


def sums(row, ids, n, dimensions):
    found, counts = np.unique(ids[row == n], return_counts=True)
    return li.bundled(found, counts, dimensions, li.SEED)


def test_tables_equal_explicit_hypervectors(monkeypatch):
    monkeypatch.setattr(li, "BLOCK_TRIGRAMS", 3)
    row, ids = li.trigrams(TEXTS)
    protos = []
    for n, t in enumerate(TEXTS):
        v = brute_vector(t, 128)
        assert np.array_equal(sums(row, ids, n, 128), v.astype(np.int64))
        protos.append(v)
    for tables, cache_bytes in ((32, 1 << 20), (0, 1 << 20), (32, 200)):
        monkeypatch.setattr(li, "TABLE_LANGUAGES", tables)
        monkeypatch.setattr(li, "CACHE_BYTES", cache_bytes)
        dots = li.Dots(np.array([protos[0], protos[9], protos[11]]), 128, li.SEED)
        found = np.concatenate([dots.of(ids[a : a + 7000]) for a in range(0, len(ids), 7000)])
        for n in range(len(TEXTS)):
            for k, p in enumerate((0, 9, 11)):
                want = protos[n] @ protos[p] / np.linalg.norm(protos[p])
                assert abs(found[row == n, k].astype(float).sum() - want) < 1e-2 * max(1, abs(want))


def test_every_letter_has_a_vector_of_its_own():
    points = np.flatnonzero(li.letter_table())
    some = np.concatenate([points[:3000], points[-3000:]])
    v = li.letter_vectors(some, 256)
    assert len({x.tobytes() for x in v}) == len(some)
    assert not np.array_equal(*li.letter_vectors(np.array([ord("б"), ord("і")])))
    assert abs(li.letter_vectors(points[:400]).astype(float).mean()) < 0.01
    assert len(li.COMMON) == li.SYMBOLS == len(set(li.COMMON))


def test_query_on_odd_rows_and_held_out_accuracy(spark, tmp_path):
    r = np.random.default_rng(1)
    make = {"en": ["the", "and", "thing", "ing"], "de": ["der", "und", "schön", "keit"], "uk": ["що", "їжа", "день"], "ru": ["что", "еда", "день"], "ja": ["日本", "語の", "テキスト"]}
    rows = [(i, " ".join(r.choice(make[x], 30)), x) for i in range(150) for x in [list(make)[i % 5]]]
    odd = [(1000, None, "en"), (1001, "", "de"), (1002, "12 !?", "en"), (1003, "the " * 60000, None), (None, "der und", "de"), (5, rows[5][1], "uk"), (1004, "\U00030000\U00030001", None), (1005, "日本語", "")]
    spark.createDataFrame([(*x, "s", 1.0) for x in rows + odd], "doc_id long, text string, lang string, lang_pred string, score double").write.parquet(f"{tmp_path}/documents.parquet")
    got = li.op6_hyperdimensional_lang(spark, str(tmp_path)).collect()
    assert len(got) == 158 and all(0 <= x.score <= 1 for x in got)
    by = {x.doc_id: x for x in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "en"]
    # Letters of the third plane are letters: such a text gets some learned language.
    assert by[1004].lang_pred != "und"
    assert all(by[i].lang_pred == x for i, _, x in rows)
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/e/documents.parquet")
    assert li.op6_hyperdimensional_lang(spark, f"{tmp_path}/e").count() == 0
    spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/n/documents.parquet")
    assert li.op6_hyperdimensional_lang(spark, f"{tmp_path}/n").first().lang_pred == "und"


def test_prototypes_of_many_languages_are_sums_of_texts(spark, monkeypatch):
    rows = [(f"l{i % 40:02d}", f"text {i} слово{'ab' * (i % 7)}") for i in range(200)]
    names, protos = li.learn(spark.createDataFrame(rows, "lang string, text string").repartition(3), dimensions=128)
    assert names == sorted({x for x, _ in rows})
    for k, name in enumerate(names):
        assert np.array_equal(protos[k], sum(brute_vector(t, 128) for x, t in rows if x == name).astype(np.int64))


def test_own_norms_equal_explicit_hypervectors(monkeypatch):
    monkeypatch.setattr(li, "BLOCK_TEXTS", 2)
    monkeypatch.setattr(li, "BLOCK_TRIGRAMS", 3)
    row, ids = li.trigrams(TEXTS)
    want = [np.linalg.norm(brute_vector(t, 128)) for t in TEXTS]
    assert np.allclose(li.own_norms(row, ids, len(TEXTS), 128), want, rtol=1e-5)
