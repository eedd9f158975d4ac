import random
from collections import Counter

import pytest

import corpus_pipeline as cp
from tests.llm.test_mixing import brute as brute_mix
from tests.llm.test_ngram_join import brute as brute_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCAB = {"en": "the and of thing with from that this water house road green".split(), "de": "der die und schön wasser haus straße grün mit von keit ung".split()}


def prose(r, lang, n):
    words = [r.choice(VOCAB[lang]) + r.choice(["", "", "s", "er"]) for _ in range(n)]
    return ". ".join(" ".join(words[i : i + 9]) for i in range(0, n, 9)) + "."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r, out = random.Random(11), tmp_path_factory.mktemp("pipe")
    rows, labels = [], []
    for i in range(260):
        lang = "en" if i % 3 else "de"
        text = prose(r, lang, r.choice([20, 60, 150]))
        if i % 13 == 5:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif i % 17 == 3:
            text = "123 456 789 " * 9
        elif i % 7 == 2 and rows:
            text = rows[r.randrange(len(rows))][1] + r.choice(["", " end"])
        rows.append((i + 1, text, lang, f"s{i % 5 if i % 2 else 0}", len(text)))
        labels.append((i + 1, 0 if "!!" in text else 1, 0))
    rows += [(900, None, "en", None, 0), (901, "", "de", "s1", 0), rows[7], (None, prose(r, "en", 50), None, "s2", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out)


def test_stages_one_by_one(spark, folder, tmp_path):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, folder)
        assert k == 4 or out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append([tuple(x) for x in docs.collect()])
    given = [tuple(x) for x in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    good = {x[0] for x in kept[0]}
    assert all(x[0] not in good for x in given if x[1] and "!!" in x[1])
    assert all(x[0] in good for x in given if x[1] and "!!" not in x[1] and "123" not in x[1])
    told = {x[0] for x in kept[1]}
    assert all(x[0] in told for x in kept[0] if x[1] and "123" not in x[1]) and all(any(c.isalpha() for c in x[1] or "") for x in kept[1])
    groups = {k: c for k, _, c in brute_groups([(x[0], x[1]) for x in kept[1]], 5, 80)}
    assert Counter(x[0] for x in kept[2]) == Counter({k for k, c in groups.items() if k == c and k != -1} | ({None} if -1 in groups else set()))
    sizes = {(x[0], x[3]): len(x[1].split()) for x in kept[2]}
    _, taken = brute_mix([(k, s, n) for (k, s), n in sizes.items()])
    assert Counter((x[0], x[3]) for x in kept[3]) == Counter({k: n // sizes[k] for k, n in taken.items() if n})
    pieces, totals, copies = Counter(), {}, Counter(x[0] for x in kept[3])
    for x in docs.collect():
        pieces[x.doc_id] += x.length
        totals[x.doc_id] = x.doc_tokens
    assert pieces == {k: n * totals[k] for k, n in copies.items()}


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert cp.run(spark, folder).count() > 0
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_texts_in_no_learned_language_go(spark, tmp_path):
    r, letters = random.Random(3), "abcdefghijklmnopqrstuvwxyz"
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*COLUMNS)
    foreign = {
        "pl": "nie się jest na że do to co jak tak ale za czy po go tego już tylko jego sobie był przez może być kiedy wszystko dlaczego człowiek dziecko państwo".split(),
        "fi": "ja on ei että se hän oli mutta niin kun minä sinä tämä joka olla kaikki nyt vain sitten koska talo metsä järvi yöllä kirjasto".split(),
        "tr": "bir ve bu için değil çok ama gibi daha kadar olarak sonra şimdi güzel çocuk insanlar gelecek yapıyor istiyorum".split(),
    }
    made = [" ".join(r.choice(words) for _ in range(200)) for words in foreign.values() for _ in range(3)]
    made += [" ".join("".join(r.choice(letters) for _ in range(r.randrange(2, 10))) for _ in range(200)) for _ in range(3)]
    rows = [(10_000_000 + i, t, "en", "s", len(t)) for i, t in enumerate(made)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {x.doc_id for x in cp.language_filter(spark, both, "").select("doc_id").collect()}
    assert not kept & {x[0] for x in rows}
    lettered = {x.doc_id for x in docs.filter("text rlike '\\\\p{L}'").select("doc_id").collect()}
    assert len(lettered - kept) <= 0.002 * len(lettered)


def test_shared_and_missing_keys_lose_no_document(spark):
    r = random.Random(8)
    a, b, c, d, e = (prose(r, "en", 60) for _ in range(5))
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (1, b, "de", "t", 1), (2, c, "en", "s", 1), (None, c, "en", "s", 1), (None, d, "en", "s", 1), (None, d, "en", "s", 1), (None, d + " end", "en", "s", 1), (None, e, "en", "s", 1), (3, a + " end", "en", "s", 1), (4, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = [tuple(x) for x in cp.near_duplicates(spark, docs, "").collect()]
    sure = [(1, a, "en", "s", 1), (1, b, "de", "t", 1), (2, c, "en", "s", 1), (4, None, "en", "s", 0), (None, e, "en", "s", 1)]
    assert Counter(x for x in kept if x not in ((None, d, "en", "s", 1), (None, d + " end", "en", "s", 1))) == Counter(sure)
    assert len(kept) == len(sure) + 1
