import random
import re

import numpy as np
import pytest

from reviewlake.llm import ngram_join
from reviewlake.llm.arrow_text import WordHasher, shingles, text_blocks

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def grams(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, width, percent):
    """(doc_id, n, component) with rows of one id as one document."""
    root = {k: k for k, _ in rows if k is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(k, grams(t, width)) for k, t in rows]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return sorted((-1 if k is None else k, len(s), find(k) if k is not None else -1) for k, s in sets)


def corpus(seed, n=150):
    r = random.Random(seed)
    vocab = ["The", "a", "of", "x\x85y", "É", "é", *(f"w{i}" for i in range(60))]
    rows, common = [], " ".join(r.choice(vocab) for _ in range(60))
    for i in range(n):
        kind = r.random()
        text = " ".join(r.choice(vocab) for _ in range(r.choice([1, 2, 3, 4, 5, 8, 30, 80])))
        if kind < 0.35 and rows:
            w = words(r.choice(rows)[1])
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocab)
            text = r.choice([" ", "\n", "\t "]).join(w)
        elif kind < 0.5:
            text = common + " " + text
        rows.append((i * 3 + 1, text))
    return rows


def hot(seed, n=90):
    """One base text with small and with larger edits, so that some copies link only through others."""
    r = random.Random(seed)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(n):
        w = base[:]
        for k in r.sample(range(100), r.choice([0, 1, 1, 2, 3, 4, 5])):
            w[k] = f"e{r.randrange(10)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("width, percent, short, rows", [(4, 85, 16, corpus(1)), (5, 80, 2, corpus(2)), (4, 85, 3, hot(3)), (3, 50, 1, corpus(4, 80))])
def test_components_match_all_pairs(spark, width, percent, short, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(x) for x in ngram_join.jaccard_components(df, width, percent, short=short).collect())
    assert got == brute(rows, width, percent)


def test_ranks_do_not_depend_on_the_split_and_count_all_documents(spark):
    passage = " ".join(f"p{i}" for i in range(8))
    rows = [(i, f"{passage} own{i} words{i} of{i} this{i} one{i}") for i in range(64)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = (ngram_join.frequency_ranks(df.repartition(n), 4, "text", 1 << 20) for n in (1, 64))
    assert np.array_equal(one, many)
    seen = [0] * (1 << 20)
    hasher = WordHasher()
    for _, t in rows:
        data = np.frombuffer(t.encode(), np.uint8)
        at, found = shingles(*hasher.words(data, np.array([0, len(data)]))[2:], 1, 4)
        for x in set(found.tolist()):
            seen[x & ((1 << 20) - 1)] += 1
    assert max(seen) == 64
    assert np.array_equal(one, np.minimum(255, 8 * np.log2(np.array(seen) + 1.0)).astype(np.uint8))


def test_marks_hold_every_key_and_few_others(spark):
    keys = np.random.default_rng(2).integers(-(1 << 62), 1 << 62, 3000)
    bits = ngram_join._marks(spark.createDataFrame([(int(x),) for x in keys], "h long"), len(keys))
    assert ngram_join._is_marked(keys, bits).all()
    others = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 30000)
    assert ngram_join._is_marked(others, bits).mean() < 0.1


def test_odd_rows(spark, tmp_path):
    long = " ".join(f"v{i % 977}" for i in range(60000))
    rows = [(9, "One two three"), (4, "one  TWO\tthree"), (7, None), (8, ""), (6, " \n"), (None, "one two three"), (5, "a b c d e"), (5, "q r s t u"), (3, "a b c d e"), (2, "Q r s t u"), (20, long), (21, long + " end")]
    spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, n int").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((-1 if x[0] is None else x[0], x[1], -1 if x[2] is None else x[2]) for x in ngram_join.op3_ngram_jaccard(spark, str(tmp_path)).collect())
    assert got == brute(rows, 4, 85)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/e/documents.parquet")
    assert ngram_join.op3_ngram_jaccard(spark, f"{tmp_path}/e").count() == 0


def test_hashes_do_not_depend_on_place():
    import pyarrow as pa

    texts = ["ab cd ef", None, "xx AB cd ef", "", "ab"]
    seen = {}
    for limit in (1, 5, 100):
        for first, data, bounds in text_blocks(pa.array(texts), limit):
            start, end, row, h = WordHasher().words(data, bounds)
            for s, e, r, x in zip(start, end, row, h):
                assert seen.setdefault(bytes(data[s:e]).lower(), x) == x
            at, found = shingles(row, h, len(bounds) - 1, 3)
            assert len(at) == sum(max(1, len(words(t)) - 2) for t in texts[first : first + len(bounds) - 1] if words(t))
    assert len(set(seen.values())) == len(seen) == 4
