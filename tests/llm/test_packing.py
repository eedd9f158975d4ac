import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from reviewlake.llm import packing
from reviewlake.llm.token_ids import Encoder, default_path

ODD = ["", "  ", "a", "Hello, WORLD!! it's 12 don't...x", "á é ΑΣ ΟΔΟΣ. İ ½ é ́x", "x<|endoftext|>y <|ENDOFTEXT|>", "\n\t\x0b\x0c\r a b", "word,| end.\nnext.", "don't ça,va naïve! ÀÉ. Straße; ªº µm ﬁx ǆ x_y a-b ,, ...! \xa0nb\xa0."]


def test_cached_words_give_the_tokenizers_ids():
    plain, mine = Tokenizer.from_file(default_path()), Encoder(default_path())
    for text in ODD * 2 + ["abc def, " * 5000]:
        assert mine.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def check(rows, texts, most=4096, segments=64):
    plain = Tokenizer.from_file(default_path())
    ids = {k: np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for k, t in texts.items()}
    by, seqs = defaultdict(list), defaultdict(list)
    for x in rows:
        by[x.doc_id].append(x)
        seqs[x.sequence_id].append(x)
    assert set(by) == set(ids)
    for k, pieces in by.items():
        at = 0
        for x in sorted(pieces, key=lambda x: x.start):
            assert x.start == at and x.length > 0 and x.doc_tokens == len(ids[k])
            assert x.ids_crc32 == zlib.crc32(ids[k][at : at + x.length].tobytes())
            at += x.length
        assert at == len(ids[k])
    padding = 0
    for pieces in seqs.values():
        at = 0
        for x in sorted(pieces, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= most and len(pieces) <= segments
        padding += 0 if at & (at - 1) == 0 else most - at
    return padding


def test_round_trip_and_little_padding(spark):
    texts = dict(enumerate(ODD)) | {100: None, 101: "long word " * 30000} | {i: f"w{i} " * (i * 7 % 900) for i in range(200, 320)}
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, start string").repartition(3)
    rows = packing.pack(df).collect()
    total = sum(x.length for x in rows)
    assert check(rows, texts) <= 0.01 * total
    assert packing.pack(df.limit(0)).count() == 0


def test_all_three_limits_hold():
    limits = packing.Limits(tokens=64, segments=3, loss_tokens=40)
    packer = packing.Packer(limits, pool=4)
    r = np.random.default_rng(5)
    given = {}
    for i in range(300):
        n = int(r.integers(1, 150))
        given[i] = (n, int(r.integers(0, n + 1)))
        packer.add(i, np.arange(n, dtype=np.uint32), given[i][1])
    packer.finish()
    seen = defaultdict(list)
    for pieces in packer.done:
        assert sum(len(p[2]) for p in pieces) <= 64 and len(pieces) <= 3
        assert sum(max(0, s + len(x) - max(s, given[t][1])) for t, s, x in pieces) <= 40
        for t, s, x in pieces:
            seen[t].extend(x.tolist())
    assert {t: sorted(x) for t, x in seen.items()} == {t: list(range(n)) for t, (n, _) in given.items()}


def test_loss_limit_holds_through_the_table(spark):
    limits = packing.Limits(tokens=64, segments=8, loss_tokens=24)
    begins = {i: None if i % 5 == 0 else i % 40 for i in range(150)} | {150: 10_000, 151: -3}
    texts = {i: f"w{i} " * (5 + i * 7 % 40) for i in begins}
    df = spark.createDataFrame([(i, texts[i], begins[i]) for i in begins], "doc_id long, text string, prompt int").repartition(2)
    rows = packing.pack(df, limits=limits, pool=4, loss_from="prompt").collect()
    check(rows, texts, 64, 8)
    loss, tokens = defaultdict(int), defaultdict(int)
    for x in rows:
        loss[x.sequence_id] += max(0, x.start + x.length - max(x.start, begins[x.doc_id] or 0))
        tokens[x.sequence_id] += x.length
    assert max(loss.values()) <= 24 < max(tokens.values())


def test_the_end_of_a_task_keeps_what_the_heuristic_made():
    packer = packing.Packer(packing.Limits(tokens=16, segments=4, loss_tokens=16), pool=4)
    sizes = [9, 5, 11, 4, 7, 3, 2, 1]
    for k, n in enumerate(sizes):
        packer.add(k, np.arange(n, dtype=np.uint32))
    before = [[p[0] for p in s] for s in packer.open if s]
    packer.finish()
    got = sorted((tag, start, len(ids)) for s in packer.done for tag, start, ids in s)
    for k, n in enumerate(sizes):
        own = [x for x in got if x[0] == k]
        assert sum(x[2] for x in own) == n and [x[1] for x in own] == list(np.cumsum([0, *(x[2] for x in own)])[:-1])
    lengths = sorted((sum(len(p[2]) for p in s) for s in packer.done), reverse=True)
    assert sum(lengths) == sum(sizes) and all(n == 16 or n & (n - 1) == 0 for n in lengths) and all(len(s) <= 4 for s in packer.done)
    kept = [[p[0] for p in s] for s in packer.done]
    assert any(old == new[: len(old)] for old in before for new in kept)


def test_another_tokenizer_encodes_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    from reviewlake.llm.token_ids import Encoder

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_words and Encoder(packing.default_path()).by_words
    for text in ("Two words, can't  stop.", " été\n北京", ""):
        assert encoder.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids
