import numpy as np
import pytest
from tokenizers import Tokenizer

from reviewlake.llm import token_counts
from reviewlake.llm.token_ids import default_path


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_blocks_are_stitched(spark, tmp_path, block):
    r = np.random.default_rng(block)
    want = {}
    for name in ("a", "b", "open"):
        lengths = [0, 0, 5, 1, *map(int, r.integers(0, 40, 12)), 0]
        ids = np.concatenate([np.append(r.integers(0, 9, n), 65000) for n in lengths])
        if name == "open":
            ids = np.append(ids, [1, 2, 3])
            lengths.append(3)
        ids.astype("<u2").tofile(tmp_path / f"{name}.bin")
        want |= {(f"{name}.bin", i): n for i, n in enumerate(lengths)}
    (tmp_path / "empty.bin").touch()
    got = token_counts.count_tokens(spark, f"file://{tmp_path}", 65000, block).collect()
    assert len(got) == len(want) and {(x.file, x.ordinal): x.n_tokens for x in got} == want


def test_query_counts_whole_texts(spark, tmp_path):
    rows = [(1, "Hello, world"), (1, "Hello, world"), (None, None), (3, ""), (4, "long word " * 20000), (5, "a <|endoftext|> b")]
    spark.createDataFrame([(*x, "z") for x in rows], "doc_id long, text string, n_tokens string").write.parquet(f"{tmp_path}/documents.parquet")
    plain = Tokenizer.from_file(default_path())
    plain.encode_special_tokens = True
    got = sorted((x.doc_id or 0, x.n_tokens) for x in token_counts.op2_token_counts(spark, str(tmp_path)).collect())
    assert got == sorted((k or 0, len(plain.encode(t or "", add_special_tokens=False).ids)) for k, t in rows)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/e/documents.parquet")
    assert token_counts.op2_token_counts(spark, f"{tmp_path}/e").count() == 0
