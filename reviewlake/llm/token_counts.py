"""Token counts of documents in flat, unindexed token files: a separator scan.

A file is a run of little-endian unsigned 16-bit ids; each document ends with the end-of-document id. Files are read in
blocks of a fixed size that know nothing of each other. One vectorised search finds the separators of a block; the block
reports the lengths that it sees whole, the tokens before its first separator and those behind its last. A prefix scan
over these small reports stitches documents that cross blocks, however many blocks one document fills.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reviewlake.llm.arrow_text import arrow_map
from reviewlake.llm.token_ids import default_path, worker_encoder
from reviewlake.session import checkpointed, delete_path, scratch_path

BLOCK_TOKENS = 1 << 21
#: Fixed value: the tokenizer's end-of-text id.
END_ID = 49407


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_token_files(df: DataFrame, folder: str, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes one flat file for each input partition to a shared folder; gives (file, ordinal, doc_id) as written.

    A file is written under the attempt's own name and moved into place when it is whole, so a task that runs again
    replaces it by the same ids. A text that spells the separator does not make one. Running the result again writes the files again.
    """
    path = tokenizer or default_path()

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        encoder, context = worker_encoder(path, plain_specials=True), TaskContext.get()
        name = f"tokens-{context.partitionId():06d}.bin"
        where, base = _filesystem(folder)
        where.create_dir(base, recursive=True)
        trial, ordinal = f"{base}/_{name}.{context.taskAttemptId()}", 0
        with where.open_output_stream(trial) as out:
            for batch in batches:
                for value in batch.column(1):
                    ids = encoder.encode(value.as_py())
                    out.write(np.append(ids, np.uint32(end_id)).astype("<u2").tobytes())
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.string()), pa.array(np.arange(ordinal, ordinal + n), pa.int64()), batch.column(0)], names=["file", "ordinal", "doc_id"]
                )
                ordinal += n
        # Some file systems refuse to move onto a file that an earlier attempt has left.
        if where.get_file_info(f"{base}/{name}").type != fs.FileType.NotFound:
            where.delete_file(f"{base}/{name}")
        where.move(trial, f"{base}/{name}")

    return arrow_map(df.select(df[key].cast("long").alias("doc_id"), df[text].alias("text")), run, "file string, ordinal long, doc_id long")


def blocks(spark: SparkSession, folder: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, at, length) of every block of the folder's files, from their sizes alone.

    Spark lists the files, whose content is not read here; a folder that is not there has none.
    """
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
        sizes = found.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))
    else:
        sizes = spark.createDataFrame([], "file string, bytes long")
    step = 2 * block_tokens
    every = sizes.select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / step).cast("long"))).alias("block")).filter("bytes > 0")
    return every.select("file", "block", (F.col("block") * step).alias("at"), F.least(F.lit(step), F.col("bytes") - F.col("block") * step).alias("length"))


def scan(blocks_df: DataFrame, folder: str, end_id: int = END_ID) -> DataFrame:
    """(file, block, ends, head, tail, lengths): what one block tells of itself.

    head: tokens before the block's first separator; tail: tokens behind its last; lengths: of the documents between, as
    an array. A block without a separator has ends 0 and all its tokens in tail.
    """

    def run(batches):
        import pyarrow as pa

        where, base = _filesystem(folder)
        for batch in batches:
            rows = {k: [] for k in ("file", "block", "ends", "head", "tail", "lengths")}
            for file, block, at, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with where.open_input_file(f"{base}/{file}") as f:
                    f.seek(at)
                    ids = np.frombuffer(f.read(length), "<u2")
                ends = np.flatnonzero(ids == end_id)
                got = (file, block, len(ends), int(ends[0]) if len(ends) else 0, len(ids) - 1 - int(ends[-1]) if len(ends) else len(ids), np.diff(ends) - 1)
                for k, v in zip(rows, got, strict=True):
                    rows[k].append(v)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True)], names=list(rows))

    return arrow_map(blocks_df, run, "file string, block long, ends long, head long, tail long, lengths array<long>")


def stitch(reports: DataFrame) -> DataFrame:
    """(file, ordinal, n_tokens) of every document, by a prefix scan over the blocks of a file.

    The tokens carried into a block are the tails since the last block that had a separator, that block's own included.
    Tokens behind a file's last separator are a document without an end and count as one if there are any.
    """
    small = reports.select("file", "block", "ends", "head", "tail")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, W.currentRow)
    runs = small.select("*", F.coalesce(F.sum("ends").over(before), F.lit(0).cast("long")).alias("first"), F.sum("tail").over(upto).alias("tails"))
    # Tails summed up to the block before the last one with a separator are of documents that have ended.
    runs = runs.select("*", F.coalesce(F.max(F.when(F.col("ends") > 0, F.col("tails") - F.col("tail"))).over(before), F.lit(0).cast("long")).alias("gone"), (F.col("tails") - F.col("tail")).alias("earlier"))
    runs = runs.select("*", F.when(F.col("ends") > 0, F.col("earlier") - F.col("gone") + F.col("head")).alias("crossing"))
    last = runs.groupBy("file").agg(F.max_by("tails", "block").alias("tails"), F.max(F.when(F.col("ends") > 0, F.col("earlier"))).alias("gone"), F.sum("ends").alias("ordinal"))
    open_end = last.select("file", "ordinal", (F.col("tails") - F.coalesce("gone", F.lit(0).cast("long"))).alias("n_tokens")).filter("n_tokens > 0")
    placed = runs.filter("ends > 0").select("file", "block", "first", "crossing")
    whole = reports.join(placed, ["file", "block"]).select("file", F.posexplode(F.concat(F.array("crossing"), "lengths")).alias("i", "n_tokens"), "first")
    return whole.select("file", (F.col("first") + F.col("i")).alias("ordinal"), "n_tokens").unionByName(open_end)


def count_tokens(spark: SparkSession, folder: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, ordinal, n_tokens) of every document in the folder's flat token files; no file gives no rows.

    Each file is read once: the blocks' reports are written before they are stitched.
    """
    found = checkpointed(blocks(spark, folder, block_tokens))
    n = max(1, min(found.count(), 100_000))
    return stitch(checkpointed(scan(found.repartition(n, "file", "block"), folder, end_id)))


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens): tokens of all documents, counted in flat files written to the shared folder.

    A null or empty text has 0 tokens; repeated rows are counted each; a null doc_id is kept.
    """
    folder = scratch_path(spark, "token-files")
    try:
        placed = checkpointed(write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder))
        found = checkpointed(count_tokens(spark, folder))
    finally:
        delete_path(spark, folder)
    return placed.join(found, ["file", "ordinal"]).select("doc_id", "n_tokens")
