"""Jaccard join of documents on word n-grams: rare-first prefixes with length, positional and suffix filters.

A document's set holds 64-bit hashes of its distinct n-grams. All sets are sorted by one order, rare n-grams first, so two
sets whose Jaccard similarity reaches the threshold share an n-gram of their prefixes. Frequencies come from all documents:
tasks count every n-gram in the cells of a sketch whose size follows the input, up to a bound, and Spark adds the sketches
up, so an n-gram's rank is the same however the input is split. A wrong rank would cost time, never a link.

Equal sets are one class from the start. Prefix entries of classes meet by n-gram; a short list gives all its pairs that
pass the filters, a long one at first only pairs with its head, the member most like all others. What is linked needs no
further pair, since the result is connected components: later rounds take from the long lists only pairs that are still
apart. So a group of many near copies costs about one pair a member, and yet no link between different texts is lost. Each
pair is verified once, on whole sets.

Hashes stand for words in three places. Equal sets: 128 bits, so among D documents two different sets are taken for one
with a chance of at most D * D / 2 ** 129. Prefix entries: 48 bits, where a chance meeting only makes a pair that is then
verified. Verification: 48 bits, so sets of a and b members seem to share one more with a chance of a * b / 2 ** 48.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.arrow_text import WordHasher, arrow_map, shingles, text_blocks
from reviewlake.operators.graph import connected_components
from reviewlake.session import checkpointed, release

#: Cells of the frequency sketch: the least, the most, and bytes of input for each; and the parts it is added up in.
LEAST_CELLS, MOST_CELLS, CELL_BYTES, SLICES = 1 << 20, 1 << 23, 64, 64
#: n-grams counted together by a task.
COUNTED = 1 << 19
#: Lists of up to so many classes give all their pairs at once.
SHORT = 3
#: Bits of a table of marks: for each marked key, at most (32 MB), and in a block that one task makes.
MARK_BITS, MOST_MARKS, MARK_BLOCK = 16, 1 << 28, 1 << 15
#: Parts of the order in which the suffix filter counts a set's members.
PARTS = 8
#: Bytes of an n-gram's hash in prefixes and in verification.
SHORT_BYTES = 6


def _sets(texts, hasher: WordHasher, width: int):
    """(first row, rows' count, row of each member, members) of runs of texts; members are distinct and sorted in a row."""
    for first, data, bounds in text_blocks(texts):
        _, _, row, words = hasher.words(data, bounds)
        at, found = shingles(row, words, len(bounds) - 1, width)
        order = np.lexsort((found, at))
        at, found = at[order], found[order]
        keep = np.ones(len(at), bool)
        keep[1:] = (at[1:] != at[:-1]) | (found[1:] != found[:-1])
        yield first, len(bounds) - 1, at[keep], found[keep]


def _cells_for(df: DataFrame) -> int:
    """Cells of the sketch: a power of two that follows the planner's estimate of the input's bytes."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << max(0, (size // CELL_BYTES).bit_length())))


def frequency_ranks(df: DataFrame, width: int, text: str, cells: int | None = None) -> np.ndarray:
    """The rank of each cell: eight times the binary logarithm of the number of its n-grams' documents, 255 at most.

    Each task sends its counts of all cells in compressed slices; a slice's counts are added up by one task, so what
    reaches the driver is a byte a cell.
    """
    cells = cells or _cells_for(df.select(text))
    part = cells // SLICES

    def count(batches):
        import pyarrow as pa

        hasher, held, size, counts = WordHasher(), [], 0, np.zeros(cells, np.uint32)

        def add():
            found, n = np.unique(np.concatenate(held) & np.uint64(cells - 1), return_counts=True)
            counts[found.astype(np.int64)] += n.astype(np.uint32)

        for batch in batches:
            for _, _, _, found in _sets(batch.column(0), hasher, width):
                held.append(found)
                size += len(found)
                if size >= COUNTED:
                    add()
                    held, size = [], 0
        if size:
            add()
        for i in range(SLICES):
            own = counts[i * part : (i + 1) * part]
            if own.any():
                # The four bytes of a count apart: all but the lowest are nearly always zero.
                planes = zlib.compress(np.ascontiguousarray(own.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([planes], pa.binary())], names=["slice", "counts"])

    def add_up(batches):
        import pyarrow as pa

        sums = {}
        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = sums.setdefault(i, np.zeros(part, np.uint64))
                planes = np.frombuffer(zlib.decompress(blob.as_py()), np.uint8).reshape(4, -1)
                own += np.ascontiguousarray(planes.T).view("<u4").ravel()
        for i, own in sums.items():
            rank = np.minimum(255, 8 * np.log2(own.astype(float) + 1)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([rank.tobytes()], pa.binary())], names=["slice", "ranks"])

    slices = arrow_map(df.select(text), count, "slice int, counts binary").repartition("slice")
    out = np.zeros(cells, np.uint8)
    for row in arrow_map(slices, add_up, "slice int, ranks binary").collect():
        out[row["slice"] * part : (row["slice"] + 1) * part] = np.frombuffer(row["ranks"], np.uint8)
    return out


def _order(at: np.ndarray, found: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    return np.lexsort((found, ranks[(found & np.uint64(len(ranks) - 1)).astype(np.int64)], at))


def _shortened(found: np.ndarray) -> np.ndarray:
    """(members, SHORT_BYTES): the high bytes of 64-bit hashes."""
    return np.ascontiguousarray(found.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - SHORT_BYTES :])


def _lengthened(data) -> np.ndarray:
    short = np.frombuffer(data, np.uint8).reshape(-1, SHORT_BYTES)
    out = np.zeros((len(short), 8), np.uint8)
    out[:, :SHORT_BYTES] = short
    return out.view("<u8").ravel()


def _pieces(data: np.ndarray, counts: np.ndarray):
    """A binary array of runs of rows of a byte matrix; counts: the rows of each."""
    import pyarrow as pa

    offsets = np.concatenate([[0], np.cumsum(counts)]) * data.shape[1]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def profiles(df: DataFrame, width: int, percent: int, ranks, key: str, text: str) -> DataFrame:
    """(doc_id, n, sig, sig2, parts, prefix): set size, set hash, suffix counts and the prefix of each document."""

    def run(batches):
        import pyarrow as pa

        hasher, rank = WordHasher(), ranks.value
        for batch in batches:
            keys = batch.column(0)
            for first, n_rows, at, found in _sets(batch.column(1), hasher, width):
                n = np.bincount(at, minlength=n_rows)
                head = np.cumsum(n) - n

                def summed(factor, shift):
                    spread = np.append(found * np.uint64(factor) ^ (found >> np.uint64(shift)), np.uint64(0))
                    total = np.where(n > 0, np.add.reduceat(spread, np.minimum(head, len(found))), 0).astype(np.uint64)
                    return total ^ (n.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))

                part = np.bincount(at * PARTS + (found >> np.uint64(61)).astype(np.int64), minlength=n_rows * PARTS).reshape(n_rows, PARTS)
                packed = np.zeros(n_rows, np.uint64)
                for k in range(PARTS):
                    packed |= np.minimum(part[:, k], 255).astype(np.uint64) << np.uint64(8 * k)
                order = _order(at, found, rank)
                a, f = at[order], found[order]
                place = np.arange(len(a)) - head[a]
                # n - ceil(t * n) + 1 members
                length = n - -(-percent * n // 100) + 1
                keep = place < length[a]
                prefix = _pieces(_shortened(f[keep]), np.bincount(a[keep], minlength=n_rows))
                sigs = [pa.array(summed(*x).view(np.int64)) for x in ((0x9E3779B97F4A7C15, 29), (0xD6E8FEB86659FD93, 32))]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(first, n_rows), pa.array(n, pa.int64()), *sigs, pa.array(packed.view(np.int64)), prefix], names=["doc_id", "n", "sig", "sig2", "parts", "prefix"]
                )

    return arrow_map(df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), run, "doc_id long, n long, sig long, sig2 long, parts long, prefix binary")


def _entries(classes: DataFrame, marks=None) -> DataFrame:
    """(token, id, np): the prefix entries of all classes; np holds set size and position.

    With `marks` only those whose token, but for its last byte, is marked.
    """

    def run(batches):
        import pyarrow as pa

        bits = marks.value if marks is not None else None
        for batch in batches:
            offsets = batch.column(2).cast(pa.large_binary())
            # Runs of rows: an entry takes four times the bytes here that it takes in a prefix.
            for a in range(0, batch.num_rows, 256):
                own = offsets.slice(a, 256)
                ends = np.frombuffer(own.buffers()[1], np.int64)[own.offset : own.offset + len(own) + 1]
                if ends[-1] == ends[0]:
                    continue
                tokens = _lengthened(own.buffers()[2][int(ends[0]) : int(ends[-1])]).astype(np.int64)
                counts = np.diff(ends) // SHORT_BYTES
                pos = np.arange(len(tokens)) - np.repeat(np.cumsum(counts) - counts, counts)
                ids, n = (np.repeat(batch.column(i).slice(a, 256).to_numpy(), counts) for i in (0, 1))
                keep = slice(None) if bits is None else _is_marked(tokens >> 8, bits)
                yield pa.RecordBatch.from_arrays([pa.array(tokens[keep]), pa.array(ids[keep]), pa.array(((n << 32) + pos)[keep])], names=["token", "id", "np"])

    return arrow_map(classes.select("id", "n", "prefix"), run, "token long, id long, np long")


def _apart(a: Column, b: Column) -> Column:
    """A lower bound of the number of members that only one of two sets has, from their counts by parts (suffix filter)."""
    total = None
    for k in range(PARTS):
        x = F.shiftrightunsigned(a, 8 * k).bitwiseAND(F.lit(255)) - F.shiftrightunsigned(b, 8 * k).bitwiseAND(F.lit(255))
        total = F.abs(x) if total is None else total + F.abs(x)
    return total


def _need(x: str, y: str, percent: int) -> Column:
    """The least number of shared members with which sets x and y link."""
    return F.expr(f"(({x}.n + {y}.n) * {percent} + {99 + percent}) div {100 + percent}")


def _may_link(x: str, y: str, percent: int) -> Column:
    """Length and positional filters for entries x and y of one n-gram; nothing that links is turned away."""
    nx, ny, px, py = (F.col(f"{e}.{c}") for c in ("n", "pos") for e in (x, y))
    length = (F.least(nx, ny) * 100) >= F.greatest(nx, ny) * percent
    # Of the first member that two sets share, no more follow than the shorter rest. So a pair that links passes there.
    return length & (F.least(nx - px, ny - py) >= _need(x, y, percent))


def _suffix_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose counts by parts leave room for a link."""
    side = classes.select("id", "n", "parts")
    both = pairs.join(side.alias("x"), F.col("a") == F.col("x.id")).join(side.alias("y"), F.col("b") == F.col("y.id"))
    return both.filter(_apart(F.col("x.parts"), F.col("y.parts")) <= F.col("x.n") + F.col("y.n") - 2 * _need("x", "y", percent)).select("a", "b")


def _marks(hashes: DataFrame, n: int) -> np.ndarray:
    """A bit for the low bits of each of n hashes (column h): MARK_BITS bits a hash and MOST_MARKS at most.

    So its size is bounded for any input; on a larger one more keys that are not marked seem to be, which costs time only.
    """
    size = min(MOST_MARKS, max(MARK_BLOCK, 1 << (MARK_BITS * max(1, n)).bit_length()))
    cells = hashes.select(F.col("h").bitwiseAND(F.lit(size - 1)).alias("cell"))

    def blocks(batches):
        import pyarrow as pa

        made = {}
        for batch in batches:
            block, at = np.divmod(batch.column(0).to_numpy(), MARK_BLOCK)
            for k in np.unique(block):
                made.setdefault(int(k), np.zeros(MARK_BLOCK, bool))[at[block == k]] = True
        for k, bits in made.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["block", "bits"])

    got = arrow_map(cells.repartition(F.floor(F.col("cell") / MARK_BLOCK)), blocks, "block long, bits binary").collect()
    out, part = np.zeros(size >> 5, np.uint32), MARK_BLOCK >> 5
    for row in got:
        out[row["block"] * part : (row["block"] + 1) * part] = np.frombuffer(row["bits"], "<u4")
    return out


def _is_marked(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    cell = hashes.astype(np.int64) & (32 * len(bits) - 1)
    return (bits[cell >> 5] >> (cell & 31).astype(np.uint32)) & 1 == 1


def _verify(pairs: DataFrame, docs: DataFrame, width: int, percent: int, key: str, text: str) -> DataFrame:
    """The pairs (a, b) of documents whose whole sets reach the threshold.

    Sets are made anew for the documents in pairs; the marks keep those of most others from being made and sent.
    """
    wanted = checkpointed(pairs.select(F.explode(F.array("a", "b")).alias("w")).distinct())
    marks = docs.sparkSession.sparkContext.broadcast(_marks(wanted.select(F.xxhash64("w").alias("h")), wanted.count()))

    def sets(batches):
        import pyarrow as pa

        hasher, bits = WordHasher(), marks.value
        for batch in batches:
            some = batch.filter(pa.array(_is_marked(batch.column(2).to_numpy(), bits)))
            for first, n_rows, at, found in _sets(some.column(1), hasher, width):
                members = _pieces(_shortened(found), np.bincount(at, minlength=n_rows))
                yield pa.RecordBatch.from_arrays([some.column(0).slice(first, n_rows), members], names=["doc_id", "members"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(key).cast("long")).alias("h"))
    found = checkpointed(arrow_map(rows, sets, "doc_id long, members binary"))
    both = (
        pairs.join(found.select(F.col("doc_id").alias("a"), F.col("members").alias("ma")), "a")
        .select("a", "b", "ma")
        .join(found.select(F.col("doc_id").alias("b"), F.col("members").alias("mb")), "b")
    )

    def judge(batches):
        import pyarrow as pa

        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = _lengthened(x.as_buffer()), _lengthened(y.as_buffer())
                shared = len(p) + len(q) - len(np.unique(np.concatenate([p, q])))
                good.append(100 * shared >= percent * (len(p) + len(q) - shared))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return arrow_map(both.select("a", "b", "ma", "mb"), judge, "a long, b long")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", short: int = SHORT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of docs.

    Words are runs of other characters than ASCII white space, A-Z lower-cased. A text of fewer than `width` words is one
    n-gram of all of them; a null text, or one without words, has an empty set and links with nothing. Two documents link
    when 100 * intersection >= percent * union; component_id is the smallest doc_id reachable. Rows of one doc_id are
    taken for one document in links, each with its own set size; a null doc_id links with nothing. An empty table gives an
    empty one.
    """
    spark = docs.sparkSession
    texts = docs.filter(F.col(key).isNotNull())
    ranks = spark.sparkContext.broadcast(frequency_ranks(docs, width, text))
    all_docs = checkpointed(profiles(docs, width, percent, ranks, key, text))
    filled = all_docs.filter("n > 0 and doc_id is not null")
    classes = checkpointed(filled.groupBy("n", "sig", "sig2").agg(F.min("doc_id").alias("id"), F.first("parts").alias("parts"), F.first("prefix").alias("prefix")))
    # Narrow tables are dealt anew before they are written: few files of a good size instead of one for each input split.
    all_docs = checkpointed(all_docs.select("doc_id", "n", "sig", "sig2").repartition("doc_id"))
    usable = all_docs.filter("n > 0 and doc_id is not null")
    del filled
    release(spark)
    # Tokens that no other class has are left out before entries are sent: by marks of those met twice, and then exactly.
    twice = _entries(classes).select(F.shiftright("token", 8).alias("h")).groupBy("h").agg(F.count("*").alias("m")).filter("m > 1").select("h")
    twice = checkpointed(twice)
    marks = spark.sparkContext.broadcast(_marks(twice, twice.count()))
    lists = checkpointed(_entries(classes, marks).select("token", "id", F.shiftright("np", 32).alias("n"), F.col("np").bitwiseAND(F.lit(0xFFFFFFFF)).alias("pos")).repartition("token", "id"))
    classes = checkpointed(classes.select("n", "sig", "sig2", "id", "parts").repartition("id"))
    del twice
    release(spark)

    def pairs_of(x: DataFrame, y: DataFrame, more: Column) -> DataFrame:
        on = (F.col("x.token") == F.col("y.token")) & more & _may_link("x", "y", percent)
        both = x.alias("x").join(y.alias("y"), on)
        return both.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))

    # A long list's head is the member with the fewest rarer n-grams, as an original has among its copies. What is known of
    # lists is written before it joins their rows, so that Spark can split a list that holds a large part of all rows.
    met = checkpointed(lists.groupBy("token").agg(F.count("*").alias("m"), F.min(F.struct("pos", "n", "id")).alias("h")).filter("m > 1"))
    lists = checkpointed(lists.join(met, "token").select("token", "m", "id", "n", "pos", "h"))
    brief, long = lists.filter(F.col("m") <= short).select("token", "id", "n", "pos"), lists.filter(F.col("m") > short)
    starred = long.select(F.struct("id", "n", "pos").alias("x"), F.col("h").alias("y")).filter((F.col("x.id") != F.col("y.id")) & _may_link("x", "y", percent))
    starred = starred.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
    long = long.select("token", "id", "n", "pos")
    first = pairs_of(brief, brief, F.col("x.id") < F.col("y.id")).unionByName(starred)
    tried = checkpointed(_suffix_filter(first.distinct(), classes, percent))
    del first, met, brief, starred
    release(spark)
    links = checkpointed(_verify(tried, texts, width, percent, key, text).distinct())
    release(spark)
    # Rows of one doc_id with different texts belong to several classes, which are then one document.
    own = usable.select("doc_id", "n", "sig", "sig2").distinct().join(classes, ["n", "sig", "sig2"]).select("doc_id", "id")
    own = checkpointed(own.groupBy("doc_id").agg(F.min("id").alias("id"), F.max("id").alias("other"), F.collect_set("id").alias("ids")))
    same = own.filter("id <> other").select(F.col("id").alias("a"), F.explode("ids").alias("b")).filter("a <> b")
    links = links.unionByName(same)
    placed = checkpointed(connected_components(links, "a", "b"))
    while True:
        at = long.join(placed, long["id"] == placed["node"], "left").select(long["*"], F.coalesce("component", "id").alias("c"))
        by = checkpointed(at.groupBy("token", "c").agg(F.count("*").alias("k")))
        # The members outside a list's largest component meet all others that are apart from them.
        top = checkpointed(by.groupBy("token").agg(F.max_by("c", F.struct("k", -F.col("c"))).alias("top"), F.count("*").alias("cs")).filter("cs > 1"))
        marked = checkpointed(at.join(top, "token").withColumn("stray", F.col("c") != F.col("top")))
        apart = (F.col("x.c") != F.col("y.c")) & (~F.col("y.stray") | (F.col("x.id") < F.col("y.id")))
        again = pairs_of(marked.filter("stray"), marked, apart).distinct().join(tried, ["a", "b"], "left_anti")
        again = checkpointed(_suffix_filter(again, classes, percent))
        if again.isEmpty():
            break
        links = checkpointed(links.unionByName(_verify(again, texts, width, percent, key, text).distinct()))
        tried = checkpointed(tried.unionByName(again))
        placed = checkpointed(connected_components(links, "a", "b"))
    found = own.join(placed, own["id"] == placed["node"], "left").select("doc_id", F.coalesce("component", "id").alias("component_id"))
    return all_docs.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op3_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """All documents by sets of 4-word n-grams, linked from a similarity of 0.85 on."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 4, 85)


#: The same in SQL: sets of spelled-out n-grams, all pairs that share one, and components by recursion.
OP3_SQL = r"""
with recursive docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then []::varchar[] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))) end as s from docs),
grams as (select doc_id, len(s) as n, unnest(s) as g from sets),
links as (
  select a.doc_id as a, b.doc_id as b from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by a.doc_id, b.doc_id, a.n, b.n
  having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges as (select a, b from links union all select b, a from links),
reach(n, r) as (select doc_id, doc_id from docs union select e.b, reach.r from reach join edges e on e.a = reach.n)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id from sets join (select n, min(r) as component_id from reach group by n) on n = doc_id
"""
