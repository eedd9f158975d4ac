"""Vectorised text work on Arrow buffers: bounded batches, word bounds and 64-bit hashes of words and shingles.

A word is a run of other bytes than space, tab, line feed, vertical tab, form feed and carriage return. A word's hash is
a polynomial over its bytes modulo 2 ** 64, found from running sums, so its cost does not depend on word lengths.
"""

from __future__ import annotations

import numpy as np

#: Text handled at once; bounds the memory of the arrays below. One longer text makes a block of its own.
BLOCK_BYTES = 1 << 19
#: Rows and bytes of a batch that Spark hands to a worker at once, at most; one longer row makes a batch of its own.
BATCH_ROWS, BATCH_BYTES = 2048, 4 << 20
#: Bytes of text whose words are hashed at once, and so the powers that a hasher keeps; a longer word is hashed alone.
HASHED_BYTES = 1 << 18


def give_back() -> None:
    """Returns what this process has freed to the system, so that a worker does not keep the size of its largest task."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def arrow_map(df, run, schema: str):
    """df.mapInArrow(run, schema) with batches bounded by rows and bytes, and memory given back at the end of a task.

    The bounds are settings of the session, which are lowered if they are above BATCH_ROWS and BATCH_BYTES.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    given = conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")
    if not given.lstrip("-").isdigit() or not 0 < int(given) <= BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(whole, schema)


def mixed(x: np.ndarray) -> np.ndarray:
    """A published 64-bit finaliser (shifts by 30, 27, 31): spreads every bit over the word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_codes(lower: bool) -> np.ndarray:
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


def is_space() -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[9, 10, 11, 12, 13, 32]] = True
    return out


def text_blocks(texts, limit: int = BLOCK_BYTES):
    """(first row, bytes, row bounds) for runs of rows of a pyarrow string array; a null text has no bytes."""
    import pyarrow as pa

    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    n = len(texts)
    if n == 0:
        return
    buffers = texts.buffers()
    bounds = np.frombuffer(buffers[1], dtype=kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1)
        last = min(last, n)
        yield first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


class WordHasher:
    """Finds words and their hashes; keeps the powers it needs."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, lower: bool = True):
        self.codes, self.space = byte_codes(lower), is_space()
        self.back = pow(self.BASE, -1, 1 << 64)
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            m = max(n, HASHED_BYTES + 1)
            for name, base in (("powers", self.BASE), ("inverse", self.back)):
                steps = np.full(m, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def words(self, data: np.ndarray, bounds: np.ndarray):
        """(start, end, row, hash) of each word; a word never crosses rows."""
        if not len(data):
            empty = np.zeros(0, np.int64)
            return empty, empty, empty, np.zeros(0, np.uint64)
        inside = ~self.space[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cut = bounds[1:-1]
        cut = cut[cut < len(data)]
        begins[cut] = inside[cut]
        start = np.flatnonzero(begins)
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        cut = cut[cut > 0]
        ends[cut - 1] = inside[cut - 1]
        end = np.flatnonzero(ends) + 1
        hashes, first = np.empty(len(start), np.uint64), 0
        while first < len(start):
            last = max(first + 1, int(np.searchsorted(end, start[first] + HASHED_BYTES, side="right")))
            a, b = int(start[first]), int(end[last - 1])
            self._grow(b - a + 1)
            total = np.zeros(b - a + 1, np.uint64)
            np.cumsum(self.codes[data[a:b]] * self.powers[: b - a], out=total[1:])
            s, e = start[first:last] - a, end[first:last] - a
            hashes[first:last] = mixed((total[e] - total[s]) * self.inverse[s] + (e - s).astype(np.uint64))
            first = last
            if len(self.powers) > HASHED_BYTES + 1:
                self.powers = self.inverse = np.ones(1, np.uint64)
        return start, end, np.searchsorted(bounds, start, side="right") - 1, hashes


def shingles(row: np.ndarray, word_hashes: np.ndarray, n_rows: int, width: int):
    """(row, hash) of each run of `width` words of a row; a row with fewer words has one run of all of them."""
    counts = np.bincount(row, minlength=n_rows) if len(row) else np.zeros(n_rows, np.int64)
    m = len(row)
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    weights = mixed(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
    first = np.cumsum(counts) - counts
    place = np.arange(m) - first[row]
    begins = (place + width <= counts[row]) | ((place == 0) & (counts[row] < width))
    acc = np.zeros(m, np.uint64)
    for k in range(width):
        part = np.zeros(m, np.uint64)
        if k < m:
            part[: m - k] = word_hashes[k:] * weights[k]
            same = np.zeros(m, bool)
            same[: m - k] = row[k:] == row[: m - k]
            part[~same] = np.uint64(k + 1)
        acc += mixed(part)
    at = np.flatnonzero(begins)
    return row[at], mixed(acc[at])
