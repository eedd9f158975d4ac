"""Vector bin packing of token sequences under three limits at once.

An example demands tokens, one segment and loss-bearing tokens. A task keeps a pool of open sequences; the dot-product
heuristic puts the next example where the product of its demand and a sequence's free room, each in units of the limits,
is largest among the sequences that hold it whole. Where none does, the example fills the room of the sequence that has
most, and its rest is placed again. What stays open at the end of a task is closed without padding: its pieces are cut to
sequences of power-of-two lengths.

Every input partition is packed on its own, in one pass and without a shuffle; the open pool bounds the memory.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.arrow_text import arrow_map
from reviewlake.llm.token_ids import default_path, worker_encoder


@dataclass
class Limits:
    tokens: int = 4096
    segments: int = 64
    loss_tokens: int = 4096


class Packer:
    """Places examples one at a time; `done` holds closed sequences as lists of pieces (tag, start, ids)."""

    def __init__(self, limits: Limits, pool: int = 32):
        self.limits, self.pool = limits, pool
        self.units = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.room = np.zeros((pool, 3))
        self.open: list[list | None] = [None] * pool
        self.done: list[list] = []

    def add(self, tag, ids: np.ndarray, loss_from: int = 0) -> None:
        """Places an example; its tokens from `loss_from` on bear loss."""
        start, n, most = 0, len(ids), self.limits.tokens
        while n - start >= most and self.limits.loss_tokens >= most:
            self.done.append([(tag, start, ids[start : start + most])])
            start += most
        while start < n:
            rest = n - start
            loss = max(0, n - max(start, loss_from))
            need = np.array([rest, 1, loss], float)
            fits = (self.room >= need).all(axis=1)
            if fits.any():
                score = np.where(fits, (self.room / self.units) @ (need / self.units), -1.0)
                at, take = int(score.argmax()), rest
            else:
                at = next((i for i, p in enumerate(self.open) if p is None), -1)
                if at >= 0:
                    self.room[at], self.open[at] = self.units, []
                    if (self.room[at] >= need).all():
                        take = rest
                    else:
                        take = self._fitting(at, start, rest, loss_from)
                else:
                    # The pool is full: end the sequence with the most tokens in it by a part of this example.
                    usable = (self.room[:, 1] >= 1) & (self.room[:, 2] >= 1)
                    at = int(np.where(usable, self.room[:, 0], np.inf).argmin()) if usable.any() else 0
                    take = min(rest, self._fitting(at, start, rest, loss_from)) if usable.any() else 0
                    if take <= 0:
                        self._close(int(self.room[:, 0].argmin()))
                        continue
            self.open[at].append((tag, start, ids[start : start + take]))
            self.room[at] -= (take, 1, max(0, start + take - max(start, loss_from)))
            start += take
            if self.room[at][0] <= 0:
                self._close(at)

    def _fitting(self, at: int, start: int, rest: int, loss_from: int) -> int:
        take = int(min(rest, self.room[at][0]))
        free = max(0, loss_from - start)
        return int(min(take, free + self.room[at][2]))

    def _close(self, at: int) -> None:
        if self.open[at]:
            self.done.append(self.open[at])
        self.open[at] = None
        self.room[at] = 0

    def finish(self) -> None:
        """Closes what is open. As many sequences as the tokens can fill stay as the heuristic made them, the fullest first,
        and are filled up with pieces of the others; what is left then is laid end to end and cut to powers of two."""
        kept = sorted((x for x in self.open if x), key=lambda x: -sum(len(p[2]) for p in x))
        self.open, self.room = [None] * self.pool, np.zeros((self.pool, 3))
        if self.limits.loss_tokens < self.limits.tokens:
            # Cutting anew could break the loss limit: close them as they are.
            self.done.extend(kept)
            return
        full = sum(len(p[2]) for x in kept for p in x) // self.limits.tokens
        pieces = [p for x in reversed(kept[full:]) for p in x]
        for sequence in kept[:full]:
            free = self.limits.tokens - sum(len(p[2]) for p in sequence)
            while free and pieces and len(sequence) < self.limits.segments:
                tag, start, ids = pieces.pop()
                sequence.append((tag, start, ids[:free]))
                if len(ids) > free:
                    pieces.append((tag, start + free, ids[free:]))
                free -= min(free, len(ids))
            self.done.append(sequence)
        total = sum(len(p[2]) for p in pieces)
        current, room = [], self._next_length(total)
        for tag, start, ids in pieces:
            while len(ids):
                if len(current) == self.limits.segments:
                    self.done.append(current)
                    current, room = [], self._next_length(total)
                take = min(len(ids), room)
                current.append((tag, start, ids[:take]))
                start, ids, room, total = start + take, ids[take:], room - take, total - take
                if not room:
                    self.done.append(current)
                    current, room = [], self._next_length(total)
        if current:
            self.done.append(current)

    def _next_length(self, total: int) -> int:
        return self.limits.tokens if total >= self.limits.tokens else 1 << max(0, total.bit_length() - 1)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", limits: Limits | None = None, pool: int = 32, tokenizer: str | None = None, end_id: int = 2, loss_from: str | None = None) -> DataFrame:
    """The pieces of every text in packed sequences; see PIECES for the columns.

    A null text counts as empty, so it is the end id alone. A text of any length is cut into as many pieces as it needs.
    Repeated rows, and rows of equal keys, are packed each on its own. An empty table gives no pieces. Sequence ids hold
    the input partition above bit 40, so they are the same whenever a lost task runs again over the same split.

    `loss_from` names a column with the number of a text's first loss-bearing token, as the length of a prompt: null or
    negative means that all bear loss, a number beyond the text that none does. Without it every token bears loss.
    """
    import pyarrow as pa

    path, limits = tokenizer or default_path(), limits or Limits()
    schema = pa.schema([(x.split()[0], pa.int64()) for x in PIECES.split(", ")])

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        encoder, packer, n = worker_encoder(path), Packer(limits, pool), 0

        def rows():
            nonlocal n
            out = []
            for pieces in packer.done:
                offset = 0
                for tag, start, ids in pieces:
                    doc_id, tokens = tag
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), tokens, base + n, offset))
                    offset += len(ids)
                n += 1
            packer.done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema) if out else None

        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = batch.column(1)
            begins = batch.column(2).to_pylist()
            for i, k in enumerate(keys):
                ids = np.append(encoder.encode(texts[i].as_py()), np.uint32(end_id))
                packer.add((k, len(ids)), ids, max(0, begins[i] or 0))
                if len(packer.done) >= 1000:
                    yield rows()
            if found := rows():
                yield found
        packer.finish()
        if found := rows():
            yield found

    begin = df[loss_from].cast("long") if loss_from else F.lit(0).cast("long")
    return arrow_map(df.select(df[key].cast("long").alias("doc_id"), df[text].alias("text"), begin.alias("loss_from")), run, PIECES)


def op5_vector_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens and 64 segments; every token bears loss."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
