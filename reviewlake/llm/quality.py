"""A quality classifier: a generalised additive model with pairwise interactions.

Features of a text are cut into bins. Cyclic boosting goes round the features; each visit fits a shallow tree of a single
feature to the gradient and adds its steps to that feature's look-up table. Pairs of features that still explain the rest
best get tables of two dimensions in the same way. A score is a sum of look-ups.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.arrow_text import WordHasher, arrow_map, text_blocks
from reviewlake.llm.language_id import fold

FEATURES = (
    "log_words", "mean_word", "long_words", "upper", "digits", "marks", "odd_marks", "marked_words", "mark_runs",
    "distinct_words", "repeated_next", "top_word", "lines_a_word", "distinct_lines", "one_letter", "sentence_ends",
)
#: Labelled rows that a model is fitted on, at most: those of the smallest hashes.
SAMPLE_ROWS = 20_000
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, RATE, LEAVES = 32, 60, 30, 4, 0.2, 4


def _classes() -> np.ndarray:
    """0 other, 1 upper-case letter, 2 lower-case letter or a byte of one beyond ASCII, 3 digit, 4 plain mark, 5 odd mark, 6 blank."""
    c = np.full(256, 5, np.uint8)
    c[65:91], c[97:123], c[128:], c[48:58] = 1, 2, 2, 3
    for ch in b".,;:!?'\"()-":
        c[ch] = 4
    c[[9, 10, 11, 12, 13, 32]] = 6
    c[:9] = 0
    return c


class Featurizer:
    def __init__(self):
        self.hasher, self.classes = WordHasher(lower=True), _classes()

    def block(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """One row of FEATURES for each text of a block; a text without words has zeros."""
        n = len(bounds) - 1
        out = np.zeros((n, len(FEATURES)))
        if not len(data):
            return out
        start, end, row, hashes = self.hasher.words(data, bounds)
        kinds = self.classes[data]
        owner = np.repeat(np.arange(n), np.diff(bounds))
        by_kind = np.bincount(owner * 7 + kinds, minlength=7 * n).reshape(n, 7)
        size = np.maximum(np.diff(bounds), 1)
        words = np.bincount(row, minlength=n)
        some = np.maximum(words, 1)
        width = end - start
        mean = lambda w: np.bincount(row, weights=w, minlength=n) / some
        letters = np.maximum(by_kind[:, 1] + by_kind[:, 2], 1)
        last = kinds[end - 1]
        marks = np.concatenate([[0], np.cumsum((kinds == 4) | (kinds == 5))])
        ends_sentence = np.isin(data[end - 1], np.frombuffer(b".!?", np.uint8))
        order = np.lexsort((hashes, row))
        r, h = row[order], hashes[order]
        fresh = np.ones(len(r), bool)
        fresh[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
        at = np.flatnonzero(fresh)
        most = np.zeros(n)
        np.maximum.at(most, r[at], np.diff(np.append(at, len(r))))
        same = np.zeros(len(row))
        same[1:] = (row[1:] == row[:-1]) & (hashes[1:] == hashes[:-1])
        breaks = data == 10
        lines = np.bincount(owner[breaks], minlength=n) + 1
        # A line's hash is the sum of its words' hashes by place, enough to tell repeated lines.
        line = np.cumsum(breaks)[start] if len(start) else np.zeros(0, np.int64)
        key = line + row
        distinct_lines = np.ones(n)
        if len(key):
            head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            place = np.arange(len(key)) - np.repeat(head, np.diff(np.append(head, len(key))))
            sums = np.add.reduceat(hashes * (2 * place + 1).astype(np.uint64), head)
            lr = row[head]
            pairs = np.unique(np.stack([lr.astype(np.uint64), sums], 1), axis=0)
            distinct_lines = np.bincount(pairs[:, 0].astype(np.int64), minlength=n) / np.maximum(np.bincount(lr, minlength=n), 1)
        columns = [
            np.log1p(words), mean(width), mean(width > 14), by_kind[:, 1] / letters, by_kind[:, 3] / size, by_kind[:, 4] / size, by_kind[:, 5] / size,
            mean((last == 5) | (last == 4)), mean(marks[end] - marks[start] >= 2), np.bincount(r[at], minlength=n) / some, mean(same), most / some,
            lines / some, distinct_lines, mean(width == 1), mean(ends_sentence),
        ]
        for i, c in enumerate(columns):
            out[:, i] = np.where(words > 0, c, 0)
        return out


def _steps(grad: np.ndarray, hess: np.ndarray, leaves: int) -> np.ndarray:
    """The values by bin of a tree of one feature with at most `leaves` leaves, grown by best gain."""
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    parts = [(0, len(grad))]

    def best(a, b):
        if b - a < 2:
            return -1.0, a
        cut = np.arange(a + 1, b)
        gl, hl, gr, hr = g[cut] - g[a], h[cut] - h[a], g[b] - g[cut], h[b] - h[cut]
        gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1)
        return float(gain.max()), int(cut[gain.argmax()])

    while len(parts) < leaves:
        gain, cut, k = max((*best(*p), k) for k, p in enumerate(parts))
        if gain <= 1e-9:
            break
        a, b = parts[k]
        parts[k : k + 1] = [(a, cut), (cut, b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1)
    return out


def _pair_steps(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """A tree of two features: the best cut of the first, and on each side the best cut of the second."""
    rows = _steps(grad.sum(axis=1), hess.sum(axis=1), 2)
    out = np.zeros_like(grad)
    for v in np.unique(rows):
        side = rows == v
        out[side] = _steps(grad[side].sum(axis=0), hess[side].sum(axis=0), 2)
    return out


class Model:
    """Bin edges, look-up tables of single features and of pairs, and an intercept."""

    def __init__(self, edges, tables, pairs, pair_tables, bias):
        self.edges, self.tables, self.pairs, self.pair_tables, self.bias = edges, tables, pairs, pair_tables, bias

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)], 1) if len(x) else np.zeros((0, len(self.edges)), np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        b, out = self.bins(x), np.full(len(x), self.bias)
        for i, t in enumerate(self.tables):
            out += t[b[:, i]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[b[:, i] // 4, b[:, j] // 4]
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """A model of P(y = 1). Without rows of both kinds it gives the share of ones (0.5 without rows) everywhere."""
    width = x.shape[1]
    if len(y) == 0 or y.min() == y.max():
        p = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return Model([np.zeros(0)] * width, [np.zeros(1)] * width, [], [], float(np.log(p / (1 - p))))
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(width)]
    model = Model(edges, [np.zeros(len(e) + 1) for e in edges], [], [], float(np.log(y.mean() / (1 - y.mean()))))
    b = model.bins(x)
    f = np.full(len(y), model.bias)

    def gradients():
        p = 1 / (1 + np.exp(-f))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i in range(width):
            g, h = gradients()
            n = len(model.tables[i])
            step = RATE * _steps(np.bincount(b[:, i], g, n), np.bincount(b[:, i], h, n), LEAVES)
            model.tables[i] += step
            f += step[b[:, i]]
    coarse, m = b // 4, BINS // 4
    g, h = gradients()
    gains = []
    for i in range(width):
        for j in range(i + 1, width):
            k = coarse[:, i] * m + coarse[:, j]
            gg, hh = np.bincount(k, g, m * m), np.bincount(k, h, m * m)
            gains.append((float((gg**2 / (hh + 1)).sum()), i, j))
    model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    model.pair_tables = [np.zeros((m, m)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for t, (i, j) in zip(model.pair_tables, model.pairs, strict=True):
            g, h = gradients()
            k = coarse[:, i] * m + coarse[:, j]
            step = RATE * _pair_steps(np.bincount(k, g, m * m).reshape(m, m), np.bincount(k, h, m * m).reshape(m, m))
            t += step
            f += step[coarse[:, i], coarse[:, j]]
    return model


def features(df: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """df[keep] with `x`, the features of each whole text."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields]

    def run(batches):
        import pyarrow as pa

        make = Featurizer()
        for batch in batches:
            found = [make.block(d, b) for _, d, b in text_blocks(batch.column(len(keep)))]
            columns = [batch.column(i) for i in range(len(keep))]
            x = np.concatenate(found) if found else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(x), pa.list_(pa.float64()))], names=[*keep, "x"])

    return arrow_map(df.select(*keep, F.col(text).alias("_text")), run, ", ".join([*fields, "x array<double>"]))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model fitted on the labelled rows of docs, `sample_rows` at most.

    The sample is the keys whose hash lies below the bound's share of all labels, so the side that is broadcast, and what
    the driver gets, are bounded by it. Keys or labels that are null teach nothing; a key that repeats, among labels or among
    documents, teaches once a pair of rows; empty tables give a model of 0.5 everywhere.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    total = known.count()
    share = min(1.0, 0.97 * sample_rows / max(total, 1))
    chosen = known.filter(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select(F.col(key).alias("_k"), F.col(label).cast("double").alias("_y")).limit(sample_rows)
    rows = docs.join(F.broadcast(chosen), docs[key] == chosen["_k"]).select(F.col("_k"), F.col("_y"), docs["text"].alias("text"))
    got = sorted((r["_k"], r["_y"], tuple(r["x"])) for r in features(rows, ("_k", "_y")).limit(2 * sample_rows).collect())
    x = np.array([g[2] for g in got]).reshape(len(got), len(FEATURES))
    return fit(x, np.array([g[1] for g in got]))


def score(df: DataFrame, model: Model, keep: tuple[str, ...], text: str = "text", threshold: float = 0.3, out: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """df[keep] with the score (0 to 1) and the prediction (1 from the threshold on), named by `out`.

    A null text scores as an empty one; repeated rows are scored each; an empty table gives an empty one; columns of df that
    are not in `keep`, whatever their names, are not read but for the text.
    """
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields]

    at = keep.index(text) if text in keep else len(keep)

    def run(batches):
        import pyarrow as pa

        make = Featurizer()
        for batch in batches:
            found = [model.score(make.block(d, b)) for _, d, b in text_blocks(batch.column(at))]
            s = np.concatenate(found) if found else np.zeros(0)
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=[*keep, *out])

    rows = df.select(*keep) if text in keep else df.select(*keep, F.col(text).alias("_text"))
    return arrow_map(rows, run, ", ".join([*fields, f"`{out[0]}` double", f"`{out[1]}` int"]))


def op7_additive_quality(spark, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from labelled documents outside fold 0 of 5."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = learn(docs.filter(~held_out).select("doc_id", "text"), labels.filter(~held_out))
    return score(docs.select("doc_id", held_out.alias("held_out"), "text"), model, ("doc_id", "held_out"))
