"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1 of its own, drawn from its code point. A trigram's vector binds its letters'
vectors, the first permuted twice, the second once, by component-wise products; a text's vector is the sum of its
trigrams' vectors, a language's prototype the sum over its training texts. A text gets the language of the largest cosine.

The dot product of a text with a prototype is the sum, over the text's trigrams, of that trigram's dot product with the
prototype. Trigrams of the commonest letters have a table of these numbers, those of all other letters a bounded cache, so
a text costs one look-up a letter. The text's own norm is the same factor in its cosines with all languages; the ranking
and the score do not need it.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.arrow_text import arrow_map, mixed

SYMBOLS, DIMENSIONS, SEED = 64, 2048, 20240229
#: Letters whose trigrams have a table; the blank comes first. Every other letter is as good, only looked up in the cache.
COMMON = "\0abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœğşıł"
#: Characters handled at once, and texts and trigrams whose vectors are.
BLOCK_CHARS, BLOCK_TEXTS, BLOCK_TRIGRAMS = 1 << 19, 256, 512
#: Bytes of a worker's cache of trigrams, languages that have a table of common trigrams, and languages counted at once.
CACHE_BYTES, TABLE_LANGUAGES, COUNTED_LANGUAGES = 1 << 24, 32, 16
#: Fewer trigrams do not tell how near a text is to a language; a language of fewer documents takes what all have in common.
LEAST_TRIGRAMS, LEAST_DOCUMENTS = 32, 30


@cache
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


@cache
def common_symbols() -> tuple[np.ndarray, np.ndarray]:
    """(the place in COMMON of each code point below 512, 255 for others; the code points of COMMON)."""
    points = np.array([ord(c) for c in COMMON], np.int64)
    table = np.full(512, 255, np.int64)
    table[points] = np.arange(len(points))
    return table, points


def letter_vectors(points: np.ndarray, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """The vector of +1 and -1 of each code point, as int8: the bits of a mixed counter that starts from the code point."""
    words = -(-dimensions // 64)
    at = (points.astype(np.uint64)[:, None] << np.uint64(16)) + np.arange(1, words + 1, dtype=np.uint64)[None, :]
    bits = np.unpackbits(mixed(mixed(at + np.uint64(seed)) + np.uint64(0x9E3779B97F4A7C15)).view(np.uint8), axis=1)
    return (bits[:, :dimensions].astype(np.int8) * 2 - 1).astype(np.int8)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, trigram id) of every trigram of lower-cased letters.

    A run of other characters counts as one blank, and so do the ends of a text, so one letter alone makes a trigram. A
    trigram of COMMON letters has an id from 0 on, any other one a negative id; `spelled` gives the letters back.
    """
    lower = [t.lower() if t else "" for t in texts]
    data = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in lower])
    del lower
    s = np.where(letter_table()[data], data, 0).astype(np.uint32)
    change = np.ones(len(row), bool)
    change[1:] = row[1:] != row[:-1]
    keep = s > 0
    keep[1:] |= (s[:-1] > 0) & ~change[1:]
    s, row = s[keep], row[keep]
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A blank goes before each text's first letter and behind its last one, if none is there.
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    last = np.ones(len(row), bool)
    last[:-1] = first[1:]
    before = np.flatnonzero(first & (s > 0))
    behind = np.flatnonzero(last & (s > 0)) + 1
    at = np.concatenate([behind, before])
    s = np.insert(s, at, 0)
    row = np.insert(row, at, np.concatenate([row[behind - 1], row[before]]))
    table, _ = common_symbols()
    symbol = np.where(s < len(table), table[np.minimum(s, len(table) - 1)], 255)
    good = (row[:-2] == row[1:-1]) & (row[2:] == row[1:-1]) & (s[1:-1] > 0)
    ids = (symbol[:-2] << 12) | (symbol[1:-1] << 6) | symbol[2:]
    other = (symbol == 255)[:-2] | (symbol == 255)[1:-1] | (symbol == 255)[2:]
    if other.any():
        wide = s.astype(np.int64)
        ids = np.where(other, -1 - ((wide[:-2] << 42) | (wide[1:-1] << 21) | wide[2:]), ids)
    return row[1:-1][good].astype(np.int64), ids[good]


def spelled(ids: np.ndarray) -> np.ndarray:
    """(trigrams, 3): the code points of trigram ids; 0 is the blank."""
    _, points = common_symbols()
    packed, plain = -1 - ids, np.maximum(ids, 0)
    wide = np.stack([packed >> 42, (packed >> 21) & 0x1FFFFF, packed & 0x1FFFFF], 1)
    near = points[np.stack([plain >> 12, (plain >> 6) & 63, plain & 63], 1)]
    return np.where((ids < 0)[:, None], wide, near)


def trigram_vectors(ids: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """The vector of each trigram id, as int8."""
    points, at = np.unique(spelled(ids), return_inverse=True)
    v, at = letter_vectors(points, dimensions, seed), at.reshape(-1, 3)
    return np.roll(v, 2, axis=1)[at[:, 0]] * np.roll(v, 1, axis=1)[at[:, 1]] * v[at[:, 2]]


def bundled(ids: np.ndarray, counts: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """The sum of the vectors of distinct trigrams, each as often as counted: whole numbers, exact in double precision."""
    out = np.zeros(dimensions)
    plain = ids >= 0
    if plain.any():
        cube = np.bincount(ids[plain], counts[plain].astype(float), SYMBOLS**3).reshape(SYMBOLS, SYMBOLS, SYMBOLS)
        v = letter_vectors(common_symbols()[1], dimensions, seed).astype(float)
        twice, once = np.roll(v, 2, axis=1), np.roll(v, 1, axis=1)
        for b in range(1, SYMBOLS):
            if cube[:, b, :].any():
                out += once[b] * ((cube[:, b, :] @ v) * twice).sum(axis=0)
    rest, n = ids[~plain], counts[~plain].astype(float)
    for a in range(0, len(rest), BLOCK_TRIGRAMS):
        out += n[a : a + BLOCK_TRIGRAMS] @ trigram_vectors(rest[a : a + BLOCK_TRIGRAMS], dimensions, seed).astype(float)
    return out.astype(np.int64)


class Dots:
    """The dot product of each trigram's vector with each prototype, scaled to length 1."""

    def __init__(self, prototypes: np.ndarray, dimensions: int, seed: int):
        norms = np.sqrt((prototypes.astype(np.float64) ** 2).sum(axis=1))
        self.units = (prototypes / np.where(norms > 0, norms, 1)[:, None]).astype(np.float32)
        self.dimensions, self.seed = dimensions, seed
        self.most = CACHE_BYTES // (8 + 4 * max(1, len(self.units)))
        self._clear()
        self.table = None
        if len(self.units) <= TABLE_LANGUAGES:
            v = letter_vectors(common_symbols()[1], dimensions, seed).astype(np.float32)
            twice, once = np.roll(v, 2, axis=1), np.roll(v, 1, axis=1)
            self.table = np.zeros((SYMBOLS, SYMBOLS, SYMBOLS, len(self.units)), np.float32)
            for k, unit in enumerate(self.units):
                for b in range(1, SYMBOLS):
                    self.table[:, b, :, k] = twice @ (v * (once[b] * unit)).T
            self.table = self.table.reshape(SYMBOLS**3, len(self.units))

    def _clear(self):
        self.keys, self.values = np.zeros(0, np.int64), np.zeros((0, len(self.units)), np.float32)

    def of(self, ids: np.ndarray) -> np.ndarray:
        """(trigrams, languages)."""
        if self.table is not None:
            if not (ids < 0).any():
                return self.table[ids]
            out = self.table[np.maximum(ids, 0)]
            rare = np.flatnonzero(ids < 0)
        else:
            out, rare = np.zeros((len(ids), len(self.units)), np.float32), np.arange(len(ids))
        found, place = np.unique(ids[rare], return_inverse=True)
        for a in range(0, len(found), self.most):
            part = found[a : a + self.most]
            new = part[~np.isin(part, self.keys)]
            if len(new):
                if len(self.keys) + len(new) > self.most:
                    self._clear()
                    new = part
                made = [trigram_vectors(new[i : i + BLOCK_TRIGRAMS], self.dimensions, self.seed).astype(np.float32) @ self.units.T for i in range(0, len(new), BLOCK_TRIGRAMS)]
                keys = np.concatenate([self.keys, new])
                order = np.argsort(keys)
                self.keys, self.values = keys[order], np.concatenate([self.values, *made])[order]
            own = (place >= a) & (place < a + len(part))
            out[rare[own]] = self.values[np.searchsorted(self.keys, part)][place[own] - a]
        return out


#: The worker's tables of the last prototypes it has scored with.
_KEPT: dict[int, Dots] = {}


def worker_dots(stamp: int, prototypes: np.ndarray, dimensions: int, seed: int) -> Dots:
    if stamp not in _KEPT:
        _KEPT.clear()
        _KEPT[stamp] = Dots(prototypes, dimensions, seed)
    return _KEPT[stamp]


def own_norms(row: np.ndarray, ids: np.ndarray, n: int, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """The norm of the vector of each of n texts, from the trigrams of `trigrams`; exact, by blocks of bounded size."""
    out = np.zeros(n)
    for first in range(0, n, BLOCK_TEXTS):
        size = min(BLOCK_TEXTS, n - first)
        lo, hi = np.searchsorted(row, (first, first + size))
        found, kind = np.unique(ids[lo:hi], return_inverse=True)
        cells, counts = np.unique(kind * size + (row[lo:hi] - first), return_counts=True)
        place, at = np.divmod(cells, size)
        total = np.zeros((size, dimensions), np.float32)
        for a in range(0, len(found), BLOCK_TRIGRAMS):
            s = found[a : a + BLOCK_TRIGRAMS]
            i, j = np.searchsorted(place, (a, a + len(s)))
            many = np.zeros((size, len(s)), np.float32)
            many[at[i:j], place[i:j] - a] = counts[i:j]
            total += many @ trigram_vectors(s, dimensions, seed).astype(np.float32)
        out[first : first + size] = np.sqrt((total.astype(np.float64) ** 2).sum(axis=1))
    return out


def text_runs(texts, limit: int = BLOCK_CHARS):
    """(first row, texts) of runs of rows with about `limit` characters; a longer text comes alone."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        if run and size + len(t or "") > limit:
            yield first, run
            first, run, size = i, [], 0
        run.append(t)
        size += len(t or "")
    if run:
        yield first, run


def learn(df: DataFrame, lang: str = "lang", text: str = "text", dimensions: int = DIMENSIONS, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """(languages in order, prototypes) from all rows of df with a text and a language.

    Each task sends one vector for each language, and Spark adds them up component by component, so what reaches the
    driver is one vector for each language: 16 kB each. A task counts the trigrams of a few languages at a time and keeps
    sums of vectors of the others. A text weighs by its letters. No usable row gives no language.
    """

    def run(batches):
        import pyarrow as pa

        cubes, rare, sums, size = {}, {}, {}, 0

        def bundle():
            for one, cube in cubes.items():
                at = np.flatnonzero(cube)
                sums[one] = sums.get(one, 0) + bundled(at, cube[at], dimensions, seed)
            for one, parts in rare.items():
                ids, n = np.unique(np.concatenate(parts), return_counts=True)
                sums[one] = sums.get(one, 0) + bundled(ids, n, dimensions, seed)
            cubes.clear()
            rare.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, texts in text_runs(batch.column(1).to_pylist()):
                row, ids = trigrams(texts)
                names, code = np.unique(np.array(langs[first : first + len(texts)], object).astype(str), return_inverse=True)
                own = code[row]
                for k, one in enumerate(names):
                    found = ids[own == k]
                    plain = found[found >= 0]
                    if len(plain):
                        cubes[str(one)] = cubes.get(str(one), 0) + np.bincount(plain, minlength=SYMBOLS**3)
                    if len(plain) < len(found):
                        rare.setdefault(str(one), []).append(found[found < 0])
                        size += len(found) - len(plain)
                    if size > BLOCK_CHARS or len(cubes) > COUNTED_LANGUAGES:
                        bundle()
                        size = 0
        bundle()
        if sums:
            names = sorted(sums)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([sums[x] for x in names], pa.list_(pa.int64()))], names=["lang", "v"])

    rows = df.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    parts = arrow_map(rows, run, "lang string, v array<long>").select("lang", F.posexplode("v").alias("i", "x"))
    sums = parts.groupBy("lang", "i").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v"))
    found = sorted(sums.collect(), key=lambda r: r["lang"])
    return [r["lang"] for r in found], np.array([r["v"] for r in found], np.int64).reshape(len(found), dimensions)


def predict(df: DataFrame, names: list[str], prototypes: np.ndarray, keep: tuple[str, ...], text: str = "text", dimensions: int = DIMENSIONS, seed: int = SEED, out: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """df[keep] with the predicted language and its score, named by `out`.

    score: the best cosine's part of the sum of all positive ones, from 0 to 1. A text that is null or without a letter,
    or no learned language, gives `und` and 0. Equal cosines give the name that comes first. Three more names in `out` add
    the best cosine itself, own norm included, its lead over the second best and the number of trigrams. Repeated rows are
    told each; an empty table gives an empty one; other columns of df than `keep` and the text are not read.
    """
    near = len(out) > 2
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields]
    at = keep.index(text) if text in keep else len(keep)
    stamp = hash((tuple(names), prototypes.tobytes()))
    block = max(1 << 12, BLOCK_CHARS * 8 // max(8, len(names)))

    def run(batches):
        import pyarrow as pa

        dots_of = worker_dots(stamp, prototypes, dimensions, seed) if names else None
        for batch in batches:
            best, score, cosine, lead, size = [], [], [], [], []
            for _, texts in text_runs(batch.column(at).to_pylist(), block):
                row, ids = trigrams(texts)
                n = np.bincount(row, minlength=len(texts))
                size += n.tolist()
                if not names:
                    cosine += [0.0] * len(texts)
                    lead += [0.0] * len(texts)
                    best += ["und"] * len(texts)
                    score += [0.0] * len(texts)
                    continue
                dots = np.zeros((len(texts), len(names)))
                for a in range(0, len(ids), block):
                    own = row[a : a + block]
                    weights = dots_of.of(ids[a : a + block])
                    for k in range(len(names)):
                        dots[:, k] += np.bincount(own, weights=weights[:, k], minlength=len(texts))
                top = dots.argmax(axis=1)
                positive = np.maximum(dots, 0)
                total = positive.sum(axis=1)
                share = np.where(total > 0, positive[np.arange(len(texts)), top] / np.where(total > 0, total, 1), 0.0)
                best += [names[k] if m else "und" for k, m in zip(top, n, strict=True)]
                score += np.where(n > 0, share, 0.0).tolist()
                if near:
                    norms = own_norms(row, ids, len(texts), dimensions, seed)
                    ranked = np.sort(dots / np.where(norms > 0, norms, 1)[:, None], axis=1)
                    cosine += ranked[:, -1].tolist()
                    lead += (ranked[:, -1] - (ranked[:, -2] if len(names) > 1 else 0)).tolist()
            made = [*(batch.column(i) for i in range(len(keep))), pa.array(best, pa.string()), pa.array(score, pa.float64())]
            if near:
                made += [pa.array(cosine, pa.float64()), pa.array(lead, pa.float64()), pa.array(size, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=[*keep, *out])

    rows = df.select(*keep) if text in keep else df.select(*keep, F.col(text).alias("_text"))
    return arrow_map(rows, run, ", ".join([*fields, *(f"`{x}` {t}" for x, t in zip(out, ("string", "double", "double", "double", "long")))]))


def typical(df: DataFrame, names: list[str], prototypes: np.ndarray, lang: str = "lang", text: str = "text") -> dict[str, tuple[float, float]]:
    """For each language (k, lead): its learning documents of n trigrams have a cosine of sqrt(n / (n + k)), and a lead
    over the second language of `lead` times that, both as medians.

    A text is its language's direction n times over and noise that grows by the root of n, hence the form.
    """
    rows = df.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    told = predict(rows, names, prototypes, ("lang",), out=("_p", "_s", "_c", "_l", "_n"))
    good = told.filter((F.col("_p") == F.col("lang")) & (F.col("_n") >= LEAST_TRIGRAMS) & (F.col("_c") > 0))
    k, lead = F.col("_n") * F.greatest(F.lit(0.0), 1 / F.col("_c") ** 2 - 1), F.col("_l") / F.col("_c")
    sums = good.rollup("lang").agg(F.count("*").alias("n"), F.percentile_approx(k, 0.5).alias("k"), F.percentile_approx(lead, 0.5).alias("lead")).collect()
    found = {r["lang"]: r for r in sums}
    every = found.get(None)
    if every is None or not every["n"]:
        return {}
    pick = lambda x: found[x] if x in found and found[x]["n"] >= LEAST_DOCUMENTS else every
    return {x: (pick(x)["k"], pick(x)["lead"]) for x in names}


def stands_out(usual: dict[str, tuple[float, float]], lang: str, cosine: str, lead: str, n: str, least_cosine: float, least_lead: float) -> Column:
    """Whether a text reaches these parts of the cosine and the lead that are typical of its language at its length; true
    for texts too short to tell."""
    if not usual:
        return F.lit(True)
    of = lambda i: F.create_map(*(F.lit(x) for name, v in usual.items() for x in (name, float(v[i]))))[F.col(lang)]
    expected = F.sqrt(F.col(n) / (F.col(n) + of(0)))
    return (F.col(n) < LEAST_TRIGRAMS) | (F.col(cosine) >= least_cosine * expected) & (F.col(lead) >= least_lead * of(1) * expected)


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def op6_hyperdimensional_lang(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents outside fold 2 of 4."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = fold(F.col("doc_id"), 4) == 2
    names, prototypes = learn(docs.filter(~held_out))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), names, prototypes, ("doc_id", "held_out"))
