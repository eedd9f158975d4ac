"""Text functions as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlake.config import LanguagePack, Settings

# What cleaning keeps of a text.
LAUGHS = "(ㅋ)\\1{2,}"
OTHERS = r"[^\p{L}\p{N}_\s\x{AC00}-\x{D7A3}.!?]+"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column) -> Column:
    """Strip, shorten laughs to two, keep the last mark of a run of ! and ?, drop other symbols. A null gives ''."""
    out = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), LAUGHS, "$1$1")
    out = F.regexp_replace(out, "(!|\\?){2,}", "$1")
    return F.regexp_replace(out, OTHERS, "")


def blank_to_null(c: Column, extra: Sequence[str] = ()) -> Column:
    t = F.trim(c)
    return F.when(t.isin("", "nan", "None", *extra), F.lit(None)).otherwise(c)


def tokens(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1))


def full_match(c: Column, pattern: str) -> Column:
    """Whether the whole text matches, not only a part of it."""
    return c.rlike(f"^(?:{pattern})$")


def counted(found: Column) -> Column:
    """array<struct<term, n>>: the distinct tokens of an array with their counts, by one sort and one pass."""

    def runs(bound: Column) -> Column:
        own = bound["t"]
        new = F.filter(F.sequence(F.lit(0), F.size(own) - 1), lambda i: (i == 0) | (F.get(own, i) != F.get(own, i - 1)))
        ends = lambda starts: F.transform(starts, lambda at, k: F.struct(F.get(own, at).alias("term"), (F.coalesce(F.get(starts, k + 1), F.size(own)) - at).alias("n")))
        return F.element_at(F.transform(F.array(new), ends), 1)

    none = F.array().cast("array<struct<term:string,n:int>>")
    # Arrays of one element bind what would otherwise be worked out again for every token.
    return F.when(F.size(found) > 0, F.element_at(F.transform(F.array(F.struct(F.sort_array(found).alias("t"))), runs), 1)).otherwise(none)


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays as sets; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def contains_any(c: Column, terms: Sequence[str]) -> Column:
    """Whether any non-empty term is part of the text; false for a null text or no terms."""
    wanted = [t for t in terms if t]
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.exists(F.array(*map(F.lit, wanted)), lambda t: c.contains(t)), F.lit(False))


def lexical_bonus(c: Column, terms: Sequence[str]) -> Column:
    """0.1 for each term in the text, 0.3 at most; a term listed twice counts twice."""
    wanted = [t for t in terms if t]
    if not wanted:
        return F.lit(0.0)
    hits = F.size(F.filter(F.array(*map(F.lit, wanted)), lambda t: c.contains(t)))
    return F.least(hits * F.lit(0.1), F.lit(0.3))


def build_queries(terms: Sequence[str | None], cap: int) -> list[str]:
    """Non-empty terms, the first of each, `cap` at most."""
    return list(dict.fromkeys(t for t in terms if t))[:cap]


def build_queries_column(terms: Column, cap: int) -> Column:
    return F.slice(F.array_distinct(F.filter(terms, lambda t: t.isNotNull() & (t != ""))), 1, cap)


def sentences(c: Column) -> Column:
    """Sentences by end marks before white space and by line breaks; trimmed, blank ones left out."""
    parts = F.split(F.coalesce(c, F.lit("")), r"(?<=[.!?。…])\s+|\n")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def community_sentences(c: Column) -> Column:
    """As `sentences`, by end marks and line breaks, for posts; a single sentence with line breaks is cut into lines."""
    text = F.coalesce(c, F.lit(""))
    parts = F.filter(F.transform(F.split(text, r"(?<=[.!?。…])\s+|\n+"), strip), lambda s: s != "")
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda s: s != "")
    return F.when((F.size(parts) <= 1) & text.contains("\n"), lines).otherwise(parts)


def connectives(c: Column, pack: LanguagePack) -> Column:
    """array<struct<idx int, kind string, word string>>: all occurrences by position (from 0), then by the pack's order."""
    words = [(kind, word) for kind, own in pack.connectives.items() for word in own]
    listed = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(k).alias("kind"), F.lit(w).alias("word")) for n, (k, w) in enumerate(words)])
    # Most words are in no given sentence, and a plain search tells that without a pattern.
    listed = F.filter(listed, lambda w: F.contains(c, w["word"]))

    def found(w: Column) -> Column:
        # Pieces between occurrences give their places: the length of all before, and of the words between.
        pieces = F.transform(F.split(c, F.concat(F.lit("\\Q"), w["word"], F.lit("\\E")), -1), lambda p: F.length(p))
        ends = F.aggregate(
            F.slice(pieces, 1, F.size(pieces) - 1),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
            lambda s, p: F.struct((s["at"] + p + F.length(w["word"])).alias("at"), F.concat(s["all"], F.array(s["at"] + p)).alias("all")),
            lambda s: s["all"],
        )
        return F.transform(ends, lambda i: F.struct(i.alias("idx"), w["n"].alias("n"), w["kind"].alias("kind"), w["word"].alias("word")))

    every = F.array_sort(F.flatten(F.transform(listed, found)))
    return F.transform(every, lambda x: F.struct(x["idx"].alias("idx"), x["kind"].alias("kind"), x["word"].alias("word")))


def clauses(sentence: Column, settings: Settings, distance=None) -> Column:
    """The clauses of one sentence: a fold over its connectives from left to right.

    A cut goes before a connective if both sides are long enough and differ enough: by the Jaccard similarity of their
    tokens, or by `distance(left, right)` if an embedding is given. Conditionals never cut; at most `split_max` cuts.
    """
    pack = settings.language
    found = connectives(sentence, pack)
    if pack.enumeration:
        at = F.regexp_instr(sentence, F.lit(f"({pack.enumeration})"))
        end = at - 1 + F.length(F.regexp_extract(sentence, f"({pack.enumeration})", 1))
        guard = F.array(F.struct(end.alias("idx"), F.lit("additive").alias("kind"), F.lit("").alias("word")))
        found = F.when((F.size(found) == 0) & (at > 0), guard).otherwise(found)

    def fold(s: Column, c: Column) -> Column:
        def judged(sides: Column) -> Column:
            left, right = sides["l"], sides["r"]
            j = jaccard(F.array_distinct(tokens(left, pack.token)), F.array_distinct(tokens(right, pack.token)))
            limit = F.when(c["kind"] == "contrast", settings.split_jaccard_contrast).otherwise(settings.split_jaccard_add)
            differs = j <= limit
            if distance is not None:
                far = F.when(c["kind"] == "contrast", settings.split_distance * 0.85).otherwise(settings.split_distance)
                differs = differs | (distance(left, right) >= far)
            cut = (F.length(left) >= settings.split_min_length) & (F.length(right) >= settings.split_min_length) & differs
            return F.when(cut, F.struct(c["idx"].alias("left"), (s["used"] + 1).alias("used"), F.concat(s["parts"], F.array(left)).alias("parts"))).otherwise(s)

        # An array of one element binds both sides, which would otherwise be cut out anew wherever they are named.
        sides = F.struct(strip(F.substring(sentence, s["left"] + 1, c["idx"] - s["left"])).alias("l"), strip(F.substring(sentence, c["idx"] + 1, F.length(sentence))).alias("r"))
        may = (s["used"] < settings.split_max) & (c["idx"] > s["left"] + 1) & (c["kind"] != "conditional")
        return F.when(may, F.element_at(F.transform(F.array(sides), judged), 1)).otherwise(s)

    start = F.struct(F.lit(0).alias("left"), F.lit(0).alias("used"), F.array().cast("array<string>").alias("parts"))
    whole = F.filter(F.array(strip(sentence)), lambda p: p != "")
    cut = lambda own: F.aggregate(
        own, start, fold, lambda s: F.filter(F.concat(s["parts"], F.array(strip(F.substring(sentence, s["left"] + 1, F.length(sentence))))), lambda p: p != "")
    )
    return F.element_at(F.transform(F.array(found), lambda own: F.when(F.size(own) == 0, whole).otherwise(cut(own))), 1)


def post_id(product: Column, link: Column, title: Column) -> Column:
    h = F.substring(F.md5(F.concat(F.coalesce(link, F.lit("")), F.lit("|"), F.coalesce(title, F.lit("")))), 1, 10)
    return F.concat(F.lit("C-"), product, F.lit("-"), h)


def signature(representatives: Column, cluster: Column) -> Column:
    """16 digits of the SHA-1 of up to three representatives, joined, trimmed and lower-cased, or of the cluster's name."""
    text = F.lower(strip(F.array_join(F.slice(F.coalesce(representatives, F.array().cast("array<string>")), 1, 3), " ")))
    text = F.when(text == "", F.concat(F.lit("cluster:"), cluster.cast("string"))).otherwise(text)
    return F.substring(F.sha1(text), 1, 16)
