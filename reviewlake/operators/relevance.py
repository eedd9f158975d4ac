"""Community posts: summaries, sentences with owners, relevance scores and gates, filter statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlake.functions import text as T
from reviewlake.functions import vectors as V
from reviewlake.operators.preprocess import numbered


def query_terms(df: DataFrame, term: str, order: Sequence[str], cap: int) -> DataFrame:
    """(term, n): the first `cap` distinct non-empty terms by the order of their first rows, numbered from 1.

    Each term is reduced to its first place before they are ordered, and only `cap` rows are gathered.
    """
    first = df.filter(F.col(term) != "").groupBy(F.col(term).alias("term")).agg(F.min(F.struct(*order)).alias("_o"))
    few = first.orderBy("_o", "term").limit(cap)
    return few.select("term", F.row_number().over(W.orderBy("_o", "term")).alias("n"))


def sentence_score(s: Column) -> Column:
    marked = F.when(s.rlike("[\\[\\](){}“”\"']"), 0.05).otherwise(0.0)
    digit = F.when(s.rlike("\\p{Nd}"), 0.05).otherwise(0.0)
    return F.length(s) / 100.0 + (marked + digit)


def extractive_summary(parts: Column, most: int) -> Column:
    """At most `most` sentences: all in order if they are few, else the best by score, one for each opening of 32 characters."""
    def best(p: Column) -> Column:
        scored = F.transform(p, lambda s, i: F.struct((-sentence_score(s)).alias("k"), i.alias("i"), s.alias("s")))
        return F.transform(F.array_sort(scored), lambda x: x["s"])

    def firsts(ranked: Column) -> Column:
        def of(openings: Column) -> Column:
            return F.filter(ranked, lambda s, i: F.array_position(openings, F.substring(s, 1, 32)) == i + 1)

        return once(F.transform(ranked, lambda s: F.substring(s, 1, 32)), of)

    # Arrays of one element bind what would otherwise be worked out again for every sentence.
    once = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)
    return once(parts, lambda p: F.when(F.size(p) <= most, p).otherwise(F.slice(once(best(p), firsts), 1, most)))


def summarize_row(title: Column, body: Column, summary: Column, most: int) -> Column:
    given = T.strip(F.coalesce(summary, F.lit("")))
    text = T.strip(F.concat(T.strip(F.coalesce(title, F.lit(""))), F.lit("\n"), T.strip(F.coalesce(body, F.lit("")))))
    return F.when(given != "", F.slice(T.community_sentences(given), 1, most)).otherwise(extractive_summary(T.community_sentences(text), most))


def flatten_sentences(posts: DataFrame, parts: Column, order: str) -> DataFrame:
    """One row a sentence with its post's columns, its position and a serial from 1 over all posts.

    Posts are numbered, each taking as many numbers as it has sentences, so that what is written holds a post once and not
    once a sentence. Columns that are of no use beside a sentence, such as bodies, are best dropped before.
    """
    ordered = numbered(posts.withColumn("_parts", parts), order, "_first", F.coalesce(F.size("_parts"), F.lit(0)))
    flat = ordered.select("*", F.posexplode("_parts").alias("sent_pos", "sentence"))
    return flat.withColumn("serial", F.col("_first") + F.col("sent_pos") + 1).drop("_parts", "_first")


def max_similarity(vector: Column, queries: Sequence[str], token: str, dims: int) -> Column:
    """The largest dot product with the queries' vectors; 0 without queries. The list of queries is short by its cap."""
    if not queries:
        return F.lit(0.0)
    embedded = [V.hash_embed_text(q, token, dims) for q in queries]
    # An array of one element binds the vector, which would otherwise be worked out again for every query.
    return F.element_at(F.transform(F.array(vector), lambda v: F.array_max(F.array(*[V.fused_dot(v, q) for q in embedded]))), 1)


def dual_relevance(df: DataFrame, vector: str, sentence: str, aliases: Sequence[str], terms: Sequence[str], bonus_terms: Sequence[str], token: str, dims: int, alias_cap: int = 32, facet_cap: int = 64) -> DataFrame:
    """df with alias_sim, facet_sim and total, their larger one plus the lexical bonus."""
    a = max_similarity(F.col(vector), T.build_queries(aliases, alias_cap), token, dims)
    f = max_similarity(F.col(vector), T.build_queries(terms, facet_cap), token, dims)
    return df.withColumn("alias_sim", a).withColumn("facet_sim", f).withColumn("total", F.greatest("alias_sim", "facet_sim") + T.lexical_bonus(F.col(sentence), bonus_terms))


def gate(sentence: Column, alias_sim: Column, total: Column, aliases: Sequence[str], ban_terms: Sequence[str], tau: float, alias_tau: float, ban_mode: str) -> Column:
    """Whether a sentence is kept. strict and soft agree: a banned term needs an alias in the same sentence."""
    if ban_mode not in ("strict", "soft", "off"):
        raise ValueError(f"unknown ban mode: {ban_mode}")
    named = T.contains_any(sentence, aliases)
    ok = named | (alias_sim >= alias_tau)
    if ban_mode != "off":
        ok = ok & (~T.contains_any(sentence, ban_terms) | named)
    return ok & (total >= tau)


def filter_stats(df: DataFrame, kept: str = "kept", alias_hit: str = "alias_hit", banned: str = "banned") -> DataFrame:
    k, a, b = F.col(kept), F.col(alias_hit), F.col(banned)
    share = lambda c: F.coalesce(F.avg(c.cast("double")), F.lit(0.0))
    return df.agg(
        F.count("*").alias("total_sentences"),
        F.count_if(k).alias("kept_sentences"),
        share(k).alias("keep_rate"),
        share(a).alias("alias_hit_rate_all"),
        share(F.when(k, a)).alias("alias_hit_rate_kept"),
        F.count_if(b & ~k).alias("banned_excluded"),
    )


def alias_first(reps: Column, aliases: Sequence[str]) -> Column:
    """Representatives that name an alias first, otherwise in their order."""
    keyed = F.transform(reps, lambda s, i: F.struct((~T.contains_any(s, aliases)).alias("k"), i.alias("i"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda x: x["s"])
