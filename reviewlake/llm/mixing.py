"""Mixing sources to target weights with hash-threshold histograms: no sort, and no pass over texts but one.

Every document has a fixed hash of 60 bits. Words are summed by source and the hash's top 12 bits; a running sum over a
source's at most 4,096 buckets finds the one in which its budget ends. Only rows of that bucket are summed again by the
next 12 bits, and so on until the 60 bits are used. The budget's end is then one hash value, and the mix is the filter
hash <= threshold. A larger budget gives a larger threshold, so its documents hold those of a smaller one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reviewlake.session import checkpointed

BITS, LEVELS = 12, 5
#: Sources whose plan is broadcast, at most; beyond it both sides are joined.
BROADCAST_ROWS = 100_000
WORDS = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The number of runs of other characters than space, tab and line breaks; 0 for null."""
    spaced = F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    return F.coalesce(F.when(F.length(spaced) > 0, F.size(F.split(spaced, " +"))).otherwise(0), F.lit(0)).cast("long")


def key_hash(key: Column) -> Column:
    """60 bits of the MD5 of the key as text; a null key counts as an empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, cycle: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) from one row a source (source, source_size).

    Sources by code point, null last, weigh the numbers of `cycle` in turn and share `share` times all words; none gets
    over `cap` times its own words, and what is over goes to the others by weight. That level is found in one pass:
    sources sorted by words for each unit of weight reach their cap in that order.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = sizes.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, cycle)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(cycle))) + 1).cast("int")).cast("double").alias("_w"),
    )
    full = F.col("source_size") * F.lit(float(cap))
    fill = W.orderBy(full / F.col("_w"), F.col("source").asc_nulls_last())
    ahead = fill.rowsBetween(W.unboundedPreceding, -1)
    filled = ranked.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("_all"),
        F.coalesce(F.sum(full).over(ahead), F.lit(0.0)).alias("_before"),
        F.sum("_w").over(everything).alias("_weights"),
        F.coalesce(F.sum("_w").over(ahead), F.lit(0.0)).alias("_weights_before"),
    )
    level = (F.col("_all") - F.col("_before")) / (F.col("_weights") - F.col("_weights_before"))
    at = filled.select("*", level.alias("_level"), (full / F.col("_w") <= level).alias("_full"))
    end = F.min(F.when(~F.col("_full"), F.col("_level"))).over(everything)
    first_open = F.max_by("_level", F.when(~F.col("_full"), -full / F.col("_w"))).over(everything)
    target = F.when(F.col("_full") | end.isNull(), full).otherwise(F.least(full, F.col("_w") * first_open))
    return at.select("source", "source_size", target.alias("target"))


def few(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A table of one row a source, marked for broadcast only if it has at most `rows` rows."""
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold): the largest hash taken for each source's budget.

    rows: (source, size, h); budgets: (source, budget). The document where the budget ends is taken if at least half of
    it fits. Rows of equal hash are taken together. threshold is -1 if nothing is taken. Only the first level reads all
    rows; each further one those of the bucket where a budget ends.
    """

    def within(own: DataFrame, state: DataFrame, on) -> DataFrame:
        return own.join(few(state), on).select(own["source"], own["size"], own["h"], "_left")

    start = budgets.select("source", F.col("budget").alias("_left"))
    at, done = within(rows, start, rows["source"].eqNullSafe(start["source"])), None
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        buckets = at.groupBy("source", F.shiftright("h", shift).alias("_bucket")).agg(F.sum("size").alias("_n"), F.first("_left").alias("_left"))
        running = F.sum("_n").over(W.partitionBy("source").orderBy("_bucket"))
        buckets = buckets.withColumn("_upto", running)
        if level < LEVELS - 1:
            # The first bucket whose running sum passes the budget holds its end; a budget that is never passed takes all.
            found = buckets.groupBy("source").agg(
                F.min_by(F.struct("_bucket", (F.col("_left") - (F.col("_upto") - F.col("_n"))).alias("_left")), F.when(F.col("_upto") > F.col("_left"), F.col("_bucket"))).alias("x"),
                F.max("_bucket").alias("_last"),
            )
            found = checkpointed(found)
            over = found.filter(F.col("x").isNull()).select("source", (F.shiftleft(F.col("_last") + 1, shift) - 1).alias("threshold"))
            done = over if done is None else done.unionByName(over)
            state = found.filter(F.col("x").isNotNull()).select("source", F.col("x._left").alias("_left"), F.col("x._bucket").alias("_prefix"))
            own = at.drop("_left")
            # Dealt anew, as most tasks have none of these rows left.
            at = checkpointed(within(own, state, own["source"].eqNullSafe(state["source"]) & (F.shiftright(own["h"], shift) == state["_prefix"])).repartition("source", "h"))
        else:
            # One bucket is one hash now: take it if its middle lies within the budget.
            last = buckets.groupBy("source").agg(
                F.max(F.when(F.col("_upto") - F.col("_n") / 2 <= F.col("_left"), F.col("_bucket"))).alias("_t"), F.min("_bucket").alias("_b")
            )
            done = done.unionByName(last.select("source", F.coalesce("_t", F.col("_b") - 1).alias("threshold")))
    return done


def _rows(df: DataFrame, size: Column, key: str, source: str) -> DataFrame:
    return checkpointed(df.select(F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size"), key_hash(F.col(key)).alias("h")))


def _plans(rows: DataFrame, cycle: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, target, times, threshold): one row a source."""
    targets = checkpointed(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, share, cap))
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plans = targets.select("*", times.alias("times"))
    budgets = plans.filter("source_size > 0").select("source", (F.col("target") - F.col("times") * F.col("source_size")).alias("budget"))
    ends = thresholds(rows.select("source", "size", "h"), budgets)
    joined = plans.alias("p").join(ends.alias("e"), F.expr("p.source <=> e.source"), "left")
    return checkpointed(joined.select("p.*", F.coalesce("e.threshold", F.lit(-1).cast("long")).alias("threshold")))


def mix(df: DataFrame, size: Column, key: str = "doc_id", source: str = "source", cycle: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(key, source, size, source_size, target, taken): how many words of each row the mix takes.

    A row is taken whole, floor(target / source_size) times, and once more up to the source's threshold, so no row goes
    over its size times the cap rounded up. Nulls in key or source are values of their own; a null or empty text has size
    0 and takes 0; equal keys are taken alike; a source without words has target 0; an empty table gives an empty one.
    """
    rows = _rows(df, size, key, source)
    plans = _plans(rows, cycle, share, cap)
    more = F.when(F.col("h") <= F.col("threshold"), 1).otherwise(0).cast("long")
    return rows.alias("r").join(few(plans).alias("p"), F.expr("r.source <=> p.source")).select(
        F.col("key").alias(key), F.col("r.source").alias(source), "size", "source_size", "target", (F.col("size") * (F.col("times") + more)).alias("taken")
    )


def mixed_rows(df: DataFrame, size: Column, key: str = "doc_id", source: str = "source", cycle: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of df in the mix, each as often as it is taken; a filter by thresholds, so df itself is not moved.

    The plan, one row a source, is broadcast only if it has at most `broadcast_rows` rows; else both sides are joined.
    """
    plans = _plans(_rows(df, size, key, source), cycle, share, cap)
    side = few(plans.select(F.col("source").alias("_source"), F.col("times").alias("_times"), F.col("threshold").alias("_threshold")), broadcast_rows)
    more = F.when(key_hash(df[key]) <= F.col("_threshold"), 1).otherwise(0)
    copies = F.explode(F.sequence(F.lit(1), (F.col("_times") + more).cast("int")))
    return df.join(side, df[source].eqNullSafe(F.col("_source"))).filter(F.col("_times") + more > 0).select(*[df[c] for c in df.columns], copies.alias("_copy")).select(*df.columns)


def op4_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 3, 1, 2 over 150 % of all words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs, words(F.col("text"))).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
with rows as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as h
  from documents),
sums as (select source, cast(sum(size) as bigint) as source_size from rows group by source),
ranked as (select *, case (row_number() over (order by source asc nulls last) - 1) % 3 when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as w from sums),
filled as (
  select *, 2.0::double * source_size as cap, sum(source_size) over () * 1.5::double as total, sum(w) over () as weights,
         coalesce(sum(2.0::double * source_size) over (order by 2.0::double * source_size / w, source asc nulls last rows between unbounded preceding and 1 preceding), 0) as before,
         coalesce(sum(w) over (order by 2.0::double * source_size / w, source asc nulls last rows between unbounded preceding and 1 preceding), 0) as weights_before
  from ranked),
leveled as (select *, (total - before) / (weights - weights_before) as level from filled),
judged as (select *, cap / w <= level as is_full from leveled),
opened as (select min_by(level, cap / w) as level from judged where not is_full),
targets as (select j.source, source_size, case when is_full or o.level is null then cap else least(cap, w * o.level) end as target from judged j, opened o),
plans as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as times from targets),
grouped as (select source, h, sum(size) as n from rows group by source, h),
running as (select *, sum(n) over (partition by source order by h) as upto from grouped),
ends as (
  select r.source, coalesce(max(case when upto - n / 2 <= target - times * source_size then h end), -1) as threshold
  from running r join plans p on r.source is not distinct from p.source group by r.source)
select doc_id, size, source_size, target, cast(size * (times + case when h <= threshold then 1 else 0 end) as bigint) as taken
from rows r join plans p on r.source is not distinct from p.source join ends e on r.source is not distinct from e.source
"""
