"""Jump consistent hashing: stable keys to shards without a ring table, in SQL functions alone.

A key jumps through shard counts 1, 2, 3, ... with the published 64-bit generator (multiplier 2862933555777941757,
increment 1); the last jump below the wanted count is its shard. When shards are appended, a key either stays or moves to
a new shard. Spark's ANSI arithmetic refuses to wrap, so the generator's state is kept as two halves of 32 bits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the generator's multiplier, in parts of 16 bits from the lowest.
MULTIPLIER = 2862933555777941757
M0, M1 = MULTIPLIER & 0xFFFF, MULTIPLIER >> 16 & 0xFFFF
M2, M3 = MULTIPLIER >> 32 & 0xFFFF, MULTIPLIER >> 48 & 0xFFFF
LOW = 0xFFFFFFFF


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(LOW))


def _times(x: Column, part0: int, part1: int) -> Column:
    """The low 32 bits of x times (part1 * 65536 + part0), for x below 2 ** 32."""
    return _low(_low(x * F.lit(part0)) + _low(F.shiftleft(_low(x * F.lit(part1)), 16)))


def _step(hi: Column, lo: Column) -> tuple[Column, Column]:
    """state * MULTIPLIER + 1 modulo 2 ** 64, as halves."""
    p0, p1 = lo * F.lit(M0), lo * F.lit(M1)
    low = _low(p0) + _low(F.shiftleft(_low(p1), 16)) + F.lit(1)
    carry = F.shiftright(low, 32) + F.shiftright(p0, 32) + F.shiftright(p1, 16)
    return _low(carry + _times(hi, M0, M1) + _times(lo, M2, M3)), _low(low)


def jump_hashes(key: Column, n_shards: int) -> Column:
    """struct<shard int, grown int>: the shards (from 0) of a long key among n_shards and among one more, from one walk.

    A null key counts as 0. Each step of a fold holds the next jump; the walk stands still once that jump is beyond. A key
    jumps about ln(n_shards) times, so a second fold, for the rest of the steps, is worked out only for the few keys that
    jump more often than a first, short one allows for.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    key, most = F.coalesce(key.cast("long"), F.lit(0).cast("long")), n_shards + 1
    none = F.lit(-1).cast("long")
    start = F.struct(_low(F.shiftrightunsigned(key, 32)).alias("hi"), _low(key).alias("lo"), none.alias("b"), none.alias("c"), F.lit(0).cast("long").alias("j"))

    def fold(s: Column, _: Column) -> Column:
        hi, lo = _step(s["hi"], s["lo"])
        top = F.shiftright(hi, 1) + F.lit(1)
        j = F.floor((s["j"] + F.lit(1)).cast("double") * (F.lit(float(1 << 31)) / top.cast("double"))).cast("long")
        moved = F.struct(hi.alias("hi"), lo.alias("lo"), F.when(s["j"] < n_shards, s["j"]).otherwise(s["b"]).alias("b"), s["j"].alias("c"), j.alias("j"))
        return F.when(s["j"] < F.lit(most), moved).otherwise(s)

    ended = lambda s: F.struct(s["b"].cast("int").alias("shard"), s["c"].cast("int").alias("grown"))
    short = min(most, 4 + int(3 * math.log(most)))
    if short == most:
        return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, fold, ended)
    first = F.aggregate(F.sequence(F.lit(1), F.lit(short)), start, fold)
    # An array of one element binds the state, which would otherwise be worked out again wherever it is named.
    rest = lambda s: F.when(s["j"] >= most, ended(s)).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(most - short)), s, fold, ended))
    return F.element_at(F.transform(F.array(first), rest), 1)


def jump_hash(key: Column, n_shards: int) -> Column:
    """The shard (int, 0 to n_shards - 1) of a long key; a null key counts as 0."""
    return jump_hashes(key, n_shards)["shard"]


def assign_shards(df: DataFrame, key: str, n_shards: int, shard: str = "shard", grown: str | None = None) -> DataFrame:
    """df with its shard, and in `grown` the shard if one more were appended. A narrow projection: no shuffle.

    Null keys go where key 0 goes; equal keys, and so repeated rows, share a shard; an empty table gives an empty one.
    A column of df named like `shard` or `grown` is replaced.
    """
    names = [c for c in df.columns if c not in (shard, grown)]
    out = df.withColumn("_both", F.element_at(F.transform(F.array(jump_hashes(F.col(key), n_shards)), lambda s: s), 1))
    return out.select(*names, F.col("_both.shard").alias(shard), *([F.col("_both.grown").alias(grown)] if grown else []))


def number_within(df: DataFrame, group: str, by: str, n_groups: int, rows_per_part: int = 20_000, slot: str = "slot", spread: Column | None = None) -> DataFrame:
    """df with the gapless position from 0 of each row in its group, whatever a group's size.

    Rows of a group fall into parts by a hash of the whole row, or by `spread`; each part is numbered on its own, and a table
    of one count for each part gives where it begins. The number of parts follows the number of rows. Only rows that are
    equal in all columns keep to one part.
    """
    from pyspark.sql import Window as W

    columns = df.columns
    total = df.count()
    parts = max(256, -(-total // (rows_per_part * n_groups)))
    hashed = spread if spread is not None else F.xxhash64(by, *[c for c in columns if c not in (group, by)])
    mix = df.withColumn("_part", F.pmod(hashed, F.lit(parts)))
    sizes = mix.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    begins = sizes.select(group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_begin"))
    inside = F.row_number().over(W.partitionBy(group, "_part").orderBy(by, *[c for c in columns if c not in (group, by)]))
    numbered = mix.withColumn("_inside", inside.cast("long") - 1)
    return numbered.join(begins, [group, "_part"]).select(*columns, (F.col("_begin") + F.col("_inside")).alias(slot))


def op9_jump_shards(spark, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 15 by doc_id, beside the shard with a seventeenth appended.

    text null: size 1 and no CRC. doc_id null: as key 0. Repeated rows take slots of their own.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    placed = assign_shards(docs, "doc_id", 16, grown="grown_shard")
    row = F.concat_ws("|", "doc_id", "size", "text_crc32", "grown_shard")
    spread = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("long")
    return number_within(placed, "shard", "doc_id", 16, spread=spread).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


#: The same in SQL: CRC-32 by its table, jumps by recursion, and slots by parts of 256 as for all but very large tables.
OP9_SQL = """
with recursive poly as (
  select list(list_reduce(list_prepend(i, range(8)), lambda a, k: case when a & 1 = 1 then xor(3988292384, a >> 1) else a >> 1 end) order by i) as tab
  from (select unnest(range(256)) as i)),
docs as (
  select row_number() over () as rid, doc_id, cast(coalesce(octet_length(encode(text)), 0) + 1 as bigint) as size,
         case when text is not null then xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::bigint)),
           lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) end as text_crc32
  from documents, poly),
jump(rid, k, b, j) as (
  select rid, (coalesce(doc_id, 0)::hugeint + 18446744073709551616::hugeint) % 18446744073709551616::hugeint, -1::bigint, 0::bigint from docs
  union all
  select rid, k, j, cast(floor((j + 1)::double * (2147483648.0::double / ((k // 8589934592::hugeint) + 1)::double)) as bigint)
  from (select rid, (k * 2862933555777941757::hugeint + 1) % 18446744073709551616::hugeint as k, j from jump where j < 17)),
placed as (select rid, cast(max(b) filter (b < 16) as int) as shard, cast(max(b) as int) as grown_shard from jump group by rid),
parted as (
  select d.*, shard, grown_shard, ('0x' || substr(md5(concat_ws('|', doc_id, size, text_crc32, grown_shard)), 1, 15))::bigint % 256 as part from docs d join placed using (rid))
select doc_id, size, text_crc32, 'key' as law, shard,
       row_number() over (partition by shard order by part, doc_id nulls first, size, text_crc32 nulls first, grown_shard) - 1 as slot, grown_shard
from parted
"""
