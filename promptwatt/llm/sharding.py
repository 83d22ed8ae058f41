"""Sharding (operator 12) by jump consistent hashing, in DataFrame functions only.

A row's shard depends on its key and the number of shards alone: the key's
digest seeds a linear congruential generator whose outputs are the jumps of a
growing number of shards, and the last jump below the number of shards is the
row's shard. No ring or table is held, and a further shard takes its fraction of
the rows from all others and moves nothing else. The expected number of jumps is
the logarithm of the number of shards; a row that needs more than the usual
number goes on in a second loop, so every row's shard is exact.

64-bit products are built from limbs of 22, 22 and 20 bits, so nothing overflows
whatever the session's arithmetic mode is.

`with_shards` needs no shuffle. `slots` numbers the rows of each shard without
gaps in the order of a digest of (key, size, checksum): equal rows are counted
first (a hot key or a group of equal rows is one row then), the digests' leading
bits deal each shard into bins of about BIN_ROWS rows, running sums over bins
and inside bins give the first slot of each distinct row, and equal rows are
unfolded in chunks that are dealt anew. Bins grow in number with the table, never
in size.

Defined results: a null text has no bytes and the checksum of no bytes; a null key is
a key of its own, the empty string's; repeated rows share a shard and have slots of their own; equal digests
are ordered by key, size and checksum; long texts are only measured and
digested; an empty table gives an empty result; only the key and the text are
read, and `with_shards` replaces columns of the names it adds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import fresh_path, stored

#: Fixed value of the hash: the generator's multiplier.
MULTIPLIER = 2862933555777941757
ROW_BYTES = 8
BIN_ROWS = 8192
CHUNK = 4096

_M22, _M20 = (1 << 22) - 1, (1 << 20) - 1
_C = [MULTIPLIER & _M22, MULTIPLIER >> 22 & _M22, MULTIPLIER >> 44]


def _seed(key: Column) -> dict[str, Column]:
    """Limbs of the first 64 bits of the key's digest."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    high, low = (F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9))
    return {"k0": low.bitwiseAND(F.lit(_M22)), "k2": F.shiftright(high, 12),
            "k1": F.shiftleft(high.bitwiseAND(F.lit(0xFFF)), 10).bitwiseOR(F.shiftright(low, 22))}


def _step(shards: int):
    """One jump of the state (b, j, limbs), while j is below the shards."""
    c0, c1, c2 = (F.lit(c).cast("long") for c in _C)

    def step(s: Column, _: Column) -> Column:
        p0 = s["k0"] * c0 + F.lit(1)
        p1 = s["k0"] * c1 + s["k1"] * c0 + F.shiftright(p0, 22)
        p2 = (s["k0"] * c2 + s["k1"] * c1 + s["k2"] * c0 + F.shiftright(p1, 22)).bitwiseAND(F.lit(_M20).cast("long"))
        k1 = p1.bitwiseAND(F.lit(_M22).cast("long"))
        drawn = F.shiftleft(p2, 11).bitwiseOR(F.shiftright(k1, 11))  # the upper 31 bits
        jump = ((s["j"] + 1) * (F.lit(float(1 << 31)) / (drawn + 1).cast("double"))).cast("long")
        moved = F.struct(s["j"].alias("b"), jump.alias("j"), p0.bitwiseAND(F.lit(_M22).cast("long")).alias("k0"), k1.alias("k1"), p2.alias("k2"))
        return F.when(s["j"] < shards, moved).otherwise(s)

    return step


def with_shards(df: DataFrame, key: str = "doc_id", shards: int = 24) -> DataFrame:
    """df with `shard` among `shards` and `grown_shard`, the shard among one more."""
    usual = min(shards, 16 + math.ceil(4 * math.log(shards + 1)))
    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"), *[v.alias(k) for k, v in sorted(_seed(F.col(key)).items())])
    out = df.withColumn("_jump", F.aggregate(F.sequence(F.lit(1), F.lit(usual)), start, _step(shards)))
    if usual < shards:
        rest = F.aggregate(F.sequence(F.lit(usual + 1), F.lit(shards)), F.col("_jump"), _step(shards))
        out = out.withColumn("_jump", F.when(F.col("_jump.j") < shards, rest).otherwise(F.col("_jump")))
    last, following = F.col("_jump.b").cast("int"), F.col("_jump.j")
    return out.withColumns({"shard": last, "grown_shard": F.when(following == shards, F.lit(shards)).otherwise(last)}).drop("_jump")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size in bytes and unsigned checksum of each row's text."""
    data = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key), (F.octet_length(data) + ROW_BYTES).cast("long").alias("size"), F.crc32(data.cast("binary")).alias("text_crc32"))


def _order(key: str) -> Column:
    """Digest that orders the rows of a shard: 60 bits, never negative."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, "size", "text_crc32")]
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts).cast("binary")), 1, 15), 16, 10).cast("long")


def slots(rows: DataFrame, key: str = "doc_id", shards: int = 24) -> DataFrame:
    """rows (key, size, text_crc32, shard, grown_shard) with their `slot`."""
    names = [key, "size", "text_crc32", "shard", "grown_shard"]
    distinct = stored(rows.groupBy(*names).agg(F.count("*").alias("_n")).withColumn("_o", _order(key)), "shard-rows")
    bits = max(0, math.ceil(math.log2(max(1, distinct.count()) / (shards * BIN_ROWS))))
    binned = distinct.withColumn("_bin", F.shiftright("_o", 60 - bits))
    bins = binned.groupBy("shard", "_bin").agg(F.sum("_n").alias("_of"))
    before = Window.partitionBy("shard").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("shard", "_bin", F.coalesce(F.sum("_of").over(before), F.lit(0)).alias("_at"))
    inside = Window.partitionBy("shard", "_bin").orderBy("_o", F.asc_nulls_first(key), "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = binned.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(bins, ["shard", "_bin"])
    placed = stored(placed.select(*names, "_n", (F.col("_at") + F.col("_in")).alias("slot")), "shard-slots")
    many = placed.filter(F.col("_n") > CHUNK).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {CHUNK}"))))
    chunks = many.withColumns({"slot": F.col("slot") + F.col("_chunk") * CHUNK, "_n": F.least(F.lit(CHUNK).cast("long"), F.col("_n") - F.col("_chunk") * CHUNK)})
    dealt = chunks.repartition("slot", "shard").drop("_chunk")
    unfold = F.explode(F.sequence(F.col("slot"), F.col("slot") + F.col("_n") - 1)).alias("slot")
    single = placed.filter(F.col("_n") <= CHUNK)
    return single.unionByName(dealt).select(*names, unfold)


def shard_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 24) -> DataFrame:
    """key, size, text_crc32, law, shard, slot and grown_shard of each row."""
    return slots(with_shards(measured(docs, key, text), key, shards), key, shards).withColumn("law", F.lit("key"))


def write_shards(docs: DataFrame, key: str = "doc_id", shards: int = 24, path: str | None = None) -> str:
    """Writes the rows under a folder for each shard (`shard=k`), straight from the
    tasks that read them, so that no hot key meets in one task; returns the path."""
    path = path or fresh_path(docs.sparkSession, "shards")
    with_shards(docs, key, shards).drop("grown_shard").write.partitionBy("shard").parquet(path)
    return path
