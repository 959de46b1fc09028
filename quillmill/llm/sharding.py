"""Sharding by sampled splitters: shards of near equal bytes, equal texts side by side.

Size-weighted samples of the order key give the limits of many small key ranges; a range
that turns out overfull is cut again from a sample of its own rows. The exact bytes of
every range then fix its place on one line of all bytes, and a shard is a 1/n piece of
that line. The limits only decide how the work is spread: a row's place on the line
depends on the keys before it, so other samples give the same shards, except that a
group of equal keys weighing more than ``1/WHOLE`` of a shard may be cut elsewhere.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm.common import exact_hash, locate, materialize, read, uniform
from quillmill.llm.registry import query

#: A group of equal keys stays in one shard unless it weighs more than 1/WHOLE of a shard.
WHOLE = 16
#: Ranges per shard at least, rows per range about, and ranges in all at most.
RANGES_PER_SHARD = 16
ROWS_PER_RANGE = 200_000
MAX_RANGES = 1 << 16
#: Sampled keys per range (so at most about a million keys reach the driver).
SAMPLES_PER_RANGE = 16
#: A range is overfull at so many times its fair share; it is cut again so many times at most.
OVERFULL = 2
RECUTS = 2


def _sampled(keys: DataFrame, wanted: int, total: int, seed: int) -> list[tuple]:
    """(group, id, weight) of a size-weighted sample, in key order; unbiased for bytes."""
    share = wanted * SAMPLES_PER_RANGE / max(total, 1)
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(share))
    picked = keys.where(uniform(F.lit(seed), F.col("grp"), F.col("id")) < chance)
    rows = picked.select("grp", "id", (F.col("size") / chance).alias("weight")).collect()
    return sorted(((r.grp, r.id, r.weight) for r in rows), key=lambda r: (r[0], r[1] is not None, r[1]))


def _cuts(sample: list[tuple], wanted: int, heavy: float) -> set[tuple]:
    """Quantiles of the sample by weight: (group, None) before a group, (group, id) inside a heavy one."""
    weight_of: dict = {}
    for grp, _, weight in sample:
        weight_of[grp] = weight_of.get(grp, 0.0) + weight
    step, seen, due, cuts = sum(weight_of.values()) / max(wanted, 1), 0.0, 1, set()
    for grp, ident, weight in sample:
        seen += weight
        if seen >= due * step:
            cuts.add((grp, ident) if weight_of[grp] > heavy else (grp, None))
            due = int(seen / step) + 1
    return cuts


def _range_of(cuts: set[tuple], id_type: str) -> Column:
    ordered = sorted(cuts, key=lambda c: (c[0], c[1] is not None, c[1]))
    limits = [{"g": g} if i is None else {"g": g, "i": i} for g, i in ordered]
    key = F.struct(F.col("grp").alias("g"), F.col("id").alias("i"))
    return locate(key, limits, f"struct<g:bigint,i:{id_type}>").cast("int")


def shard_rows(rows: DataFrame, shards: int) -> DataFrame:
    """Adds shard and slot to ``rows`` of (id, grp long, size long, ...), dealing bytes evenly.

    ``grp`` is the leading part of the order key: rows of one group stay together. Slots count
    from 0 without gaps in every shard. Null ids sort first; repeated rows are placed one
    after the other; no rows give no shards. Other columns pass through (they must not be
    called rng, rn, run, first, weight, shard, slot or before).
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    spark = rows.sparkSession
    id_type = rows.schema["id"].dataType.simpleString()
    extra = [c for c in rows.columns if c not in ("id", "grp", "size")]
    keys = materialize(rows, "shard-keys")
    n, total = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    wanted = min(max(RANGES_PER_SHARD * shards, math.ceil(n / ROWS_PER_RANGE)), MAX_RANGES)
    target, fair = total / shards, total / wanted
    cuts = _cuts(_sampled(keys, wanted, total, 1), wanted, target / WHOLE)
    for again in range(RECUTS + 1):
        placed = keys.withColumn("rng", _range_of(cuts, id_type))
        stats = placed.groupBy("rng").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        ranges = sorted(stats.collect())
        over = [r.rng for r in ranges if r.bytes > OVERFULL * fair and r.n > 1]
        if not over or again == RECUTS or len(cuts) >= MAX_RANGES:
            break
        inside = placed.where(F.col("rng").isin(over))
        bytes_in = sum(r.bytes for r in ranges if r.rng in set(over))
        more = math.ceil(bytes_in / fair) * 2
        new = cuts | _cuts(_sampled(inside, more, bytes_in, 2 + again), more, target / WHOLE)
        if new == cuts:
            break
        cuts = new
    offsets, sofar = [], 0
    for r in ranges:
        offsets.append((r.rng, sofar))
        sofar += r.bytes
    before = spark.createDataFrame(offsets, "rng int, before bigint")
    in_range = Window.partitionBy("rng").orderBy("grp", "id", "size", *extra)
    group = Window.partitionBy("rng", "grp")
    line = (
        placed.withColumn("rn", F.row_number().over(in_range))
        .withColumn("run", F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("first", F.min(F.col("run") - F.col("size")).over(group))
        .withColumn("weight", F.sum("size").over(group))
        .join(F.broadcast(before), "rng")  # at most MAX_RANGES small rows
    )
    # twice the middle of the group (of the row, if the group is heavy) on the line of all bytes
    middle = F.when(
        F.col("weight") * WHOLE * shards <= total, 2 * (F.col("before") + F.col("first")) + F.col("weight")
    ).otherwise(2 * (F.col("before") + F.col("run")) - F.col("size"))
    shard = F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards) / F.lit(float(2 * max(total, 1))))).cast("int")
    dealt = materialize(line.withColumn("shard", shard).select("id", "grp", "size", *extra, "rng", "rn", "shard"), "shards")
    pieces = dealt.groupBy("rng", "shard").agg(F.count("*").alias("n"), F.min("rn").alias("first")).collect()
    sofar_in: dict[int, int] = {}
    starts = []
    for p in sorted(pieces, key=lambda p: (p.shard, p.rng)):
        starts.append((p.rng, p.shard, sofar_in.get(p.shard, 0) - p.first))
        sofar_in[p.shard] = sofar_in.get(p.shard, 0) + p.n
    start = spark.createDataFrame(starts, "rng int, shard int, before bigint")
    # one row for each range and shard that meet: fewer than MAX_RANGES + shards
    return dealt.join(F.broadcast(start), ["rng", "shard"]).select(
        "id", "grp", "size", *extra, "shard", (F.col("rn") + F.col("before")).alias("slot")
    )


def shard_texts(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, size, text_crc32, shard, slot) of every document; equal texts share a shard.

    The size is the UTF-8 length plus 8; a null text counts as empty. Only these figures are
    moved, never the texts.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        exact_hash(text_col).alias("grp"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return shard_rows(rows, shards).withColumnRenamed("grp", "text_hash")


def write_shards(docs: DataFrame, shards: int, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The whole records in one folder per shard; rows of a shard may lie in several files."""
    placed = shard_texts(docs, shards, id_col, text_col).select("id", "text_hash", "shard", "slot")
    keyed = docs.select(F.struct(*docs.columns).alias("record"), F.col(id_col).alias("id"), exact_hash(text_col).alias("text_hash"))
    numbered = placed.dropDuplicates(["id", "text_hash"])  # repeated rows go where the first of them goes
    same = keyed["id"].eqNullSafe(numbered["id"]) & (keyed["text_hash"] == numbered["text_hash"])
    joined = keyed.join(numbered, same).select("shard", "slot", "record").hint("rebalance", "shard")
    joined.write.partitionBy("shard").parquet(path)


@query("op1_sharding")
def op1_sharding(spark, sf_dir):
    placed = shard_texts(read(spark, sf_dir, "documents").select("doc_id", "text"), 24)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
