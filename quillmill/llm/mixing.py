"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

A source's mean repetition rate is its target share of the output over its share of the input.
Each document draws its number of copies by inverting the Poisson distribution with that mean
at a number in [0, 1) hashed from the seed and its id, so any engine draws the same copies.
Copies go to random partitions and are put into random order there.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import materialize, read
from quillmill.llm.registry import query

#: Rates are joined by broadcast up to so many sources (a few hundred bytes each), by shuffle beyond.
BROADCAST_SOURCES = 20_000


def _draw(seed: int, *keys: Column) -> Column:
    """52 bits of an md5 as a number in [0, 1); null keys count as empty."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def _cdf(rate: Column) -> Column:
    """P(copies <= k) for k = 0, 1, ... until what is left is below 1e-16."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(
        F.array(F.exp(-rate)).alias("cdf"), (-rate).alias("logp"), F.exp(-rate).alias("c")
    )

    def step(at: Column, k: Column) -> Column:
        logp = at["logp"] + F.log(rate / k)
        c = at["c"] + F.exp(logp)
        return F.struct(F.concat(at["cdf"], F.array(c)).alias("cdf"), logp.alias("logp"), c.alias("c"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, step)["cdf"]).otherwise(F.array(F.lit(1.0)))


def repetition_rates(docs: DataFrame, weights: Mapping[str, float] | float, source_col: str = "source", size: Column | None = None) -> DataFrame:
    """(source, size, rate) per source. ``weights``: target share by source (those left out get no
    rows; shares are brought to a sum of 1), or a power: shares in proportion to size ** power.

    ``size`` is what shares are counted in (UTF-8 bytes of the text + 1 by default). The output has as
    much as the input. Null is a source of its own.
    """
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1 if size is None else size
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size.cast("bigint")).alias("size"))
    if isinstance(weights, Mapping):
        if not weights or any(w < 0 for w in weights.values()) or not sum(weights.values()):
            raise ValueError("weights must be shares of at least one source, none below 0")
        known = [F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))]
        weight = F.coalesce(F.try_element_at(F.create_map(*known), F.col("source")), F.lit(0.0))
    else:
        weight = F.pow(F.col("size").cast("double"), F.lit(float(weights)))
    sizes = sizes.withColumn("weight", weight)
    totals = sizes.agg(F.sum("size").alias("all"), F.sum("weight").alias("weights"))
    rate = F.when(F.col("weights") > 0, F.col("weight") / F.col("weights") * F.col("all") / F.col("size")).otherwise(0.0)
    return sizes.crossJoin(F.broadcast(totals)).select("source", "size", rate.alias("rate"))  # totals is one row


def replicate(docs: DataFrame, rates: DataFrame, seed: int, id_col: str = "doc_id", source_col: str = "source", copy_col: str | None = "copy") -> DataFrame:
    """Every row as often as its draw says, in random order; ``copy_col`` counts its copies from 0.

    ``rates``: (source, rate). Rows with one id (repeated rows, null ids) draw alike; a null or
    empty text is replicated like any other. All columns of ``docs`` stay as they are.
    """
    if copy_col is not None and copy_col in docs.columns:
        raise ValueError(f"docs already have a column {copy_col}")
    table = materialize(rates.select("source", _cdf(F.col("rate")).alias("cdf")), "rates")
    if table.count() <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), F.col(id_col).alias("id"), F.col(source_col).alias("of")
    )
    joined = packed.join(table, F.col("of").eqNullSafe(F.col("source")))
    u = _draw(seed, F.col("id"))
    n = F.size(F.filter("cdf", lambda c: c <= F.col("u")))
    drawn = joined.withColumn("u", u).select("record", "id", n.alias("n")).where(F.col("n") > 0)
    copies = drawn.select("record", "id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy_no"))
    order = F.xxhash64(F.lit(seed), "id", "copy_no")
    mixed = copies.withColumn("order", order).repartition("order").sortWithinPartitions("order")
    return mixed.select("record.*") if copy_col is None else mixed.select("record.*", F.col("copy_no").alias(copy_col))


#: Shares in proportion to the square root of a source's size: small sources up, the hot one down.
POWER, SEED = 0.5, 11


def mix_documents(docs: DataFrame, copy_col: str | None = "copy") -> DataFrame:
    return replicate(docs, repetition_rates(docs, POWER), SEED, copy_col=copy_col)


def mix_sql(docs: str, power: float = POWER, seed: int = SEED) -> str:
    """Common table expressions ending in mixed(doc_id, text, lang, source, n_chars, copy)."""
    return f"""
sizes AS (SELECT source, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS size FROM {docs} GROUP BY source),
weighed AS (SELECT *, pow(size::DOUBLE, {power}) AS weight FROM sizes),
rated AS (SELECT source, weight / (SELECT sum(weight) FROM weighed) * (SELECT sum(size) FROM weighed) / size AS rate FROM weighed),
terms AS (SELECT source, k, CASE WHEN k = 0 THEN exp(-rate) ELSE exp(k * ln(rate) - rate - lgamma(k + 1)) END AS p
          FROM (SELECT source, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 21)::BIGINT)) AS k FROM rated)),
cdfs AS (SELECT source, list(c ORDER BY k) AS cdf
         FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source),
drawn AS (SELECT d.*, len(list_filter(cdf, lambda c: c <= ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / {float(1 << 52)})) AS n
          FROM {docs} d JOIN cdfs ON d.source IS NOT DISTINCT FROM cdfs.source),
mixed AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(0, n))::INT AS copy FROM drawn)"""


@query("op6_mixing", f"WITH {mix_sql('documents')} SELECT * FROM mixed")
def op6_mixing(spark, sf_dir):
    return mix_documents(read(spark, sf_dir, "documents"))
