"""A count-based language model fitted and scored with joins and aggregates.

Pairs are counted before they are shuffled, so a pair that holds a large part of
the corpus is one row per task. Every smoothed loss is a lookup of the pair and
of the total of its first token. Losses of rows send the frequent terms to the rows
and only exchange counts of the others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from quillmill.operators.tokenization import PIECE_ITEMS, map_items, pieces
from quillmill.session import materialize

PAIR = ("prev", "next")

#: Loss terms sent to the rows at most.
MAX_SHIPPED = 1_000_000
#: A code with more than 1/HEAVY of the rows is dealt to SALTS tasks.
HEAVY, SALTS = 1000, 32
#: Tokens whose pairs one task of the curriculum counts; shares of rows for each task, several so that tasks are even.
TASK_TOKENS, DEALT = 1 << 20, 64


def pairs(df: DataFrame, keep: Sequence[str] = (), ids: str = "input_ids", ignore: int | None = None) -> DataFrame:
    """One row per adjacent pair of tokens."""
    n = F.greatest(F.size(ids) - 1, F.lit(0))
    zipped = F.arrays_zip(
        F.slice(ids, F.lit(1), n).alias("prev"),
        F.slice(ids, F.lit(2), n).alias("next"),
    )
    out = df.select(*keep, F.inline(zipped))
    if ignore is not None:
        out = out.where((F.col("prev") != ignore) & (F.col("next") != ignore))
    return out


def count_pairs(df: DataFrame, by: Sequence[str] = (), ids: str = "input_ids", ignore: int | None = None) -> DataFrame:
    return pairs(df, by, ids, ignore).groupBy(*by, *PAIR).agg(F.count(F.lit(1)).alias("c"))


def fit_bigram(df: DataFrame, ids: str = "input_ids", ignore: int | None = None) -> DataFrame:
    """The model: count of every pair."""
    return count_pairs(df, (), ids, ignore)


def predict_next(model: DataFrame) -> DataFrame:
    """Most frequent next token of every token; the smaller id wins a tie."""
    best = model.groupBy("prev").agg(F.max(F.struct("c", (-F.col("next")).alias("m"))).alias("b"))
    return best.select("prev", (-F.col("b.m")).cast("int").alias("predicted"), F.col("b.c").alias("support"))


def predict_rows(df: DataFrame, model: DataFrame, ids: str = "input_ids", unknown: int = -1):
    """Add ``preds``: at every position, the predicted token after it."""
    return map_items(df, ids, predict_next(model), "prev", "predicted", unknown, "preds")


def prediction_hits(evaluated: DataFrame, model: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pairs and right predictions of a counted evaluation table (``count_pairs``)."""
    joined = evaluated.join(predict_next(model), "prev", "left")
    hit = F.when(F.col("predicted") == F.col("next"), F.col("c")).otherwise(0)
    return joined.groupBy(*by).agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n_pairs"),
        F.coalesce(F.sum(hit), F.lit(0)).alias("n_hits"),
    )


def _smoothed(c: Column, total: Column, k: float, vocab_size: int) -> Column:
    zero = F.lit(0)
    return -F.log((F.coalesce(c, zero) + F.lit(k)) / (F.coalesce(total, zero) + F.lit(k * vocab_size)))


def pair_losses(evaluated: DataFrame, model: DataFrame, k: float, vocab_size: int) -> DataFrame:
    """Loss of every distinct pair of a counted table.

    Both sides are counts, so a join key occurs at most once per shard: no pair can
    make a hot partition. The merge hint is there because the number of pairs has no
    bound and Spark's size estimate of an exploded table is far too low to decide on
    a broadcast. ``model`` is read twice; pass a materialized table.
    """
    totals = model.groupBy("prev").agg(F.sum("c").alias("total"))
    seen = model.withColumnRenamed("c", "seen").hint("merge")
    scored = evaluated.join(seen, list(PAIR), "left").join(totals, "prev", "left")
    return scored.withColumn("loss", _smoothed(F.col("seen"), F.col("total"), k, vocab_size)).drop("seen", "total")


def score_shards(
    evaluated: DataFrame, model: DataFrame, k: float, vocab_size: int, by: Sequence[str] = ()
) -> DataFrame:
    """Cross-entropy and perplexity over the pairs of every shard."""
    scored = pair_losses(evaluated, model, k, vocab_size)
    return (
        scored.groupBy(*by)
        .agg(
            F.sum("c").alias("n_pairs"),
            (F.sum(F.col("loss") * F.col("c")) / F.sum("c")).alias("mean_loss"),
        )
        .withColumn("perplexity", F.exp("mean_loss"))
    )


def adjustments(model: DataFrame, k: float, vocab_size: int) -> DataFrame:
    """(code, adj, weight): what a known pair, and a known first token, add to the loss of an unknown pair.

    -log((c + k) / (total + k V)) is log(V) plus a term for the first token's total plus a term for the
    pair's count, each 0 if it was never seen. So a row's loss is a sum of independent lookups: one
    code for the pair (prev in the high half, next + 1 in the low one), one for prev alone (low half 0).
    """
    high = F.shiftleft(F.col("prev").cast("bigint"), 32)
    seen = model.select(
        high.bitwiseOR(F.col("next").cast("bigint") + 1).alias("code"),
        (F.log(F.lit(float(k))) - F.log(F.col("c") + F.lit(float(k)))).alias("adj"),
        F.col("c").alias("weight"),
    )
    smoothing = F.lit(float(k) * vocab_size)
    totals = model.groupBy("prev").agg(F.sum("c").alias("weight"))
    return seen.unionByName(
        totals.select(high.alias("code"), (F.log(F.col("weight") + smoothing) - F.log(smoothing)).alias("adj"), "weight")
    )


def _frequent(table: DataFrame, most: int) -> tuple[int, bool]:
    """(e, rest): at most ``most`` rows weigh 2**e or more; whether there are others. At most 64 counts are read."""
    steps = table.groupBy(F.floor(F.log2("weight")).cast("int").alias("e")).agg(F.count(F.lit(1)).alias("n")).collect()
    taken, level = 0, 64
    for e, n in sorted((tuple(r) for r in steps), reverse=True):
        if taken + n > most:
            return level, True
        taken, level = taken + n, e
    return level, False


def _looked_up(df: DataFrame, key: Sequence[str], ids: str, ignore: int | None, shipped, keep_unknown: bool) -> DataFrame:
    """For every row with a pair: (key..., code null, n pairs, sum of shipped adjustments); with
    ``keep_unknown`` also (key..., code, n, null), once for each code of the row that wasn't shipped.
    """
    rows = df.select(*key, F.col(ids).cast("array<int>").alias("__ids"))
    names = [*key, "__code", "__n", "__adj"]

    def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in pieces(pc.list_value_length(batch.column("__ids")), PIECE_ITEMS):
                yield batch.slice(start, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, adj = shipped.value
        for batch in in_pieces(batches):
            lists = batch.column("__ids")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            tokens = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            here = row[1:] == row[:-1]
            if ignore is not None:
                here &= (tokens[1:] != ignore) & (tokens[:-1] != ignore)
            row, first, second = row[1:][here], tokens[:-1][here], tokens[1:][here]
            n = np.bincount(row, minlength=len(sizes))
            high = first << 32
            codes, which = np.unique(np.concatenate((high | (second + 1), high)), return_inverse=True)
            place = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
            hit = known[place] == codes if len(known) else np.zeros(len(codes), bool)
            value = np.where(hit, adj[place] if len(adj) else 0.0, 0.0)
            both = np.concatenate((row, row))
            total = np.bincount(both, weights=value[which], minlength=len(sizes))
            at = np.flatnonzero(n)
            parts = [(at, None, n[at], total[at])]
            if keep_unknown:
                open_ = ~hit[which]
                pair, count = np.unique(both[open_] * len(codes) + which[open_], return_counts=True)
                parts.append((pair // len(codes), codes[pair % len(codes)], count, None))
            for at, code, count, part in parts:
                values = [*[batch.column(c).take(pa.array(at)) for c in key]]
                values.append(pa.nulls(len(at), pa.int64()) if code is None else pa.array(code))
                values.append(pa.array(count, pa.int64()))
                values.append(pa.nulls(len(at), pa.float64()) if part is None else pa.array(part))
                yield pa.RecordBatch.from_arrays(values, names)

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in key)
    return rows.mapInArrow(run, f"{kinds}, __code bigint, __n bigint, __adj double")


def _salted_join(counts: DataFrame, table: DataFrame, key: Sequence[str]) -> DataFrame:
    """``counts`` with the adjustment of their code (0 if unknown), heavy codes split over ``SALTS`` tasks.

    A code is heavy if it has 1/HEAVY of all rows, so there are at most HEAVY of them; only their
    rows of ``table`` are repeated for the salts.
    """
    share = counts.count() / HEAVY
    heavy = counts.groupBy("__code").agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > share)
    heavy = F.broadcast(heavy.select(F.col("__code").alias("code"), F.lit(True).alias("heavy")))  # at most HEAVY rows
    salts = F.when(F.col("heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = table.select("code", "adj").join(heavy, "code", "left").select("code", "adj", F.explode(salts).alias("salt"))
    salt = F.when(F.col("heavy"), F.pmod(F.xxhash64(*key), F.lit(SALTS)).cast("int")).otherwise(0)
    salted = counts.withColumnRenamed("__code", "code").join(heavy, "code", "left").withColumn("salt", salt)
    joined = salted.join(spread.hint("merge"), ["code", "salt"], "left")
    return joined.select(*key, F.lit(0).cast("bigint").alias("__n"), (F.col("__n") * F.coalesce("adj", F.lit(0.0))).alias("__adj"))


def score_rows(
    df: DataFrame,
    model: DataFrame,
    k: float,
    vocab_size: int,
    key: Sequence[str],
    ids: str = "input_ids",
    ignore: int | None = None,
    max_shipped: int = MAX_SHIPPED,
) -> DataFrame:
    """Mean loss of every row (block, document or batch) with at least one pair; token ids are 0 or more.

    Loss terms of the most frequent pairs and first tokens (at most ``max_shipped``, 16 bytes each) are
    sent to the rows. Pairs are counted within their row, so all that is exchanged is one partial sum
    for a row, and one count for each of its distinct pairs that isn't among those; when the table holds
    every term, no pair moves. Pass a materialized ``model``, it is read four times.
    """
    key = list(key)
    table = adjustments(model, k, vocab_size)
    level, rest = _frequent(table, max_shipped)
    frequent = F.col("weight") >= F.lit(2.0**level)
    sent = table.where(frequent).select("code", "adj").toArrow()  # at most max_shipped rows
    code = sent.column("code").to_numpy()
    order = np.argsort(code)
    shipped = df.sparkSession.sparkContext.broadcast((code[order], sent.column("adj").to_numpy()[order]))
    found = _looked_up(df, key, ids, ignore, shipped, rest)
    if rest:
        found = materialize(found, "pair-counts")  # looked up once, read for the counts and for the sums
        unknown = found.where(F.col("__code").isNotNull()).drop("__adj")
        sums = found.where(F.col("__code").isNull()).drop("__code")
        found = sums.unionByName(_salted_join(unknown, table.where(~frequent), key))
    sums = found.groupBy(*key).agg(F.sum("__n").alias("n_pairs"), F.sum("__adj").alias("__adj"))
    return sums.select(*key, "n_pairs", (F.lit(math.log(vocab_size)) + F.col("__adj") / F.col("n_pairs")).alias("loss"))


def curriculum(
    df: DataFrame,
    k: float,
    vocab_size: int,
    shard: Sequence[str] = ("year", "month"),
    ids: str = "input_ids",
) -> DataFrame:
    """Train on every shard up to and including t, evaluate on the ``val`` split of t.

    One pass for all shards: the counts a model has at shard t are running sums of
    per-shard deltas, taken per pair and per first token. A pair has at most one
    row per shard in its window.

    Tasks are as many as the tokens ask for, so that none holds more than about ``TASK_TOKENS`` counts: rows
    are dealt out by their plain columns and ids before their pairs are counted, and the counts by pair after it.
    """
    shard = list(shard)
    rows = df.where(F.col("split").isin("train", "val"))
    tokens = rows.agg(F.sum(F.size(ids).cast("bigint"))).first()[0] or 0
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-tokens // TASK_TOKENS))
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    dealt = F.pmod(F.xxhash64(*plain, F.col(ids)), F.lit(tasks * DEALT))
    rows = rows.select("split", *shard, ids, dealt.alias("__share")).repartition(tasks, "__share")
    added, c = F.count_if(F.col("split") == "train").alias("added"), F.count_if(F.col("split") == "val").alias("c")
    counted = pairs(rows, ["__share", "split", *shard], ids).groupBy("__share", *shard, *PAIR).agg(added, c)
    counted = counted.repartition(tasks, *PAIR).groupBy(*shard, *PAIR).agg(F.sum("added").alias("added"), F.sum("c").alias("c"))
    until = Window.orderBy(*shard).rowsBetween(Window.unboundedPreceding, 0)
    pair_window = until.partitionBy(*PAIR)
    counted = materialize(counted.withColumn("seen", F.sum("added").over(pair_window)), "shard-pairs")  # read twice
    by_token = counted.groupBy(*shard, "prev").agg(F.sum("added").alias("added"))
    totals = by_token.select(*shard, "prev", F.sum("added").over(until.partitionBy("prev")).alias("total"))
    seen = counted.where(F.col("c") > 0).repartition(tasks, *shard, "prev")
    scored = seen.join(totals.repartition(tasks, *shard, "prev").hint("merge"), [*shard, "prev"]).withColumn(
        "loss", _smoothed(F.col("seen"), F.col("total"), k, vocab_size)
    )
    return (
        scored.groupBy(*shard)
        .agg(
            F.sum("c").alias("n_pairs"),
            (F.sum(F.col("loss") * F.col("c")) / F.sum("c")).alias("mean_loss"),
        )
        .withColumn("perplexity", F.exp("mean_loss"))
    )
