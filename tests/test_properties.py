"""Properties over generated lengths, groups and keys."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmill.operators import batching as b
from quillmill.operators import ordering as o
from quillmill.operators import packing, splits
from test_golden import id_docs

few = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


@few
@given(lengths=st.lists(st.integers(0, 40), min_size=1, max_size=60), block=st.integers(1, 12))
def test_chunking_keeps_every_token(spark, lengths, block):
    docs = id_docs(spark, lengths)
    out = packing.chunk_documents(docs, block).orderBy("doc_id", "chunk_idx").collect()
    real = [t for r in out for t, keep in zip(r.input_ids, r.attention_mask) if keep]
    assert real == list(range(1, sum(lengths) + 1))
    assert all(len(r.input_ids) <= block for r in out)
    last = {r.doc_id: r.chunk_idx for r in out}
    assert all(len(r.input_ids) == block for r in out if r.chunk_idx != last[r.doc_id])
    assert len(out) == sum(-(-n // block) for n in lengths)


@few
@given(
    lengths=st.lists(st.integers(0, 30), min_size=1, max_size=60),
    block=st.integers(1, 12),
    group=st.integers(1, 20),
)
def test_packing_loses_less_than_a_block_per_group(spark, small_buckets, lengths, block, group):
    out = packing.pack_batches(id_docs(spark, lengths), block, ["doc_id"], group)
    got = [r.input_ids for r in out.orderBy("group_id", "block_id").collect()]
    expected, nxt = [], 1
    for i in range(0, len(lengths), group):
        total = sum(lengths[i : i + group])
        ids = list(range(nxt, nxt + total))
        expected += [ids[j : j + block] for j in range(0, total // block * block, block)]
        nxt += total
    assert got == expected


@pytest.mark.parametrize("order", [["k"], ["s", "k"]])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_row_index_with_a_hot_group(spark, small_buckets, order, by):
    rng = random.Random(5)
    rows = [(k, rng.choice("abc"), "hot" if rng.random() < 0.6 else str(rng.randrange(9))) for k in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, s string, g string")
    got = o.row_index(df, order, by, "pos", total="n").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r[2] if by else None, []).append(((r[1], r[0]) if order == ["s", "k"] else r[0], r[0]))
    expected = {k: (i, len(m)) for m in groups.values() for i, (_, k) in enumerate(sorted(m))}
    assert {r.k: (r.pos, r.n) for r in got} == expected


def test_running_aggregates(spark, small_buckets):
    rng = random.Random(6)
    rows = [(k, rng.randrange(-50, 50), rng.choice(["a", "a", "b"])) for k in range(200)]
    df = spark.createDataFrame(rows, "k long, v long, g string")
    v = F.col("v")
    out = o.running(df, ["k"], {"s": ("sum", v), "lo": ("min", v), "hi": ("max", v), "c": ("count", v)}, ["g"])
    state = {}
    for r in out.orderBy("k").collect():
        seen = state.setdefault(r.g, [])
        seen.append(r.v)
        assert (r.s, r.lo, r.hi, r.c) == (sum(seen), min(seen), max(seen), len(seen))


@pytest.mark.parametrize("n, percent", [(10, 5), (30, 5), (50, 5), (7, 33), (1, 50), (3, 100)])
def test_percent_split_rounds_to_nearest(spark, small_buckets, n, percent):
    out = splits.percent_split(spark.range(n), percent, ["id"])
    held = sorted(r.id for r in out.where("split = 'validation'").collect())
    assert held == list(range(int(round(n * percent / 100.0)))) and out.count() == n


def test_two_column_slice(spark, small_buckets):
    df = spark.range(90).select((F.col("id") % 3).alias("a"), "id")
    out = splits.percent_slice(df, 10, 60, ["a", "id"])
    everything = sorted((i % 3, i) for i in range(90))
    assert sorted(tuple(r) for r in out.collect()) == everything[9:54]


def test_holdout_is_exact_and_repeatable(spark):
    df = spark.range(205)
    first = splits.random_holdout(df, 0.1, 42, "id").where("split = 'eval'")
    again = splits.random_holdout(df.repartition(3), 0.1, 42, "id").where("split = 'eval'")
    assert first.count() == 20
    assert {r.id for r in first.collect()} == {r.id for r in again.collect()}
    assert {r.id for r in first.collect()} != {
        r.id for r in splits.random_holdout(df, 0.1, 43, "id").where("split = 'eval'").collect()
    }


def test_batches_partition_the_table(spark, small_buckets):
    df = spark.range(103)
    for out in (b.assign_batches(df, 10, ["id"]), b.shuffle_batches(df, 10, 1, 0, "id")):
        rows = out.collect()
        assert sorted(r.id for r in rows) == list(range(103))
        places = {(r.batch_id, r.pos_in_batch) for r in rows}
        assert places == {(i // 10, i % 10) for i in range(103)}
    assert b.assign_batches(df, 10, ["id"], drop_last=True).count() == 100


@pytest.mark.parametrize("n, world, size", [(10, 3, 2), (12, 3, 2), (7, 4, 1), (100, 7, 8)])
def test_contiguous_ranks(spark, small_buckets, n, world, size):
    out = b.shard_for_ranks(spark.range(n), world, "contiguous", size, ["id"]).collect()
    share = -(-n // (world * size)) * size
    expected = {(r, i): (r * share + i) % n for r in range(world) for i in range(share)} if n else {}
    assert {(r.rank, r.pos_in_rank): r.id for r in out} == expected


def test_length_groups_fall_within_a_megabatch(spark):
    df = spark.range(95).select("id", (F.col("id") * 37 % 19).alias("len"))
    grouped = b.length_grouped_batches(df, 4, 1, "id", "len", mega=5, longest_first=False)
    rows = grouped.orderBy("batch_id", "pos_in_batch").collect()
    for mega in range(5):
        lens = [r.len for r in rows if r.mega_id == mega]
        assert lens == sorted(lens, reverse=True)
    assert [(r.batch_id, r.pos_in_batch) for r in rows] == [(i // 4, i % 4) for i in range(95)]
    moved = b.length_grouped_batches(df, 4, 1, "id", "len", mega=5).orderBy("batch_id", "pos_in_batch").collect()
    longest = next(i for i in range(0, 95, 20) if rows[i].len == max(r.len for r in rows))
    order = [r.id for r in rows]
    order[0], order[longest] = order[longest], order[0]
    assert [r.id for r in moved] == order


def test_validation_is_carved_out_only_when_missing(spark, small_buckets):
    from quillmill.plans.evaluation import train_and_validation

    train, held = spark.range(40), spark.range(100, 103)
    given = train_and_validation({"train": train, "validation": held}, 5, ["id"])
    assert {(r.split, r["count"]) for r in given.groupBy("split").count().collect()} == {("train", 40), ("validation", 3)}
    carved = train_and_validation({"train": train}, 5, ["id"]).where("split = 'validation'")
    assert sorted(r.id for r in carved.collect()) == [0, 1]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double", "decimal(12,3)", "string"])
def test_order_keys_of_every_type(spark, small_buckets, kind):
    rng = random.Random(11)
    keys = rng.sample(range(-5000, 5000), 120)
    k = F.col("k")
    typed = {
        "timestamp": F.timestamp_micros(F.lit(10**15) + k * 1_234_567),
        "timestamp_ntz": F.timestamp_micros(F.lit(10**15) + k * 1_234_567).cast("timestamp_ntz"),
        "date": F.date_add(F.lit("2024-01-01").cast("date"), k.cast("int")),
        "double": k / 7,
        "decimal(12,3)": (k / 8).cast("decimal(12,3)"),
        "string": F.concat(F.element_at(F.array(*map(F.lit, ['"', "\\", "é", "𝄞", "z", " "])), F.pmod(k, F.lit(6)).cast("int") + 1), k.cast("string")),
    }
    df = spark.createDataFrame([(i,) for i in keys], "k long").select("k", typed[kind].alias("o"))
    got = {r.k: r.pos for r in o.row_index(df, ["o"]).collect()}
    expected = {r.k: i for i, r in enumerate(df.orderBy("o").collect())}
    assert got == expected
    pairs = {r.k: r.pos for r in o.row_index(df.withColumn("h", k % 3), ["h", "o"]).collect()}
    assert pairs == {r.k: i for i, r in enumerate(df.withColumn("h", k % 3).orderBy("h", "o").collect())}


@pytest.mark.parametrize("broken", [(None, "a"), (5, None)])
def test_null_keys_are_not_lost(spark, small_buckets, broken):
    df = spark.createDataFrame([*[(i, "a") for i in range(30) if i != 5], broken], "k long, g string")
    with pytest.raises(Exception, match="null in a key column"):
        o.row_index(df, ["k"], ["g"]).collect()


def test_rows_without_a_shard_are_in_no_split(spark, small_buckets):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else 0, 1) for i in range(40)], "id long, year int, month int")
    out = splits.head_fraction_split(df, {"val": 1.0}, ["id"]).collect()
    assert len(out) == 32 and all(r.year == 0 for r in out)
    rest = splits.head_fraction_split(df, {"val": 1.0}, ["id"], rest="unused").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in rest} == {"val": 32, "unused": 8}
