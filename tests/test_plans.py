"""The plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from quillmill.operators import batching, bigram, ordering, packing, splits
from quillmill.operators import tokenization as t
from quillmill.operators.vocab import build_vocab, with_reserved_specials
from quillmill.queries.base import table
from quillmill.sources import shards

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def ids(spark, docs):
    return t.tokenize(docs.select("doc_id", "text"), with_reserved_specials(build_vocab(docs)))


def test_text_to_blocks_is_narrow(ids):
    text = plan(packing.chunk_documents(ids, 128))
    assert "Exchange" not in text
    assert text.count("ArrowEvalPython") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_filters_do_not_repeat_the_tokenizer(ids):
    text = plan(packing.chunk_documents(ids.where(F.size("input_ids") > 5), 128).where("chunk_idx < 3"))
    assert text.count("ArrowEvalPython") == 1


def test_unused_ids_are_not_computed(ids):
    assert "ArrowEvalPython" not in plan(ids.select("doc_id"))


def test_packing_exchanges_arrays_once(ids):
    """Rows know their range of groups beforehand; slices are regrouped where they are."""
    assert plan(packing.pack_batches(ids, 128, ["doc_id"])).count("Exchange") == 1
    by_lang = plan(packing.pack_batches(ids.withColumn("half", F.col("doc_id") % 2), 128, ["doc_id"], by=["half"]))
    assert by_lang.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in by_lang
    known = ids.withColumn("pos", F.col("doc_id"))
    assert plan(packing.pack_batches(known, 128, ["doc_id"], index_col="pos")).count("Exchange") == 1


def test_only_bucket_counts_meet_in_one_task(docs):
    text = plan(ordering.row_index(docs.select("doc_id", "text"), ["doc_id"]))
    single = text.split("Exchange SinglePartition", 1)[1]
    assert "HashAggregate(keys=[__bucket" in single and "text" not in single
    text = plan(ordering.row_index(docs.select("doc_id", "lang", "text"), ["doc_id"], ["lang"]))
    assert "SinglePartition" not in text


def test_slice_reaches_the_scan(docs):
    text = plan(splits.percent_slice(docs, 10, 20, ["doc_id"]))
    assert "Exchange" not in text and "LessThan(doc_id" in text


def test_split_is_a_broadcast_of_cuts(docs):
    rows = docs.withColumn("year", F.col("doc_id") % 4).withColumn("month", F.lit(1))
    text = plan(splits.head_fraction_split(rows, {"val": 0.5, "test": 0.5}, ["doc_id"]))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text and "Window" not in text


def test_holdout_does_not_move_rows(docs):
    assert "Exchange" not in plan(splits.random_holdout(docs, 0.1, 42, "doc_id"))


def test_shard_read_prunes(spark, docs, tmp_path):
    rows = docs.select(
        "doc_id", F.lit("train").alias("split"), (F.col("doc_id") % 4).alias("year"), F.lit(1).alias("month")
    )
    shards.write_shards(rows, str(tmp_path / "s"))
    text = plan(shards.read_shard(spark, str(tmp_path / "s"), "train", 2, 1))
    assert "PartitionFilters: [" in text and "(year#" in text.split("PartitionFilters", 1)[1]


def test_first_rows_use_a_heap(docs):
    assert "TakeOrderedAndProject" in plan(splits.take_first(docs.select("doc_id"), 5, ["doc_id"]))


def test_many_first_rows_stay_where_they_are(docs):
    text = plan(splits.take_first(docs.select("doc_id", "text"), 20_000, ["doc_id"]))
    assert "Exchange" not in text and "TakeOrdered" not in text
    assert "Exchange" not in plan(splits.take_first(docs.select("doc_id"), 10**9, ["doc_id"]))


def test_pairs_are_counted_before_the_shuffle(ids):
    text = plan(bigram.fit_bigram(ids))
    assert text.index("functions=[count(1)]") < text.index("Exchange") < text.index("partial_count(1)")


def test_steps_do_not_shuffle_by_epoch(spark):
    rows = spark.range(30).select((F.col("id") % 3).alias("epoch"), F.floor(F.col("id") / 3).alias("batch_id"))
    text = plan(batching.assign_steps(rows, 4))
    assert "hashpartitioning(epoch" not in text


def test_row_losses_exchange_only_sums(spark, ids):
    """Pairs are counted and looked up inside their rows, once; what moves is a sum for each row."""
    model = bigram.fit_bigram(ids)
    text = plan(bigram.score_rows(ids, model, 0.5, 1000, ["doc_id"]))
    assert text.count("MapInArrow") == 1 and "Generate" not in text
    assert text.count("Exchange hashpartitioning(doc_id") == 1 and text.count("Exchange") == 1
    assert text.index("functions=[sum(__n") < text.index("Exchange") < text.index("partial_sum(__n") < text.index("MapInArrow")


def test_padded_batches_move_cut_ids_only(docs):
    vocab = with_reserved_specials(build_vocab(docs))
    text = plan(batching.padded_batches(docs.select("doc_id", "text"), vocab, 16, 8, ["doc_id"]))
    assert text.count("Exchange") == 1 and text.index("Exchange") < text.index("ArrowEvalPython")
    assert "text#" not in text[text.index("Exchange") :].split("\n")[1]
    assert text.index("Exchange") < text.index("slice(") < text.index("ArrowEvalPython")
