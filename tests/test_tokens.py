"""Vocabulary and tokenizers."""

import pytest
from pyspark.sql import functions as F

from quillmill.operators import tokenization as t
from quillmill.operators import vocab as v


@pytest.fixture()
def docs(spark):
    rows = [(0, "b a a  c\n"), (1, ""), (2, " a b "), (3, None), (4, "\t\n"), (5, "z <pad> a")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_vocabulary_order(docs):
    got = v.build_vocab(docs, size=3).orderBy("id").collect()
    assert [(r.token, r.id, r.n) for r in got] == [("a", 7, 4), ("b", 8, 2), ("c", 9, 1)]


@pytest.mark.parametrize("max_shipped", [100, 0])
def test_tokenize_and_decode(docs, max_shipped):
    vocab = v.with_reserved_specials(v.build_vocab(docs, size=3))
    ids = t.tokenize(docs, vocab, max_shipped=max_shipped)
    got = {r.doc_id: (r.input_ids, r.attention_mask) for r in ids.collect()}
    assert got == {
        0: ([8, 7, 7, 9], [1] * 4), 1: ([], []), 2: ([7, 8], [1] * 2),
        3: ([], []), 4: ([], []), 5: ([4, 0, 7], [1] * 3),
    }
    text = {r.doc_id: r.text for r in t.decode(ids, vocab, max_shipped=max_shipped).collect()}
    assert text == {0: "b a a c", 1: "", 2: "a b", 3: "", 4: "", 5: "<unk> <pad> a"}


def test_special_tokens_keep_ids(spark):
    have = spark.createDataFrame([("x", 0), ("<unk>", 5), ("y", 6)], "token string, id int")
    got = {r.token: r.id for r in v.with_special_tokens(have).collect()}
    assert got == {"x": 0, "<unk>": 5, "y": 6, "<pad>": 7, "<cls>": 8, "<sep>": 9, "<mask>": 10, "<bos>": 11, "<eos>": 12}
    empty = {r.token: r.id for r in v.with_special_tokens(have.limit(0)).collect()}
    assert empty == {token: i for i, token in enumerate(v.SPECIAL_TOKENS)}


def test_subword_tokenizer(spark, docs):
    tokenizers = pytest.importorskip("tokenizers")
    model = tokenizers.models.WordPiece({"[UNK]": 0, "a": 1, "b": 2, "##b": 3}, unk_token="[UNK]")
    tokenizer = tokenizers.Tokenizer(model)
    tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    rows = spark.createDataFrame([(0, "ab b"), (1, "")], "doc_id long, text string")
    ids = t.tokenize_with(rows, t.tokenizer_file(tokenizer.to_str()))
    assert {r.doc_id: r.input_ids for r in ids.collect()} == {0: [1, 3, 2], 1: []}


def test_padding(spark, docs):
    vocab = v.with_reserved_specials(v.build_vocab(docs, size=3))
    out = t.tokenize_padded(docs.withColumn("batch_id", F.lit(0)), vocab, max_length=3).collect()
    assert {len(r.input_ids) for r in out} == {3}
    assert {r.doc_id: sum(r.attention_mask) for r in out} == {0: 3, 1: 0, 2: 2, 3: 0, 4: 0, 5: 3}


def test_batches_of_each_split_stay_apart(spark):
    from pyspark.sql import functions as F

    from quillmill.operators import batching, stats

    rows = [("train", 1, [1, 2, 3]), ("train", 2, [4]), ("train", 3, [5]), ("val", 4, [6, 7])]
    df = spark.createDataFrame(rows, "split string, id long, input_ids array<int>")
    df = df.withColumn("attention_mask", F.transform("input_ids", lambda x: F.lit(1)))
    batched = batching.assign_batches(df, 2, ["id"], by=["split"])
    got = {(r.split, r.batch_id): r.input_ids for r in batching.collate(batched, 0, by=["split"]).collect()}
    assert got == {("train", 0): [[1, 2, 3], [4, 0, 0]], ("train", 1): [[5]], ("val", 0): [[6, 7]]}
    assert stats.num_examples(batched, 2, by=["split"]).first()[0] == 6
    assert stats.num_tokens(batched, padded=True, by=["split"]).first()[0] == 9
    steps = {r.split: r.num_tokens for r in stats.num_tokens(batched, 10, padded=True, by=["split"]).collect()}
    assert steps == {"train": 60, "val": 20}


def test_report_counts_papers_without_tokens(spark):
    from quillmill.plans.corpus import shard_report

    rows = [("a", list(range(9))), ("a", []), ("a", [1]), ("b", [])]
    df = spark.createDataFrame(rows, "split string, input_ids array<int>")
    got = {r[0]: tuple(r)[1:] for r in shard_report(df, 4, ["split"]).collect()}
    assert got == {"a": (3, 10, 4, 2, 2), "b": (1, 0, 0, 0, 0)}
    dropped = {r[0]: tuple(r)[1:] for r in shard_report(df, 4, ["split"], "drop").collect()}
    assert dropped["a"] == (3, 10, 2, 2, 0)


def test_one_result_on_both_sides_of_the_limit(spark):
    """Repeated, null and missing keys, shipped or joined."""
    rows = [(1, "a b"), (1, "c a"), (None, "a b"), (None, "b"), (2, None), (2, "zz c")]
    keyed = spark.createDataFrame(rows, "doc_id long, text string")
    vocab = v.with_reserved_specials(v.build_vocab(keyed.where("doc_id = 1"), size=5))
    for df in (keyed, keyed.select("text"), keyed.withColumnRenamed("doc_id", "other")):
        shipped, joined = (
            sorted(map(str, t.decode(t.tokenize(df, vocab, max_shipped=n), vocab, max_shipped=n).collect())) for n in (100, 0)
        )
        assert shipped == joined and len(joined) == len(rows)


def test_batches_are_worked_on_in_pieces(spark):
    import pyarrow as pa

    sizes = pa.array([3, None, 4, 50, 0, 1, 9, 1], pa.int32())
    assert list(t.pieces(sizes, 10)) == [(0, 3), (3, 1), (4, 3), (7, 1)]
    assert list(t.pieces(pa.array([], pa.int32()), 10)) == []
    long = "a b " * (t.PIECE_BYTES // 3)
    rows = [(0, long), (1, None), (2, "b"), (3, long + "c"), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    vocab = spark.createDataFrame([("a", 10), ("b", 11)], "token string, id int")
    ids = t.tokenize(df, vocab)
    got = {r.doc_id: r.input_ids for r in ids.collect()}
    many = [10, 11] * (t.PIECE_BYTES // 3)
    assert got == {0: many, 1: [], 2: [11], 3: [*many, t.UNK_ID], 4: []}
    text = {r.doc_id: r.text for r in t.decode(ids, vocab, unknown="?").collect()}
    assert text == {0: long.strip(), 1: "", 2: "b", 3: long + "?", 4: ""}


def test_joined_blocks_exchange_an_element_once(spark):
    """Rows of all lengths fall into blocks, and the frequent element is one row of the join for each of these."""
    rows = [(i, "x " * (1 << (i % 12)) + f"w{i}") for i in range(600)] + [(600, None), (601, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    vocab = spark.createDataFrame([("x", 1), *((f"w{i}", i + 7) for i in range(0, 600, 2))], "token string, id int")
    ids = t.tokenize(df, vocab, max_shipped=0)
    got = {r.doc_id: r.input_ids for r in ids.collect()}
    expected = {i: [1] * (1 << (i % 12)) + [i + 7 if i % 2 == 0 else t.UNK_ID] for i in range(600)}
    assert got == expected | {600: [], 601: []}
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "CoGroups" in plan and "collect_list" not in plan
