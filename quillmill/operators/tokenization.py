"""Text to token ids and back.

The vocabulary of a tokenizer is bounded by its size parameter, so it is shipped
once per executor and looked up inside an Arrow UDF: whole batches of tokens go
through one hash lookup in native code and no row is exchanged. A vocabulary
beyond ``MAX_SHIPPED`` entries goes through joins instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from quillmill.functions.columns import tokens_of
from quillmill.operators.vocab import PAD_ID, UNK_ID
from quillmill.session import materialize

MAX_SHIPPED = 1_000_000
#: Bytes of text, or elements of arrays, that a task works on at once.
PIECE_BYTES, PIECE_ITEMS = 1 << 21, 1 << 18
IDS_TYPE = "array<int>"


def _shipped(table: DataFrame, columns: Sequence[str], limit: int) -> tuple[pa.Array, pa.Array] | None:
    """Two columns as Arrow arrays, or None when there are too many rows to ship."""
    rows = table.select(*columns).limit(limit + 1).toArrow()
    if rows.num_rows > limit:
        return None
    keys, values = (pa.concat_arrays(rows[c].chunks) if rows.num_rows else pa.array([], rows[c].type) for c in columns)
    return keys, values


def pieces(sizes: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(start, rows) of runs of a batch whose sizes sum up to about ``most``; a larger row has its own."""
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + most, "right")), start + 1)
        yield start, stop - start
        start = stop


def _words(text: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Tokens of a batch as (row offsets, flat tokens)."""
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(text, ""))
    lists = pc.ascii_split_whitespace(trimmed)
    sizes = pc.if_else(pc.equal(trimmed, ""), 0, pc.list_value_length(lists))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes.cast(pa.int32()))])
    flat = lists.flatten()
    # an empty text splits into one empty token, which is not a token
    return offsets, flat.filter(pc.not_equal(flat, ""))


def tokenize(
    df: DataFrame,
    vocab: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    unk_id: int = UNK_ID,
    max_shipped: int = MAX_SHIPPED,
) -> DataFrame:
    """Replace the text column by ``input_ids`` and ``attention_mask``.

    ``keep`` names the columns to carry on (all but the text by default).
    A vocabulary of more than ``max_shipped`` entries is joined instead of shipped; the ids are the same.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c != text_col]
    small = _shipped(vocab, ("token", "id"), max_shipped)
    if small is None:
        tokens = df.select(*keep, tokens_of(F.col(text_col)).alias("__items"))
        ids = map_items_by_join(tokens, vocab.select("token", "id"), "token", "id", unk_id, "input_ids")
        return ids.select(*keep, "input_ids", _ones("input_ids"))
    shipped = df.sparkSession.sparkContext.broadcast(small)

    @F.arrow_udf(IDS_TYPE)
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, known_ids = shipped.value
        most = max(PIECE_BYTES, known.nbytes)  # every lookup hashes the vocabulary
        for text in batches:
            for start, rows in pieces(pc.binary_length(text), most):
                offsets, flat = _words(text.slice(start, rows))
                found = known_ids.take(pc.index_in(flat, value_set=known))
                yield pa.ListArray.from_arrays(offsets, pc.fill_null(found, unk_id))

    ids = df.select(*keep, _once(to_ids)(F.col(text_col)).alias("input_ids"))
    return ids.select("*", _ones("input_ids"))


def _once(udf):
    """Keep Catalyst from evaluating the UDF a second time in a pushed-down filter."""
    return udf.asNondeterministic()


def _ones(ids: str):
    return F.array_repeat(F.lit(1), F.size(ids)).alias("attention_mask")


def tokenize_with(
    df: DataFrame,
    load: Callable[[], Callable[[list[str]], list[list[int]]]],
    text_col: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Tokenize with any library: ``load`` runs once per task and returns the encoder."""
    keep = [c for c in (df.columns if keep is None else keep) if c != text_col]

    @F.arrow_udf(IDS_TYPE)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = load()
        for text in batches:
            for start, rows in pieces(pc.binary_length(text), PIECE_BYTES):
                yield pa.array(encoder(text.slice(start, rows).to_pylist()), pa.list_(pa.int32()))

    ids = df.select(*keep, _once(encode)(F.col(text_col)).alias("input_ids"))
    return ids.select("*", _ones("input_ids"))


def tokenizer_file(path_or_json: str) -> Callable[[], Callable[[list[str]], list[list[int]]]]:
    """A loader for :func:`tokenize_with` from a serialized subword tokenizer."""

    def load():
        from tokenizers import Tokenizer

        text = path_or_json
        tokenizer = Tokenizer.from_str(text) if text.lstrip().startswith("{") else Tokenizer.from_file(text)
        return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    return load


def decode(
    df: DataFrame,
    vocab: DataFrame,
    ids_col: str = "input_ids",
    out: str = "text",
    max_shipped: int = MAX_SHIPPED,
    unknown: str = "<unk>",
) -> DataFrame:
    """Add the text of an id array: the tokens joined by spaces."""
    decoded = map_items(df, ids_col, vocab, "id", "token", unknown, "__tokens", max_shipped)
    return decoded.withColumn(out, F.array_join("__tokens", " ")).drop("__tokens")


def _replaced(lists: pa.Array, keys: pa.Array, values: pa.Array, default) -> pa.Array:
    """Lists with every element replaced by the value of its key; a null list is an empty one."""
    found = values.take(pc.index_in(lists.flatten().cast(keys.type), value_set=keys))
    return pa.ListArray.from_arrays(_offsets(lists), pc.fill_null(found, default))


def _offsets(lists: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int32())
    return pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes)])


def map_items(
    df: DataFrame,
    items: str,
    table: DataFrame,
    match: str,
    value: str,
    default,
    out: str,
    max_shipped: int = MAX_SHIPPED,
) -> DataFrame:
    """Add ``out``: every element of an array column looked up in a keyed table.

    Ships the table when it has at most ``max_shipped`` rows, joins otherwise.
    """
    small = _shipped(table, (match, value), max_shipped)
    if small is None:
        renamed = df.withColumn("__items", F.col(items))
        return map_items_by_join(renamed, table.select(match, value), match, value, default, out)
    shipped = df.sparkSession.sparkContext.broadcast(small)

    @F.arrow_udf(f"array<{dict(table.dtypes)[value]}>")
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keys, values = shipped.value
        most = max(PIECE_ITEMS, len(keys))  # every lookup hashes the table
        for batch in batches:
            for start, rows in pieces(pc.list_value_length(batch), most):
                yield _replaced(batch.slice(start, rows), keys, values, default)

    return df.withColumn(out, _once(look_up)(F.col(items)))


def map_items_by_join(df: DataFrame, table: DataFrame, match: str, value: str, default, out: str) -> DataFrame:
    """Replace every element of ``__items`` through a keyed table of any size.

    Rows are written once, in blocks of about ``PIECE_ITEMS`` elements, as places in the list of their
    block's distinct elements. Only these lists are joined with the table, so an element is at most one
    row of the join for each block, however frequent. The blocks then meet what was found for them.
    """
    if df.isStreaming:
        raise ValueError("a stream needs a table that can be shipped (max_shipped)")
    kept = [c for c in df.columns if c != "__items"]
    kind = df.schema["__items"].dataType
    carried = [f for f in df.schema.fields if f.name != "__items"]
    coded = [StructField("__items", ArrayType(IntegerType())), StructField("__block", LongType()), StructField("__words", kind)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            items = batch.column("__items")
            for start, n in pieces(pc.list_value_length(items), PIECE_ITEMS):
                lists = items.slice(start, n)
                flat = lists.flatten().dictionary_encode()
                codes = pa.ListArray.from_arrays(_offsets(lists), flat.indices)
                # the first row of a block carries its distinct elements
                words = pa.ListArray.from_arrays(pa.array([0] + [len(flat.dictionary)] * n, pa.int32()), flat.dictionary)
                columns = [batch.column(c).slice(start, n) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, codes, pa.array([block] * n, pa.int64()), words], [*kept, *(f.name for f in coded)])
                block += 1

    blocks = materialize(df.select(*kept, "__items").mapInArrow(encode, StructType([*carried, *coded])), "blocks")
    words = blocks.select(F.col("__block").alias("__of"), F.posexplode("__words").alias("__code", match))
    found = words.join(table.select(match, value).hint("merge"), match).select("__of", "__code", value)
    read = [f for f in blocks.schema.fields if f.name in kept]
    made = StructType([*read, StructField(out, ArrayType(table.schema[value].dataType))])

    def replace(rows: pa.Table, known: pa.Table) -> pa.Table:
        keys, values = (known.column(c).combine_chunks() for c in ("__code", value))
        return rows.select(kept).append_column(out, _replaced(rows.column("__items").combine_chunks(), keys, values, default))

    return blocks.drop("__words").groupBy("__block").cogroup(found.groupBy("__of")).applyInArrow(replace, made)


def token_lengths(df: DataFrame, ids_col: str = "input_ids", out: str = "n_tokens") -> DataFrame:
    return df.withColumn(out, F.size(ids_col))


def pad_to_longest(
    df: DataFrame, batch_col: str | Sequence[str] = "batch_id", pad_id: int = PAD_ID, mask_pad: int = 0
) -> DataFrame:
    """Pad ids and mask to the longest row of their batch (of several columns: batches of each group)."""
    keys = [batch_col] if isinstance(batch_col, str) else list(batch_col)
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(*keys))
    return (
        df.withColumn("__longest", longest)
        .withColumn("__missing", F.col("__longest") - F.size("input_ids"))
        .withColumn("input_ids", F.concat("input_ids", F.array_repeat(F.lit(pad_id), F.col("__missing"))))
        .withColumn("attention_mask", F.concat("attention_mask", F.array_repeat(F.lit(mask_pad), F.col("__missing"))))
        .drop("__longest", "__missing")
    )


def truncate(df: DataFrame, max_length: int) -> DataFrame:
    return df.withColumn("input_ids", F.slice("input_ids", 1, max_length)).withColumn(
        "attention_mask", F.slice("attention_mask", 1, max_length)
    )


def tokenize_padded(
    df: DataFrame,
    vocab: DataFrame,
    max_length: int,
    batch_col: str = "batch_id",
    text_col: str = "text",
    pad_id: int = PAD_ID,
) -> DataFrame:
    """Tokenize with truncation, then pad each batch to its longest row."""
    return pad_to_longest(truncate(tokenize(df, vocab, text_col), max_length), batch_col, pad_id)
