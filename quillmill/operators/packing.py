"""Fixed-length blocks: per document, or over batches of concatenated documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.columns import IGNORE_INDEX, with_ignored_pads
from quillmill.operators import ordering as o
from quillmill.operators.vocab import PAD_ID

TOKEN_COLUMNS = ("input_ids", "attention_mask")
DEFAULT_BLOCK = 2048
DEFAULT_GROUP = 1000


def block_count(n, block: int):
    """Counted blocks of a document: full ones, and a tail of at least half a block."""
    tail = n % block
    return (F.floor(n / block) + F.when((tail != 0) & (tail * 2 >= block), 1).otherwise(0)).cast("int")


def chunk_documents(
    df: DataFrame,
    block: int = DEFAULT_BLOCK,
    tail: str = "keep",
    pad_id: int = PAD_ID,
    mask_pad: int = 0,
    columns: Sequence[str] = TOKEN_COLUMNS,
    mark_count: bool = True,
) -> DataFrame:
    """Cut every document into blocks; documents never mix.

    A tail of at least half a block is padded to a full one. A shorter tail is
    emitted as it is (``tail='keep'``) or left out (``tail='drop'``). ``mask_pad``
    fills the parallel columns. With ``mark_count``, ``num_chunks`` is the block
    count on the first block of a document and -1 on the others. An empty document
    has no blocks. The plan is narrow: no exchange.
    """
    if tail not in ("keep", "drop"):
        raise ValueError(f"tail is 'keep' or 'drop', not {tail!r}")
    first = columns[0]
    carried = [c for c in df.columns if c not in columns]
    n, start = F.col("__n"), F.col("__start")
    sized = df.withColumn("__n", F.size(first))
    last = n - 1 if tail == "keep" else block_count(n, block) * block - 1
    # no starts, hence no rows, for a document without blocks
    starts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(block)))
    cut = sized.select(*carried, *columns, "__n", F.posexplode(starts).alias("chunk_idx", "__start"))
    here = F.least(n - start, F.lit(block))
    missing = F.when(here * 2 >= block, block - here).otherwise(0)
    blocks = [
        F.concat(
            F.slice(c, start + 1, F.lit(block)),
            F.array_repeat(F.lit(pad_id if c == first else mask_pad), missing),
        ).alias(c)
        for c in columns
    ]
    count = []
    if mark_count:
        count = [F.when(F.col("chunk_idx") == 0, block_count(n, block)).otherwise(-1).alias("num_chunks")]
    return cut.select(*carried, "chunk_idx", *blocks, *count)


def pack_batches(
    df: DataFrame,
    block: int,
    order: Sequence[str],
    group_size: int = DEFAULT_GROUP,
    by: Sequence[str] = (),
    columns: Sequence[str] = TOKEN_COLUMNS,
    index_col: str | None = None,
) -> DataFrame:
    """Concatenate every ``group_size`` rows in ``order``, cut, drop the remainder.

    Gives (by..., group_id, block_id, columns..., labels). ``index_col`` names a
    dense 0-based position if the table has one; otherwise it is computed from the order
    columns. Rows know the range of groups they belong to before they move, so token
    arrays are exchanged once; the regrouping of slices into blocks needs no further
    exchange, and a block gathers at most ``block`` tokens.
    """
    by = list(by)
    rows = df.select(*by, *dict.fromkeys([*order, *([index_col] if index_col else [])]), *columns)
    if index_col is None:
        rows, along = o.with_group_ranges(rows, order, by, group_size), list(order)
    else:
        first = F.floor(F.col(index_col) / group_size)
        rows, along = rows.withColumn("__range", first).withColumn("__first", first), [index_col]
    here = Window.partitionBy(*by, "__range").orderBy(*along).rowsBetween(Window.unboundedPreceding, 0)
    sized = rows.withColumn("__n", F.size(columns[0]))
    counted = sized.withColumn("__at", F.count(F.lit(1)).over(here) - 1).withColumn("__off", F.sum("__n").over(here) - F.col("__n"))
    begins = F.when(F.col("__at") % group_size == 0, F.col("__off"))
    placed = (
        counted.withColumn("__begin", F.last(begins, ignorenulls=True).over(here))
        .withColumn("group_id", (F.col("__first") + F.floor(F.col("__at") / group_size)).cast("long"))
        .withColumn("__off", F.col("__off") - F.col("__begin"))
        .where(F.col("__n") > 0)
    )
    off, n, b = F.col("__off"), F.col("__n"), F.col("block_id")
    touched = placed.withColumn(
        "block_id",
        F.explode(F.sequence(F.floor(off / block), F.floor((off + n - 1) / block))),
    )
    lo = F.greatest(b * block - off, F.lit(0))
    hi = F.least((b + 1) * block - off, n)
    pieces = touched.select(
        *by,
        "__range",
        "group_id",
        "block_id",
        F.struct(
            off.alias("off"),
            *[F.slice(c, (lo + 1).cast("int"), (hi - lo).cast("int")).alias(c) for c in columns],
        ).alias("__piece"),
    )
    cell = [*by, "__range", "group_id", "block_id"]
    gathered = pieces.groupBy(*cell).agg(F.array_sort(F.collect_list("__piece")).alias("__p"))
    joined = [F.flatten(F.col("__p")[c]).alias(c) for c in columns]
    blocks = gathered.select(*by, "group_id", "block_id", *joined).where(F.size(columns[0]) == block)
    return blocks.withColumn("labels", F.col(columns[0]))


def with_labels(df: DataFrame, pad_id: int | None = None, ignore: int = IGNORE_INDEX) -> DataFrame:
    """Add ``labels``: the ids, with padding replaced by ``ignore`` when a pad id is given."""
    ids = F.col("input_ids")
    return df.withColumn("labels", ids if pad_id is None else with_ignored_pads(ids, pad_id, ignore))
