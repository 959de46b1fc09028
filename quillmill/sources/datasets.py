"""Train and validation tables from files or named tables, and streams."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillmill.operators.combine import combine_splits
from quillmill.operators.splits import percent_slice
from quillmill.sources.records import read_csv

# The file kinds a dataset may come in.
EXTENSIONS = ("csv", "json", "txt")


def _extension(path: str) -> str:
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind not in EXTENSIONS:
        raise ValueError(f"{path} is not a csv, a json or a txt file")
    return kind


def read_file(
    spark: SparkSession, path: str, keep_linebreaks: bool = True, schema: StructType | str | None = None
) -> DataFrame:
    """One file or folder, read by its extension. TXT gives one row per line."""
    kind = _extension(path)
    if kind == "txt":
        lines = spark.read.text(path)
        return lines.select(F.concat("value", F.lit("\n")).alias("text") if keep_linebreaks else F.col("value").alias("text"))
    if kind == "csv":
        return read_csv(spark, path, schema)
    return (spark.read if schema is None else spark.read.schema(schema)).json(path)


def read_dataset(
    spark: SparkSession,
    train: str | None = None,
    validation: str | None = None,
    keep_linebreaks: bool = True,
    schema: StructType | str | None = None,
) -> dict[str, DataFrame]:
    """The given files by split name; all need a known extension, the train file's rules."""
    if train is None and validation is None:
        raise ValueError("need a train or a validation file")
    files = {name: path for name, path in (("train", train), ("validation", validation)) if path is not None}
    if len({_extension(path) for path in files.values()}) > 1:
        raise ValueError("train and validation files must be of one kind")
    return {name: read_file(spark, path, keep_linebreaks, schema) for name, path in files.items()}


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A Parquet path or a catalog table."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


#: Only tables of so few pieces are dealt out, so at most this many times the size Spark reads in one.
SPREAD_PIECES = 4


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Rows of a table read in very few pieces, dealt out by ``key`` to all cores.

    A file with one row group is one task however large its texts are. A table of more than
    ``SPREAD_PIECES`` pieces is returned as it is, on any number of cores: nothing large is ever
    exchanged here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() > min(SPREAD_PIECES, 2 * cores - 1) else df.repartition(cores, *key)


def read_table_slice(
    spark: SparkSession, name: str, lo_percent: float, hi_percent: float, order: Sequence[str]
) -> DataFrame:
    """Rows from ``lo``% to ``hi``% of a table; the limits reach the scan as filters on ``order``."""
    return percent_slice(read_table(spark, name), lo_percent, hi_percent, order)


_SPLIT = re.compile(r"(?P<name>\w+)(\[(?P<lo>\d+(\.\d+)?%)?:(?P<hi>\d+(\.\d+)?%)?\])?")


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """A named split of a Parquet tree partitioned by ``split_col``, whole or as a slice: ``train[:1%]``.

    Rows are counted in stored order: by file name, then by their place in the file; limits round to
    nearest. Files' row counts come from their footers, with no column read, and fix the file and row
    at which the slice begins and ends. The scan then skips all files outside.
    """
    asked = _SPLIT.fullmatch(split.replace(" ", ""))
    if asked is None:
        raise ValueError(f"{split!r} is not a split like train, train[:1%] or train[10%:20%]")
    rows = spark.read.parquet(path).where(F.col(split_col) == asked["name"])
    lo, hi = (float(asked[end][:-1]) if asked[end] else None for end in ("lo", "hi"))
    if lo is None and hi is None:
        return rows.drop(split_col)
    sizes = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    placed = sizes.select("file", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy()).alias("all"))

    def row_at(percent: float) -> Column:
        return F.bround(F.col("all") * F.lit(percent) / F.lit(100.0)).cast("long")

    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    for percent, end in ((lo, "lo"), (hi, "hi")):
        if percent is None:
            continue
        at = row_at(percent) - F.col("start")
        cut = placed.where((at >= 0) & (at < F.col("n"))).select("file", at.alias("at")).first()
        if cut is None:  # at the end of the table
            rows = rows if end == "hi" else rows.where(F.lit(False))
        elif end == "lo":
            rows = rows.where((file >= cut.file) & ((file > cut.file) | (row >= cut.at)))
        else:
            rows = rows.where((file <= cut.file) & ((file < cut.file) | (row < cut.at)))
    return rows.drop(split_col)


def read_splits(spark: SparkSession, path: str, splits: Mapping[str, str], split_col: str = "split") -> DataFrame:
    """Several splits or slices in one table, tagged by the name they are given."""
    return combine_splits({name: read_split(spark, path, split, split_col) for name, split in splits.items()})


def stream_documents(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    kind: str = "parquet",
    glob: str | None = None,
    max_files: int = 1000,
) -> DataFrame:
    """A folder read as a stream of rows, at most ``max_files`` new files in one trigger."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if kind == "text":
        return reader.text(path).withColumnRenamed("value", "text")
    return reader.format(kind).load(path)
