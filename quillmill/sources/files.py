"""Manifests, raw document files and bibliography CSVs."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions.columns import decode_text
from quillmill.operators import ordering as o
from quillmill.operators.combine import missing_files
from quillmill.session import materialize
from quillmill.sources.records import FILE_ORDER, read_csv

MAX_LISTED = 10_000
#: Levels of a tree whose folders are dealt out; a task walks all that lies below.
DEALT_LEVELS = 3
#: Names, and bytes of content, that a task hands on at once; files it reads.
BATCH_NAMES, BATCH_BYTES, TASK_FILES = 10_000, 4 << 20, 2_000


def _in_file_order(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__seq"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``tex``, ``year``, ``month`` of a manifest and its row number ``manifest_pos``."""
    raw = _in_file_order(spark.read.option("header", True).csv(path))
    rows = raw.select("tex", F.col("year").cast("int"), F.col("month").cast("int"), *FILE_ORDER)
    fixed = materialize(rows, "manifest")
    return o.row_index(fixed, list(FILE_ORDER), (), "manifest_pos").drop(*FILE_ORDER)


def plain_path(path: Column) -> Column:
    """A local path without its scheme; other schemes stay."""
    return F.regexp_replace(path, "^file:(//)?", "")


def local_paths(spark: SparkSession, paths: Sequence[str]) -> list[str] | None:
    """The paths without their scheme, if tasks can open them all themselves; None if one is in a store that only Spark reads."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:")
    plain = [re.sub("^file:(//)?", "", path) for path in paths]
    if all(p.startswith("/") and (default or p != path) for p, path in zip(plain, paths)):
        return [re.sub("/+", "/", p) for p in plain]
    return None


def read_documents(
    spark: SparkSession,
    manifest: DataFrame,
    path_col: str = "tex",
    root: str | None = None,
    glob: str = "*",
    max_listed: int = MAX_LISTED,
) -> DataFrame:
    """The manifest rows with the ``text`` of their file.

    Only the folders the manifest names are listed, up to ``max_listed`` of them; beyond that, the
    tree under ``root``. A file that isn't listed (it doesn't exist, ``glob`` or its hidden name keeps
    it out, or it lies outside ``root``) raises FileNotFoundError. Local files are listed and opened by
    the tasks, which get the manifest's rows dealt out; neither names nor contents are gathered or moved.
    """
    keyed = manifest.withColumn("path", plain_path(F.col(path_col)))
    folders = _some(manifest.select(F.regexp_replace(path_col, "/[^/]*$", "")).distinct(), max_listed)
    if folders == []:
        return manifest.withColumn("text", F.lit(None).cast("string"))
    if folders is None and root is None:
        raise ValueError(f"a manifest of more than {max_listed} folders needs their root folder")
    local = local_paths(spark, [root] if folders is None else [f for f in folders if f is not None])
    if local is None:
        return _read_by_spark(spark, manifest, keyed, path_col, folders, root, glob)
    _raise_missing(keyed, _listed(spark, local, glob, deep=folders is None), path_col)
    tasks = max(spark.sparkContext.defaultParallelism, -(-manifest.count() // TASK_FILES))
    read = keyed.repartition(tasks, "path").withColumn("__content", contents(F.col("path")))
    return read.select(*manifest.columns, decode_text(F.col("__content")).alias("text"))


def _raise_missing(keyed: DataFrame, exist: DataFrame, path_col: str) -> None:
    # without the hint Spark takes a listing to be as small as the table of folders, and sends it to all workers
    unseen = missing_files(keyed, exist.hint("merge")).select(path_col).take(3)
    if unseen:
        raise FileNotFoundError(f"listed in the manifest but not found: {[r[0] for r in unseen]}")


def _read_by_spark(
    spark: SparkSession, manifest: DataFrame, keyed: DataFrame, path_col: str, folders: list[str] | None, root: str | None, glob: str
) -> DataFrame:
    """Files in a store that only Spark reads: the driver holds all their names.

    Spark gives no row for a file of zero bytes, so a listed file without content is an empty text.
    Files and manifest are joined on the path: AQE broadcasts the manifest when it is small, otherwise
    the content is shuffled once.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    files = reader.option("recursiveFileLookup", True).load(root) if folders is None else reader.load(folders)
    # the reader's own listing, which also has the files of zero bytes
    listed = pa.table({"path": pa.array([unquote(f) for f in files.inputFiles()], pa.string())})
    _raise_missing(keyed, spark.createDataFrame(listed).select(plain_path(F.col("path")).alias("path")), path_col)
    texts = files.select(plain_path(F.col("path")).alias("path"), decode_text(F.col("content")).alias("text"))
    read = keyed.join(texts, "path", "left").withColumn("text", F.coalesce("text", F.lit("")))
    return read.select(*manifest.columns, "text")


def contents(path: Column) -> Column:
    """The bytes of local files, read where the rows are; a batch of large files is handed on in pieces."""

    @F.arrow_udf("binary")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for paths in batches:
            held, size = [], 0
            for name in paths.to_pylist():
                with open(name, "rb") as file:
                    held.append(file.read())
                size += len(held[-1])
                if size >= BATCH_BYTES:
                    yield pa.array(held, pa.binary())
                    held, size = [], 0
            if held:
                yield pa.array(held, pa.binary())

    return read.asNondeterministic()(path)  # or a file would be read for each use of its content


def _some(df: DataFrame, limit: int) -> list[str] | None:
    """The values of a one-column table, or None when there are more than ``limit``."""
    rows = df.limit(limit + 1).collect()
    return [r[0] for r in rows] if len(rows) <= limit else None


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Paths and sizes of the files under a folder, without those of zero bytes; no content is read.

    Tasks list local folders, and no list of names is gathered. In stores that only Spark reads the
    driver holds it.
    """
    local = local_paths(spark, [root])
    if local and os.path.isdir(local[0]):
        return _listed(spark, local, glob, deep=True).where(F.col("length") > 0)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select(plain_path(F.col("path")).alias("path"), "length")
    )


def _listed(spark: SparkSession, folders: Sequence[str], glob: str, deep: bool) -> DataFrame:
    """Paths and sizes of the files in local folders, or of all below them; hidden names are left out."""
    named = re.compile(glob_regex(glob), re.DOTALL)

    def stage(walk: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = []
            for batch in batches:
                for path, length in zip(*(column.to_pylist() for column in batch.columns)):
                    # a folder that hasn't been listed has no length
                    found = [(path, length)] if length is not None else _entries(path, named, deep, walk)
                    for row in found:
                        held.append(row)
                        if len(held) >= BATCH_NAMES:
                            yield _names(held)
                            held = []
            yield _names(held)

        return run

    tasks = 4 * spark.sparkContext.defaultParallelism
    rows = spark.createDataFrame(pa.Table.from_batches([_names([(f, None) for f in sorted({*folders})])]))
    for _ in range(DEALT_LEVELS if deep else 0):
        rows = rows.mapInArrow(stage(False), "path string, length bigint").repartition(tasks)
    return (rows if deep else rows.repartition(tasks)).mapInArrow(stage(deep), "path string, length bigint")


def _names(rows: list[tuple[str, int | None]]) -> pa.RecordBatch:
    paths, lengths = [p for p, _ in rows], [n for _, n in rows]
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], ["path", "length"])


def _entries(folder: str, named: re.Pattern, deep: bool, walk: bool) -> Iterator[tuple[str, int | None]]:
    """The files of a folder; with ``deep`` its folders too, or with ``walk`` the files below them."""
    try:
        found = os.scandir(folder)
    except (FileNotFoundError, NotADirectoryError):
        return  # files that should be there will be missed
    with found:
        for entry in found:
            # the names that Spark's readers leave out
            if entry.name.startswith(".") or entry.name.startswith("_") and "=" not in entry.name or entry.name.endswith("._COPYING_"):
                continue
            path = os.fsencode(f"{folder.rstrip('/')}/{entry.name}").decode("utf-8", "replace")
            if entry.is_dir():
                if walk:
                    yield from _entries(entry.path, named, deep, walk)
                elif deep:
                    yield path, None
            elif named.fullmatch(entry.name):
                try:
                    yield path, entry.stat().st_size
                except FileNotFoundError:
                    continue  # a link to nowhere, or a file that has gone


def glob_regex(glob: str) -> str:
    """A pattern of the readers' ``pathGlobFilter`` as a regular expression: ``* ? [ab] [^a] [!a] {a,b}`` and escapes."""
    out, group, charset, at = [], 0, False, 0
    while at < len(glob):
        c = glob[at]
        if c == "\\":
            at += 1
            if at == len(glob):
                raise ValueError(f"{glob!r} ends in an escape")
            c = re.escape(glob[at])
        elif charset:
            charset = c != "]" or glob[at - 1] == "["
            c = "^" if c == "!" and glob[at - 1] == "[" else "\\[" if c == "[" else c
        elif c == "[":
            charset = True
        elif c == "{" or c == "}" and group:
            group += 1 if c == "{" else -1
            c = "(?:" if c == "{" else ")"
        elif c == "," and group:
            c = "|"
        else:
            c = {"*": ".*", "?": "."}.get(c, re.escape(c))
        out.append(c)
        at += 1
    if group or charset:
        raise ValueError(f"{glob!r} has an open bracket")
    return "".join(out)


def read_bibliography(spark: SparkSession, path: str) -> DataFrame:
    """The ``bbl`` column as ``text``."""
    return read_csv(spark, path).select(F.col("bbl").alias("text"))


def read_bibliography_shards(spark: SparkSession, pattern: str) -> DataFrame:
    """All monthly bibliography files at once, with the shard their name gives (``..._<yymm>.csv``)."""
    yymm = F.regexp_extract("__file", r"_([0-9]{4})\.csv$", 1).cast("int")
    return (
        read_csv(spark, pattern, order=True)
        .select(F.col("bbl").alias("text"), yymm.alias("month"))
        .withColumn("year", F.floor(F.col("month") / 100).cast("int"))
    )


def read_corpus_csv(spark: SparkSession, path: str, row_percent: float | None = None) -> DataFrame:
    """A corpus in one CSV: the first ``row_percent``% of its records, without incomplete ones.

    Percentages count records, not physical lines.
    """
    if row_percent is None:
        return read_csv(spark, path).na.drop("any")
    ordered = read_csv(spark, path, order=True)
    cuts = {"__cut": lambda n: F.floor(n * F.lit(float(row_percent)) / F.lit(100.0))}
    kept = o.with_cuts(ordered, list(FILE_ORDER), cuts).where(o.before_cut(FILE_ORDER, "__cut"))
    return kept.drop(*FILE_ORDER, "__cut").na.drop("any")
