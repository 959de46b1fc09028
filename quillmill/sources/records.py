"""CSV files whose quoted values may hold line breaks, read in byte ranges by all cores.

Whether a line break ends a record depends on all quotes before it, so a byte range can't be cut into
records by itself. It can say, though, in which state it ends for either state it may start in. These
summaries, one for each range, are composed in file order, which fixes every range's start; then the
ranges are parsed independently. What reaches over an edge is left as text by both sides and parsed
after it has been put together.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillmill.session import materialize

# File order of text records: file, then the range of it that a task reads, then the record within.
# Holds however the file is cut into tasks.
FILE_ORDER = ("__file", "__start", "__seq")

#: Bytes of records that are handed on together.
BATCH_BYTES = 4 << 20

_QUOTED = re.compile(rb'(?:[^"]|"")*')
_CARRIAGE = re.compile(rb"[^\r]*\r|[^\r]+")


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted value is open after ``line``, given whether one is before it.

    A quote opens a value only where the value begins; within one, two quotes are a character.
    """
    at = 0
    if not inside:
        if not line.startswith(b'"'):
            at = line.find(b',"') + 1
            if not at:
                return False
        at += 1
    while True:
        at = _QUOTED.match(line, at).end()
        if at >= len(line):
            return True
        at = line.find(b',"', line.find(b",", at + 1)) if b"," in line[at + 1 :] else -1
        if at < 0:
            return False
        at += 2


def _pieces(line: bytes) -> list[bytes]:
    """A line of the reader with its line break; breaks by a lone carriage return count as well."""
    if line.find(b"\r", 0, -1) < 0:
        return [line + b"\n"]
    return _CARRIAGE.findall(line + b"\n") if not line.endswith(b"\r") else [*_CARRIAGE.findall(line[:-1]), b"\r\n"]


def _step(line: bytes, inside: bool) -> bool:
    return ends_inside(line, inside) if b'"' in line else inside


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    meta = F.col("_metadata")
    return lines.select("value", meta["file_path"].alias("__file"), meta["file_block_start"].alias("__start"))


def _summaries(lines: DataFrame) -> DataFrame:
    """(__file, __start, a, b) of each range: is a value open at its end, if none or if one is at its start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, (False, True)

        def summary() -> pa.RecordBatch:
            values = [[key[0]], [key[1]], [state[0]], [state[1]]]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["__file", "__start", "a", "b"])

        for batch in batches:
            for first, upto in _same_range(batch):
                here = _key_at(batch, first)
                if here != key:
                    if key is not None:
                        yield summary()
                    key, state = here, (False, True)
                part = batch.column("value").slice(first, upto - first)
                for line in part.filter(pc.match_substring(part, '"')):
                    for piece in _pieces(line.as_buffer().to_pybytes()):
                        state = _step(piece, state[0]), _step(piece, state[1])
        if key is not None:
            yield summary()

    return lines.mapInArrow(run, "__file string, __start bigint, a boolean, b boolean")


def _key_at(batch: pa.RecordBatch, row: int) -> tuple[str, int]:
    return batch.column("__file")[row].as_py(), batch.column("__start")[row].as_py()


def _same_range(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """(first, end) of the rows of one byte range each."""
    if not batch.num_rows:
        return
    file, start = batch.column("__file"), batch.column("__start")
    changed = pc.or_(
        pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)), pc.not_equal(start.slice(1), start.slice(0, len(start) - 1))
    )
    edges = [0, *(i + 1 for i in pc.indices_nonzero(changed).to_pylist()), batch.num_rows]
    yield from zip(edges, edges[1:])


def _starts_inside(summaries: DataFrame) -> DataFrame:
    """(__file, __start) of the ranges that begin within a quoted value.

    A range either fixes its end (a = b), keeps the state or turns it around; so the state at a start
    is that of the last range that fixed it, turned as often as ranges since then turn it.
    """
    here = Window.partitionBy("__file").orderBy("__start")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    turns = summaries.withColumn("turn", (F.col("a") & ~F.col("b")).cast("int"))
    turned = turns.withColumn("turned", F.sum("turn").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    fixed = F.when(F.col("a") == F.col("b"), F.struct("a", "turned"))
    states = turned.select(
        "__file",
        "__start",
        F.last(fixed, ignorenulls=True).over(before).alias("fixed"),
        F.coalesce(F.max("turned").over(before), F.lit(0)).alias("so_far"),
    )
    odd = (F.col("so_far") - F.coalesce(F.col("fixed.turned"), F.lit(0))) % 2 == 1
    return states.where(F.coalesce(F.col("fixed.a"), F.lit(False)) != odd).select("__file", "__start")


def _parsed(lines: list[bytes]) -> list[list[str | None]]:
    """The records of whole lines; an empty value is null, a quoted empty one isn't."""
    csv.field_size_limit(sys.maxsize)
    rows = csv.reader((line.decode("utf-8", "replace") for line in lines), quoting=csv.QUOTE_NOTNULL)
    return [row for row in rows if row]


class _Out:
    """Rows of the columns, record position and loose text, gathered into Arrow batches."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.names = [*[f"c{i}" for i in range(width)], *FILE_ORDER, "closed", "text"]
        kinds = [*[pa.string()] * width, pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        self.schema = pa.schema(list(zip(self.names, kinds)))
        self.sql = ", ".join([*[f"c{i} string" for i in range(width)], "__file string, __start bigint, __seq bigint, closed boolean, text binary"])
        self.rows: list[list] = []

    def record(self, values: list[str | None], key: tuple[str, int], seq: int) -> None:
        self.rows.append([*values[: self.width], *[None] * (self.width - len(values)), *key, seq, None, None])

    def loose(self, lines: list[bytes], key: tuple[str, int], seq: int, closed: bool | None) -> None:
        self.rows.append([*[None] * self.width, *key, seq, closed, b"".join(lines)])

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(values, field.type) for values, field in zip(zip(*self.rows), self.schema)]
            self.rows = []
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _cut(lines: DataFrame, width: int) -> DataFrame:
    """Records of all ranges (text null), and the loose text at their edges.

    Text at a range's start has __seq -1 and says whether it ends the record; text at its end has the
    number that its record would have.
    """
    sql = _Out(width).sql

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(width)
        key, inside, seq, size = None, False, 0, 0
        whole: list[bytes] = []  # lines of complete records
        open_: list[bytes] = []  # of a record that isn't complete
        head = False  # those belong to a record of the range before

        def parse() -> None:
            nonlocal seq, size
            for values in _parsed(whole):
                out.record(values, key, seq)
                seq += 1
            whole.clear()
            size = 0

        def finish() -> None:
            parse()
            if open_:
                out.loose(open_, key, -1 if head else seq, False if head else None)
                open_.clear()

        for batch in batches:
            for first, upto in _same_range(batch):
                here = _key_at(batch, first)
                if here != key:
                    if key is not None:
                        finish()
                        yield from out.take()
                    key, seq = here, 0
                    inside = head = batch.column("inside")[first].as_py()
                for line in batch.column("value").slice(first, upto - first):
                    for piece in _pieces(line.as_buffer().to_pybytes()):
                        inside = _step(piece, inside)
                        open_.append(piece)
                        if inside:
                            continue
                        if head:
                            out.loose(open_, key, -1, True)
                            head = False
                        else:
                            whole += open_
                            size += sum(map(len, open_))
                        open_.clear()
                        if size >= BATCH_BYTES:
                            parse()
                            yield from out.take()
        if key is not None:
            finish()
        yield from out.take()

    return lines.mapInArrow(run, sql)


def _mended(loose: DataFrame, width: int) -> DataFrame:
    """The records that the loose text of neighbouring ranges makes up; one record is gathered in one task."""
    along = Window.partitionBy("__file").orderBy("__start", "__seq").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.when(F.col("__seq") >= 0, F.struct("__start", "__seq"))
    owned = loose.withColumn("of", F.last(begins, ignorenulls=True).over(along))
    texts = owned.groupBy("__file", "of").agg(F.array_sort(F.collect_list(F.struct("__start", "__seq", "text"))).alias("parts"))
    texts = texts.select("__file", F.col("of.__start").alias("__start"), F.col("of.__seq").alias("__seq"), F.col("parts.text").alias("parts"))
    sql = _Out(width).sql

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(width)
        for batch in batches:
            for i, parts in enumerate(batch.column("parts").to_pylist()):
                lines = b"".join(parts).splitlines(keepends=True)
                for values in _parsed(lines):
                    out.record(values, _key_at(batch, i), batch.column("__seq")[i].as_py())
            yield from out.take()

    return texts.mapInArrow(run, sql)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None, order: bool = False) -> DataFrame:
    """The records of CSV files with a header line, columns named by the first file's.

    Values are quoted by ``"``, which is doubled within them, and may hold line breaks. Records end at
    line feeds, carriage returns or both. Empty values and those that a short record lacks are null, a
    quoted empty value is an empty string, values beyond the header's are left out, blank lines are no
    records. ``schema`` names and types the columns by position (null for what doesn't fit the type);
    all are strings otherwise. With ``order``, ``FILE_ORDER`` columns give every record's place.

    Files are scanned once for the states of their ranges and parsed once, into a table in the shared
    folder, which the result reads. The broadcast has at most one row for each range of a file
    (``spark.sql.files.maxPartitionBytes``).
    """
    header = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    names = header.columns
    lines = _lines(spark, path)
    inside = _starts_inside(_summaries(lines))
    marked = lines.join(F.broadcast(inside.withColumn("inside", F.lit(True))), ["__file", "__start"], "left")
    marked = marked.select("value", "__file", "__start", F.coalesce("inside", F.lit(False)).alias("inside"))
    cut = materialize(_cut(marked, len(names)), "csv-records")
    every = cut.where(F.col("text").isNull()).unionByName(_mended(cut.where(F.col("text").isNotNull()), len(names)))
    records = every.where((F.col("__start") != 0) | (F.col("__seq") != 0))  # without the headers
    kept = [F.col(c) for c in FILE_ORDER] if order else []
    if schema is None:
        return records.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)], *kept)
    fields = schema.fields if isinstance(schema, StructType) else StructType.fromDDL(schema).fields
    typed = [(F.col(f"c{i}") if i < len(names) else F.lit(None)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]
    return records.select(*typed, *kept)
