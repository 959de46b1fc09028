"""Line deduplication by a log-template tree.

A line goes down a tree of fixed depth: its number of tokens, its leading tokens, then a leaf that
generalises variable fields: tokens with digits become a wildcard, and for longer lines one quarter
of the tokens at a time may vary as well. The path is a template, known by its hash. A template that
recurs in many documents in different surroundings is boilerplate, and its lines are dropped
everywhere. Surroundings are the leading tokens of the lines before and after: copies of a document
repeat its lines in the same surroundings, so (near) copies don't make a document boilerplate.
A line that always stands beside other recurring lines is judged by what surrounds the whole run of
them: the nearest lines that don't recur, in texts that consist of such lines to a good part.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import materialize, read
from quillmill.llm.registry import query

#: Leading tokens that make a branch; tokens that a template has at least, and at least to vary a quarter.
LEADING, LEAST_TOKENS, VARYING_TOKENS = 3, 3, 8
QUARTERS = 4
#: A template is boilerplate in so many surroundings, and in this share of the different texts it is in.
LEAST_SURROUNDINGS, LEAST_SHARE = 5, 0.01
#: The surroundings of a run count in texts with this share of their tokens in lines that don't recur; near copies have less.
OWN_SHARE = 0.25
#: Tables of hashes go to all workers up to so many rows (tens of MB), else Spark joins by shuffle.
BROADCAST_ROWS = 1_000_000

_FIELD = re.compile(r"\S*\d\S*")
_LINES = (
    "id {id}, text_hash bigint, lines array<struct<line:int,before:bigint,after:bigint,templates:array<bigint>>>,"
    " shape array<struct<line:int,tokens:int,head:bigint,tail:bigint>>"
)


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def templates(tokens: list[str]) -> list[int]:
    """Hashes of the paths that a line of these (masked) tokens takes; none for a very short line."""
    n = len(tokens)
    if n < LEAST_TOKENS:
        return []
    branch = f"{n}\0" + "\0".join(tokens[:LEADING]) + "\0"
    rest = tokens[LEADING:]
    found = [_hash(branch + "\0".join(rest))]
    if n >= VARYING_TOKENS:
        edges = [len(rest) * q // QUARTERS for q in range(QUARTERS + 1)]
        parts = ["\0".join(rest[a:b]) for a, b in zip(edges, edges[1:])]
        for q in range(QUARTERS):
            found.append(_hash(f"{branch}{q}\1" + "\1".join(parts[:q] + parts[q + 1 :])))
    return found


def line_paths(text: str | None) -> tuple[list[tuple], list[tuple]]:
    """(line number, leading tokens' hash before, after, template hashes) of the lines with a template,
    and (line number, tokens, hash of the leading, of the last tokens) of all lines that aren't blank.

    A line at an edge of the text has the next but one line's instead; null where there is none.
    """
    numbered = []
    for i, line in enumerate((text or "").split("\n")):
        tokens = _FIELD.sub("<*>", line).split()
        if tokens:
            numbered.append((i, tokens))
    heads = [_hash("\0".join(tokens[:LEADING])) for _, tokens in numbered]
    last = len(heads) - 1
    out = []
    for at, (i, tokens) in enumerate(numbered):
        paths = templates(tokens)
        if paths:
            before = heads[at - 1] if at else heads[2] if last > 1 else None
            after = heads[at + 1] if at < last else heads[last - 2] if last > 1 else None
            out.append((i, before, after, paths))
    shape = [(i, len(tokens), head, _hash("\0".join(tokens[-LEADING:]))) for (i, tokens), head in zip(numbered, heads)]
    return out, shape


def around_runs(shape: list[dict], hits: list[dict]) -> list[tuple]:
    """(template, head and tail before, head and tail after) of the recurring lines ``hits`` (line, template).

    Before and after are the nearest lines of ``shape`` that don't recur; where there is none on one
    side, the next but one on the other; null where there is none either. Texts with too little of
    their own have no surroundings.
    """
    recurring = {h["line"] for h in hits}
    own = [s for s in shape if s["line"] not in recurring]
    if sum(s["tokens"] for s in own) < OWN_SHARE * sum(s["tokens"] for s in shape):
        return []
    edges = [(s["head"], s["tail"]) for s in own]
    lines, none = [s["line"] for s in own], (None, None)
    out = []
    for h in hits:
        at = bisect(lines, h["line"])
        spare = len(own) > 1
        before = edges[at - 1] if at else edges[1] if spare else none
        after = edges[at] if at < len(own) else edges[at - 2] if spare else none
        out.append((h["template"], *before, *after))
    return out


def _paths(rows: DataFrame) -> DataFrame:
    """(id, text_hash, lines, shape) of (id, text): hashes only, a few dozen bytes a line."""
    id_type = rows.schema["id"].dataType.simpleString()
    kind = pa.list_(
        pa.struct([("line", pa.int32()), ("before", pa.int64()), ("after", pa.int64()), ("templates", pa.list_(pa.int64()))])
    )

    shape_kind = pa.list_(pa.struct([("line", pa.int32()), ("tokens", pa.int32()), ("head", pa.int64()), ("tail", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_paths(text.as_py()) for text in batch.column("text")]
            lines = [[{"line": i, "before": b, "after": a, "templates": t} for i, b, a, t in paths] for paths, _ in found]
            shapes = [[dict(zip(("line", "tokens", "head", "tail"), s)) for s in shape] for _, shape in found]
            arrays = [batch.column("id"), batch.column("text_hash"), pa.array(lines, kind), pa.array(shapes, shape_kind)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "text_hash", "lines", "shape"])

    return rows.mapInArrow(run, _LINES.format(id=id_type))


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def boilerplate(paths: DataFrame) -> DataFrame:
    """(template) of those that recur in enough different surroundings; ``paths`` as ``_paths`` gives them.

    Surroundings that share the most common line before or after count as copies of one place.
    """
    each = paths.select("text_hash", F.explode("lines").alias("l")).select(
        "text_hash", "l.line", F.col("l.before").alias("before"), F.col("l.after").alias("after"), F.explode("l.templates").alias("template")
    )
    often = each.groupBy("template").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_SURROUNDINGS).select("template")
    often = materialize(often, "often")
    seen = materialize(each.join(_maybe_broadcast(often), "template").distinct(), "seen")  # equal texts count once
    places = seen.drop("line").distinct().groupBy("template", "before", "after").agg(F.count("*").alias("texts"))
    places = materialize(places, "places")

    def commonest(side: str) -> DataFrame:
        by_side = places.where(F.col(side).isNotNull()).groupBy("template", side).agg(F.sum("texts").alias("n"))
        return by_side.groupBy("template").agg(F.max(F.struct("n", side)).alias("most")).select("template", F.col(f"most.{side}").alias(f"top_{side}"))

    tops = commonest("before").join(commonest("after"), "template", "full")
    tops = materialize(tops, "tops")
    judged = places.join(_maybe_broadcast(tops), "template", "left")

    def differs(side: str) -> Column:
        return F.col(side).isNull() | (F.col(side) != F.col(f"top_{side}"))

    alone = differs("before") & differs("after") & (F.col("before").isNotNull() | F.col("after").isNotNull())
    counted = judged.groupBy("template").agg(F.sum("texts").alias("texts"), F.sum(alone.cast("int")).alias("alone"))
    enough = (F.col("alone") >= LEAST_SURROUNDINGS) & (F.col("alone") >= F.col("texts") * LEAST_SHARE)
    found = materialize(counted.where(enough).select("template"), "single")
    return found.union(_boilerplate_runs(paths, seen, found))


def _boilerplate_runs(paths: DataFrame, seen: DataFrame, found: DataFrame) -> DataFrame:
    """(template) of those not in ``found`` whose runs of recurring lines have enough different surroundings.

    ``seen`` has (text_hash, line, template). A run's surroundings differ from a copy's if neither the
    leading nor the last tokens of its neighbours are common ones beside the template.
    """
    texts = seen.select("template", "text_hash").distinct().groupBy("template").agg(F.count("*").alias("texts"))
    recurring = materialize(texts.where(F.col("texts") >= LEAST_SURROUNDINGS), "recurring")
    hits = seen.join(_maybe_broadcast(recurring.select("template")), "template")
    hits = hits.groupBy("text_hash").agg(F.collect_set(F.struct("line", "template")).alias("hits"))  # one text's lines
    hits = materialize(hits, "recurring-lines")
    shapes = paths.select("text_hash", "shape").join(_maybe_broadcast(hits.select("text_hash")), "text_hash", "left_semi")
    shaped = shapes.dropDuplicates(["text_hash"]).join(hits, "text_hash").select("text_hash", "shape", "hits")
    sides = ["head_before", "tail_before", "head_after", "tail_after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, shape, own in zip(batch.column("text_hash").to_pylist(), batch.column("shape"), batch.column("hits")):
                rows += [(text, *r) for r in around_runs(shape.as_py(), own.as_py())]
            made = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(m, pa.int64()) for m in made], ["text_hash", "template", *sides])

    kinds = ", ".join(f"{c} bigint" for c in ("text_hash", "template", *sides))
    runs = shaped.mapInArrow(run, kinds).join(_maybe_broadcast(found), "template", "left_anti")
    runs = materialize(runs.distinct(), "runs")
    side = F.explode(F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("hash")) for i, c in enumerate(sides)])).alias("x")
    beside = runs.select("text_hash", "template", side).select("text_hash", "template", "x.side", "x.hash").where("hash is not null")
    counts = beside.distinct().groupBy("template", "side", "hash").agg(F.count("*").alias("n")).where("n > 1")
    counts = counts.join(_maybe_broadcast(recurring), "template").where(F.col("n") >= F.col("texts") * LEAST_SHARE)
    # few for a template: a neighbour in LEAST_SHARE of its texts
    common = counts.groupBy("template").agg(F.collect_set(F.struct("side", "hash")).alias("common"))
    common = materialize(common, "common")
    size = common.agg(F.coalesce(F.sum(F.size("common")), F.lit(0))).first()[0]
    judged = runs.join(F.broadcast(common) if size <= BROADCAST_ROWS else common, "template", "left")

    def rare(i: int, c: str) -> Column:
        is_common = F.exists("common", lambda x: (x["side"] == i) & (x["hash"] == F.col(c)))
        return F.col(c).isNull() | F.col("common").isNull() | ~is_common

    alone = judged.where(rare(0, sides[0]) & rare(1, sides[1]) & rare(2, sides[2]) & rare(3, sides[3]))
    alone = alone.select("template", *sides).distinct().groupBy("template").agg(F.count("*").alias("alone"))
    alone = alone.where(F.col("alone") >= LEAST_SURROUNDINGS).join(recurring, "template")
    return alone.where(F.col("alone") >= F.col("texts") * LEAST_SHARE).select("template")


def drop_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text's boilerplate lines gone, as struct ``record``, with n_lines and n_dropped.

    Lines are what \\n separates. Lines without a template (blank, or fewer than LEAST_TOKENS tokens)
    always stay, and a text without boilerplate stays as it is, byte by byte; a text of boilerplate
    only becomes empty. Null texts stay null. Rows with the same id and text fare alike. Other
    columns pass through untouched, whatever their names.
    """
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), text_hash.alias("text_hash"))
    paths = materialize(_paths(rows), "line-paths")
    found = materialize(boilerplate(paths), "boilerplate")
    lines = paths.select("text_hash", F.explode("lines").alias("l")).select(
        "text_hash", F.col("l.line").alias("line"), F.explode("l.templates").alias("template")
    )
    hit = lines.join(_maybe_broadcast(found), "template").select("text_hash", "line").distinct()
    gone = materialize(hit.groupBy("text_hash").agg(F.collect_set("line").alias("gone")), "dropped-lines")  # one text's lines
    size = gone.agg(F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()[0]
    right = F.broadcast(gone) if size <= BROADCAST_ROWS else gone
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), text_hash.alias("text_hash"))
    joined = packed.join(right, "text_hash", "left")
    text = F.col("record").getField(text_col)
    split = F.split(text, "\n", -1)
    kept = F.filter(split, lambda line, i: ~F.array_contains(F.col("gone"), i))
    fresh = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    fields = []
    for c in docs.columns:
        old = F.col("record").getField(c)
        fields.append((fresh if c == text_col else old).alias(c))
    return joined.select(
        F.struct(*fields).alias("record"),
        F.size(split).alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).alias("n_dropped"),
    )


@query("op7_lines")
def op7_lines(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_boilerplate(docs).select("record.doc_id", "record.text", "n_lines", "n_dropped")
