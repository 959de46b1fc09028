"""Order MinHash over short pieces of text, with DataFrame functions only.

A text is cut into pieces: its words, those over ``LONG`` characters in parts of ``PIECE``. A
k-mer is two pieces in a row (the last piece also counts alone). k-mers are numbered by
occurrence, so repeats count. Each (k-mer, occurrence) pair falls by hash into one of ``BINS``
bins; a bin keeps its two smallest pairs, puts them back in text order and hashes the tuple.
Two texts' likeness is the share of equal bins among those that either fills: it estimates how
much they share in the same order, as edit distance does.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm.common import read
from quillmill.llm.registry import query
from quillmill.operators.ordering import range_bucket

LONG, PIECE, BINS = 32, 8, 64

#: A long holds a 40-bit hash and a 24-bit place, so sorting longs sorts by hash, then place.
_PLACE = 24
#: Whole text per range of documents, about, and ranges at most.
BYTES_PER_RANGE = 4 << 20
MAX_RANGES = 1 << 16


_BLANK = " \t\n\x0b\x0c\r"


def with_fingerprint(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with the array<bigint> ``out``: for every bin that isn't empty, bin * 2**32 + hash, ascending.

    Needs no shuffle. A blank or null text has no bins. Each select names an array once, so that
    no step is evaluated again for every element.
    """
    b, c = f"__{out}_b", f"__{out}_c"
    kept = list(df.columns)
    mask = (1 << _PLACE) - 1

    def high(x: Column) -> Column:
        return F.shiftright(x, _PLACE)

    words = F.split(F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(_BLANK)), r"[\x20\x09-\x0D]+")
    df = df.select(*kept, words.alias(b))
    cut = F.flatten(
        F.transform(b, lambda w: F.when(F.octet_length(w) <= LONG, F.array(w)).otherwise(F.regexp_extract_all(w, F.lit(rf"(?s).{{1,{PIECE}}}"), 0)))
    )
    pieces = (
        F.when(F.get(b, F.lit(0)) == "", F.array().cast("array<string>"))
        .when(F.exists(b, lambda w: F.octet_length(w) > LONG), cut)
        .otherwise(F.col(b))
    )
    df = df.select(*kept, pieces.alias(c))
    p = F.col(c)
    # [k-mer | place], sorted: equal k-mers lie side by side in text order
    packed = F.transform(
        p, lambda x, i: F.shiftleft(high(F.xxhash64(x, F.get(p, i + 1))), _PLACE).bitwiseOR(i.cast("bigint"))
    )
    df = df.select(*kept, F.sort_array(packed).alias(b))
    s = F.col(b)

    def before(i: Column, n: int) -> Column:
        return high(F.get(s, i - n))

    def run_start(x: Column, i: Column) -> Column:
        """Where the run of equal k-mers begins, by binary search among the elements before i."""
        span = F.struct(F.lit(0).alias("lo"), i.alias("hi"))

        def halve(at: Column, _: Column) -> Column:
            mid = F.shiftright(at["lo"] + at["hi"], 1)
            less = (at["lo"] < at["hi"]) & (high(F.get(s, mid)) < high(x))
            return F.struct(
                F.when(less, mid + 1).otherwise(at["lo"]).alias("lo"), F.when(less, at["hi"]).otherwise(mid).alias("hi")
            )

        return F.aggregate(F.sequence(F.lit(1), F.lit(_PLACE)), span, halve)["lo"]

    def number(x: Column, i: Column) -> Column:
        return (
            F.when((i < 1) | (before(i, 1) != high(x)), F.lit(0))
            .when((i < 2) | (before(i, 2) != high(x)), F.lit(1))
            .otherwise(i - run_start(x, i))
        )

    # [hash of (k-mer, occurrence) | place], sorted; the bin is the hash's leading bits
    pairs = F.transform(
        s,
        lambda x, i: F.shiftleft(high(F.xxhash64(high(x), number(x, i))), _PLACE).bitwiseOR(x.bitwiseAND(F.lit(mask))),
    )
    df = df.select(*kept, F.sort_array(pairs).alias(c))
    shift = 64 - int(math.log2(BINS))
    s2 = F.col(c)

    def bin_of(x: Column) -> Column:
        return F.shiftrightunsigned(x, shift)

    firsts = F.filter(
        F.sequence(F.lit(0), F.size(s2) - 1), lambda i: (i < 1) | (bin_of(F.get(s2, i - 1)) != bin_of(F.get(s2, i)))
    )

    def tuple_hash(i: Column) -> Column:
        one, two = F.get(s2, i), F.get(s2, i + 1)
        ahead = one.bitwiseAND(F.lit(mask)) < two.bitwiseAND(F.lit(mask))
        hashed = (
            F.when(F.coalesce(bin_of(one) != bin_of(two), F.lit(True)), F.xxhash64(high(one)))
            .when(ahead, F.xxhash64(high(one), high(two)))
            .otherwise(F.xxhash64(high(two), high(one)))
        )
        return F.shiftleft(bin_of(one), 32).bitwiseOR(F.shiftrightunsigned(hashed, 32))

    none = F.array().cast("array<bigint>")
    return df.select(*kept, F.when(F.size(s2) > 0, F.sort_array(F.transform(firsts, tuple_hash))).otherwise(none).alias(out))


def likeness(one: str, other: str) -> Column:
    """Share of equal bins among those filled in either; 1.0 for two texts without pieces."""

    def bins(c: str) -> Column:
        return F.transform(c, lambda x: F.shiftright(x, 32))

    filled = F.size(F.array_union(bins(one), bins(other)))
    return F.when(filled > 0, F.size(F.array_intersect(one, other)) / filled).otherwise(F.lit(1.0))


def as_text(fingerprint: str) -> Column:
    """Ten hex digits for each bin that is filled."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 10, "0")), "")


def with_next(rows: DataFrame) -> DataFrame:
    """Rows of (id, text) dealt by ranges of id, each range ending with a copy of the next range's first row.

    Adds rng and ghost (true for those copies), so that a window over (rng) ordered by (ghost,
    id, text) sees every row's follower; the last row's is the first of all. Only the first id of
    each range goes through the driver. Null ids sort first; equal ids by text.
    """
    size, n = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    spark = rows.sparkSession
    least = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(1, min(max(math.ceil(size / BYTES_PER_RANGE), least), MAX_RANGES, n))
    per_range = max(1, math.ceil(n / wanted))
    rng = range_bucket(rows, ["id"], rows_per_bucket=per_range, max_buckets=MAX_RANGES, least=1)
    rng = F.when(F.col("id").isNull(), F.lit(-1)).otherwise(rng)
    dealt = rows.withColumn("rng", rng)
    firsts = sorted(dealt.groupBy("rng").agg(F.min("id").alias("id")).collect())
    follows = {r.rng: firsts[i - 1].rng for i, r in enumerate(firsts)}
    # the rows with a range's first id also go to the range before (the first range's to the last)
    here = spark.createDataFrame([(r.rng, r.id, follows[r.rng]) for r in firsts], f"rng int, first {rows.schema['id'].dataType.simpleString()}, prior int")
    marked = dealt.join(F.broadcast(here), "rng", "left")  # at most MAX_RANGES small rows
    own = F.struct(F.col("rng").alias("rng"), F.lit(False).alias("ghost"))
    copy = F.struct(F.col("prior").alias("rng"), F.lit(True).alias("ghost"))
    to = F.when(F.col("id").eqNullSafe(F.col("first")), F.array(own, copy)).otherwise(F.array(own))
    return marked.select("id", "text", F.explode(to).alias("to")).select("id", "text", "to.rng", "to.ghost")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has the last quarter of the code points (rounded down) replaced by the first
    as many of the next document in id order, or by all of it if it is shorter. Null texts are
    empty; texts without pieces have only empty bins, and two such are alike. Repeated rows stay;
    other columns aren't read; no rows give no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    along = Window.partitionBy("rng").orderBy("ghost", "id", "text")
    df = with_next(rows).withColumn("after", F.lead("text").over(along))
    df = df.withColumn("n_chars", F.char_length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 4) as int))"),
        F.col("after").substr(F.lit(1), quarter),
    )
    df = df.select("id", "rng", "ghost", "n_chars", "text", F.coalesce(edited, F.lit("")).alias("edited"))
    df = df.withColumn("edited_sha256", F.sha2(F.col("edited"), 256))
    df = with_fingerprint(with_fingerprint(df, "text", "own"), "edited", "changed")
    df = df.select("id", "rng", "ghost", "n_chars", "edited_sha256", "own", "changed", "text")
    df = df.withColumn("following", F.lead("own").over(along)).where(~F.col("ghost"))
    return df.select(
        "id",
        "n_chars",
        "edited_sha256",
        as_text("own").alias("fingerprint"),
        as_text("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "following").alias("near_next"),
    )


@query("op4_fingerprints")
def op4_fingerprints(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return edited_fingerprints(docs).withColumnRenamed("id", "doc_id")
