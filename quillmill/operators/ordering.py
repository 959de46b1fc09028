"""Order-dependent operators without a single-task window.

Row positions, running aggregates and "first k rows" all need a total order over
the whole table (or over a group that may hold a large part of it). Each is
computed in two levels:

1. the order key is cut into *buckets* (key ranges of similar size) by a pure
   function of the key, so a lost executor recomputes the same buckets;
2. one small row per (group, bucket) carries the totals of everything before it.

Only the bucket rows are ever ordered in one task, and their number is bounded by
``MAX_BUCKETS`` per group; the rows themselves are sorted inside their bucket.
Order columns must be non-null and unique together (within a group).
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.session import materialize

ROWS_PER_BUCKET = 200_000
MAX_BUCKETS = 1 << 16
SAMPLES_PER_BUCKET = 16
#: Ranges of groups that rows are dealt to (for each part of the table), and limits of ranges sent to all workers, at most.
MAX_RANGES, MAX_SENT = 1 << 15, 1 << 18

BUCKET = "__bucket"

_MERGE: dict[str, Callable[[Column, Column], Column]] = {
    "sum": lambda before, here: F.coalesce(before + here, before, here),
    "count": lambda before, here: F.coalesce(before, F.lit(0)) + here,
    "min": lambda before, here: F.least(before, here),
    "max": lambda before, here: F.greatest(before, here),
}
_STEP: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "count": F.count,
    "min": F.min,
    "max": F.max,
}


def _key(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def range_bucket(
    df: DataFrame,
    order: Sequence[str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    max_buckets: int = MAX_BUCKETS,
    least: int | None = None,
) -> Column:
    """A column giving the number of the key range a row falls in.

    Range limits come from a sample of the order columns (at most about
    ``SAMPLES_PER_BUCKET * max_buckets`` keys reach the driver). They decide only
    how even the buckets are, never the result. There are at least ``least``
    buckets (one per core by default).
    """
    keys = df.select(*order)
    if any(kind == "binary" for _, kind in keys.dtypes):
        raise TypeError("order columns must not be binary")
    n = keys.count()
    least = df.sparkSession.sparkContext.defaultParallelism if least is None else least
    wanted = max(math.ceil(n / rows_per_bucket), least)
    wanted = min(wanted, max_buckets, n)
    if wanted <= 1:
        return F.lit(0)
    share = min(1.0, SAMPLES_PER_BUCKET * wanted / n)
    sample = sorted(tuple(r) for r in keys.na.drop().sample(share, seed=7).collect())
    if not sample:
        return F.lit(0)
    cuts = sorted({sample[i * len(sample) // wanted] for i in range(1, wanted)})
    if not cuts:
        return F.lit(0)
    # one JSON literal, folded to an array constant at planning time
    if len(order) == 1:
        item = keys.schema[0].dataType.simpleString()
        text = json.dumps([c[0] for c in cuts], default=str)
    else:
        item = keys.schema.simpleString()
        text = json.dumps([dict(zip(order, c)) for c in cuts], default=str)
    limits = F.sort_array(F.from_json(F.lit(text), f"array<{item}>"))
    key = _key(order)
    steps = [F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))]
    # binary search: how many limits are <= key
    return F.aggregate(
        F.array(*steps),
        F.lit(0),
        lambda found, step: F.when(F.get(limits, found + step - 1) <= key, found + step).otherwise(found),
    )


def _checked(bucket: Column, columns: Sequence[str]) -> Column:
    """The bucket of a row; a null in a key fails the job rather than losing the row."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    message = F.lit(f"null in a key column: {', '.join(columns)}")
    return F.when(missing, F.raise_error(message).cast("int")).otherwise(bucket)


def random_key(key: str, *salts: object) -> Column:
    """A repeatable random order: the md5 of the key with its seeds."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), *[F.lit(str(s)) for s in salts]))


def random_bucket(hashed: str, digits: int = 4) -> Column:
    """Buckets of an md5 order need no sample: the leading hex digits are uniform."""
    return F.conv(F.substring(F.col(hashed), 1, digits), 16, 10).cast("int")


def running(
    df: DataFrame,
    order: Sequence[str],
    aggs: Mapping[str, tuple[str, Column]],
    by: Sequence[str] = (),
    bucket: Column | None = None,
    totals: bool = False,
) -> DataFrame:
    """Add running aggregates (current row included) in ``order`` within ``by``.

    ``aggs`` maps an output name to (``sum``/``count``/``min``/``max``, column).
    With ``totals`` the whole-group value is added as ``<name>_total``.
    One exchange of the rows, on (by, bucket); a hot group is spread over buckets.
    """
    bucket = range_bucket(df, order) if bucket is None else bucket
    keyed = df.withColumn(BUCKET, _checked(bucket, [*by, *order]))
    cell = [*by, BUCKET]
    parts = keyed.groupBy(*cell).agg(*[_STEP[fn](c).alias(name) for name, (fn, c) in aggs.items()])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = []
    for name, (fn, _) in aggs.items():
        again = F.sum if fn == "count" else _STEP[fn]
        carried.append(again(name).over(before).alias(f"__before_{name}"))
        if totals:
            carried.append(again(name).over(group).alias(f"{name}_total"))
    carry = parts.select(*cell, *carried)
    inside = Window.partitionBy(*cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # names starting with "__here_" keep aggregate inputs apart from outputs of the same name
    local = keyed.select("*", *[_STEP[fn](c).over(inside).alias(f"__here_{name}") for name, (fn, c) in aggs.items()])
    # every cell has its carry; an inner join would let Spark drop null keys unseen
    out = local.join(carry, cell, "left")
    kept = [c for c in df.columns if c not in aggs]
    merged = [
        _MERGE[fn](F.col(f"__before_{name}"), F.col(f"__here_{name}")).alias(name) for name, (fn, _) in aggs.items()
    ]
    extra = [f"{name}_total" for name in aggs] if totals else []
    return out.select(*kept, *merged, *extra)


def row_index(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str = "pos",
    total: str | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Add a dense 0-based position in ``order`` within ``by`` (and the group size)."""
    out = running(df, order, {name: ("count", F.lit(1))}, by, bucket, totals=total is not None)
    out = out.withColumn(name, F.col(name) - 1)
    return out.withColumnRenamed(f"{name}_total", total) if total else out


def random_index(
    df: DataFrame, key: str, salts: Sequence[object], name: str = "pos", total: str | None = None
) -> DataFrame:
    """Add a dense position in the repeatable random order of ``key``."""
    hashed = df.withColumn("__random", random_key(key, *salts))
    out = row_index(hashed, ["__random", key], (), name, total, random_bucket("__random"))
    return out.drop("__random")


def rank_cuts(
    df: DataFrame,
    order: Sequence[str],
    cuts: Mapping[str, Callable[[Column], Column]],
    by: Sequence[str] = (),
    bucket: Column | None = None,
) -> DataFrame:
    """Per group, the order key of the first row *outside* the first k rows.

    ``cuts`` maps a name to a function from the group size to k. The result has
    ``by`` plus one key column per name; null means that all rows are inside. Only
    order columns are read, and only the buckets holding a cut are sorted, so a
    "first k rows" split costs no exchange of the table itself.
    """
    # only keys are sorted here, so one bucket will do for a small table
    bucket = range_bucket(df, order, least=1) if bucket is None else bucket
    keys = df.select(*by, *order, _checked(bucket, order).alias(BUCKET))
    cell = [*by, BUCKET]
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    sizes = keys.groupBy(*cell).agg(F.count(F.lit(1)).alias("__rows")).select(
        *cell,
        "__rows",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
        F.sum("__rows").over(group).alias("__n"),
    )
    wanted = F.array(
        *[F.struct(F.lit(name).alias("cut"), k(F.col("__n")).cast("long").alias("k")) for name, k in cuts.items()]
    )
    targets = sizes.select(
        *cell,
        F.transform(
            F.filter(
                wanted,
                lambda w: (w["k"] >= F.col("__start")) & (w["k"] < F.col("__start") + F.col("__rows")),
            ),
            lambda w: F.struct(w["cut"].alias("cut"), (w["k"] - F.col("__start")).alias("r")),
        ).alias("__targets"),
    ).where(F.size("__targets") > 0)
    inside = Window.partitionBy(*cell).orderBy(*order)
    hits = (
        keys.join(targets, cell, "inner")
        .withColumn("__r", F.row_number().over(inside) - 1)
        .select(*by, _key(order).alias("__key"), F.explode("__targets").alias("__t"), "__r")
        .where(F.col("__t.r") == F.col("__r"))
    )
    picked = [F.max(F.when(F.col("__t.cut") == name, F.col("__key"))).alias(name) for name in cuts]
    return hits.groupBy(*by).agg(*picked)


def before_cut(order: Sequence[str], cut: str) -> Column:
    return F.col(cut).isNull() | (_key(order) < F.col(cut))


def with_cuts(
    df: DataFrame,
    order: Sequence[str],
    cuts: Mapping[str, Callable[[Column], Column]],
    by: Sequence[str] = (),
    bucket: Column | None = None,
) -> DataFrame:
    """``df`` with the key columns of :func:`rank_cuts` joined on.

    The cut table is written first: its true size then decides whether the join
    is a broadcast (few groups) or a shuffled one that AQE may split.
    """
    table = rank_cuts(df, order, cuts, by, bucket)
    if by:
        return df.join(materialize(table, "cuts"), list(by), "left")
    first = table.first()
    types = {f.name: f.dataType for f in table.schema.fields}

    def literal(value: object) -> Column:
        if isinstance(value, tuple):  # a key of several columns
            return F.struct(*[F.lit(v).alias(c) for c, v in zip(order, value)])
        return F.lit(value)

    return df.select("*", *[literal(first[name]).cast(types[name]).alias(name) for name in cuts])


def with_group_ranges(rows: DataFrame, order: Sequence[str], by: Sequence[str], group_size: int) -> DataFrame:
    """``rows`` with __range and __first: key ranges of whole groups, and the number of a range's first group.

    Positions are counted on the order columns alone. The keys at which every group (every so many
    groups, when there are more than MAX_RANGES) begins are the limits by which rows find their range,
    so the other columns aren't moved for it.
    """
    places = row_index(rows.select(*by, *order), order, by, "__pos", "__size")
    per_range = F.ceil(F.col("__size") / (group_size * MAX_RANGES)).cast("long")
    begins = places.where(F.col("__pos") % (F.lit(group_size) * per_range) == 0)
    limits = begins.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct(*order))).alias("__limits"),  # at most MAX_RANGES
        F.max(per_range).alias("__per"),
    )
    key = F.struct(*order)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(MAX_RANGES.bit_length()))])
    if by:
        limits = materialize(limits, "limits")
        sent = limits.agg(F.coalesce(F.sum(F.size("__limits")), F.lit(0))).first()[0]
        marked = rows.join(F.broadcast(limits) if sent <= MAX_SENT else limits, list(by))
        found, per = F.col("__limits"), F.col("__per")
    else:
        one = limits.select(F.to_json("__limits").alias("json"), "__per").first()
        kind = limits.schema["__limits"].dataType.simpleString()
        found, per = F.from_json(F.lit(one[0] if one and one[0] else "[]"), kind), F.lit(one[1] if one and one[1] else 1)
        marked = rows
    # binary search: how many limits are <= the key
    place = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(found, n + step - 1) <= key, n + step).otherwise(n)) - 1
    return marked.withColumn("__range", place).withColumn("__first", F.col("__range") * per).drop("__limits", "__per")
