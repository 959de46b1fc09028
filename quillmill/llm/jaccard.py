"""Exact similarity join of shingle sets under Jaccard distance, region by region.

Jaccard distance is a metric, so documents can be dealt to the regions of pivots, and the triangle
inequality says which documents of a region can have a partner in another and must be copied there.
Among documents that have nothing in common all distances are 1, though, and no pivot tells them
apart; so the outermost level splits the space by what partners must share:

0. Under one order of all shingles (those known as frequent last) the first size - ceil(t * size) + 1
   shingles of two partners have one in common, for the threshold t. A region is a shingle, and a set is
   copied into those of its first shingles. Any order is exact; frequencies come from a sample and only
   keep regions small.
1. A region's first set is its pivot. Each set has a sketch, one byte for each part of its shingles; how
   many bytes differ is a metric too, and never more than the symmetric difference. Distances to the
   pivot that sizes and sketches leave possible are computed exactly; regions whose sets are all
   connected by now are done.
2. Larger regions choose new pivots, the sets nearest to what most sketches of a region say, are measured
   and connected again, for as long as that connects sets.
3. Of what is left, regions of a bounded size compare sets of different components. The sets of larger
   ones form the crowd. Pivots drawn from it make Voronoi regions in the sketches' metric: a set goes to its nearest
   pivot's region and to all that are at most twice the allowed difference further, so that partners
   meet. Regions are compared in blocks, sketch by sketch, and what the sketches can't tell apart is
   measured exactly.

Every pair that is linked ends up connected; distances are always those of the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm.common import exact_hash, materialize, read, small_batches
from quillmill.llm.registry import query

#: One of so many texts tells which shingles are frequent; the order of shingles knows the first FREQUENT of them (16 MB).
SAMPLE, FREQUENT = 8, 1 << 20
#: Rounds of new pivots for large regions.
ROUNDS = 2
#: Regions beyond this many sets get new pivots first; up to DIRECT sets they then compare all that aren't connected yet.
SMALL, DIRECT = 48, 1024
#: Bytes of a sketch of a crowd, shingles for each byte of a set's own sketch.
SKETCH, PER_BYTE = 128, 3
#: Parts of a set's own sketch at least, by which pairs of small regions are compared first; how many pairs at a time.
PARTS, PAIRS = 256, 1 << 16
#: Sketches of a region that one task counts.
TALLIED = 4096
#: Sets of a crowd for each pivot, pivots at most, and sets per block of a region.
PER_PIVOT, MAX_PIVOTS, BLOCK = 256, 1024, 512
#: Pairs of a pivot that share one copy of its text.
CHUNK = 64
#: Ids of candidates are sent to all workers up to so many (tens of MB), joined by shuffle beyond.
BROADCAST_ROWS = 1_000_000
#: What a Python worker remembers: hashes of words (about 180 bytes each, for as long as it lives), and nodes or texts of a task.
KNOWN_WORDS, SEEN = 1 << 16, 1 << 18
#: Rows with whole texts that a Python worker gets at a time.
TEXTS = 1024

_known: dict[bytes, int] = {}
_P = (np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P[1]
    h = (h ^ (h >> np.uint64(29))) * _P[2]
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; a shorter text is one shingle, a blank one none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_known) > KNOWN_WORDS:
        _known.clear()
    ids = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = _known.get(w)
        if h is None:
            h = _known[w] = xxhash.xxh3_64_intdigest(w)
        ids[i] = h
    with np.errstate(over="ignore"):
        n = max(len(words) - k + 1, 1)
        width = min(k, len(words))
        h = _mix(ids[:n] + np.uint64(width))
        for j in range(1, width):
            h = _mix(h * _P[0] + ids[j : j + n])
    return np.unique(h)


def region_keys(elements: np.ndarray, num: int, den: int, frequent: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """The regions of a set (sorted) at level 0 for the threshold num / den: its first shingles in the order.

    ``frequent``: sorted shingles and their counts; these come after all others, by count.
    """
    size = len(elements)
    first = size - -(-num * size // den) + 1
    if frequent is None or not len(frequent[0]):
        return elements[:first]
    known, counts = frequent
    at = np.minimum(np.searchsorted(known, elements), len(known) - 1)
    often = np.where(known[at] == elements, counts[at], 0)
    return elements[np.lexsort((elements, often))[:first]]


def frequent_shingles(rows: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, counts) of the shingles that more than one of the sampled texts (text) have, sorted; at most FREQUENT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            if len(seen) > SEEN:
                seen.clear()
            texts = {xxhash.xxh3_128_digest(t or ""): t for t in batch.column("text").to_pylist()}
            sets = [shingles(t, k) for h, t in texts.items() if h not in seen]
            seen.update(texts)
            if sets:
                made, n = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(made.view(np.int64)), pa.array(n, pa.int64())], ["shingle", "n"])

    sampled = rows.select("text").where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    counted = sampled.mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1")
    with small_batches(rows.sparkSession, TEXTS):
        top = counted.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()
    known, n = top.column("shingle").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(known)
    return known[order], n[order]


def _text_hash(text: str) -> Column:
    """The same for equal texts, whatever type they had; computed without Python, so that rows needn't pass through it again."""
    return exact_hash(F.col(text).cast("string"))


def set_hash(elements: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63)


def sketch_of(elements: np.ndarray, width: int = SKETCH) -> bytes:
    """One byte for the content of each of ``width`` (a power of two) parts; an empty part is 0.

    Bytes are sums, so that neighbouring parts of a wider sketch add up to those of a narrower one.
    """
    with np.errstate(over="ignore"):
        h = _mix(elements + _P[2])
    part = (h >> np.uint64(65 - width.bit_length())).astype(np.int64)
    return np.bincount(part, weights=h & np.uint64(255), minlength=width).astype(np.int64).astype(np.uint8).tobytes()


def own_width(size: int) -> int:
    """Bytes of the sketch of a set: the least power of two that has a byte for PER_BYTE shingles, PARTS at least."""
    return max(PARTS, 1 << (-(-size // PER_BYTE) - 1).bit_length()) if size else PARTS


def narrowed(sketch: bytes, width: int = SKETCH) -> np.ndarray:
    return np.frombuffer(sketch, np.uint8).reshape(width, -1).sum(axis=1, dtype=np.uint8)


def signatures(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(id, n_shingles, node, sketch, keys) of (id, text): node is the same for equal sets, null for empty ones.

    Only the first row of a node in a task has its sketch and keys. Other columns of ``docs`` are carried on.
    """
    others = [c for c in docs.columns if c not in ("id", "text")]
    carried = ["id", *others]
    types = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in carried)
    rows = docs.select(*carried, F.col("text").cast("string").alias("text"))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(rows, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            n, nodes, sketches, keys = [], [], [], []
            if len(seen) > SEEN:
                seen.clear()
            for t in batch.column("text"):
                s = shingles(t.as_py(), k)
                node = set_hash(s) if len(s) else None
                new = node is not None and node not in seen
                seen.add(node)
                n.append(len(s))
                nodes.append(node)
                sketches.append(sketch_of(s, own_width(len(s))) if new else None)
                keys.append(region_keys(s, num, den, frequent.value).view(np.int64) if new else np.zeros(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in keys])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*keys, np.zeros(0, np.int64)])))
            made = [pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays([*batch.select(carried).columns, *made], [*carried, "n_shingles", "node", "sketch", "keys"])

    return rows.mapInArrow(run, f"{types}, n_shingles bigint, node bigint, sketch binary, keys array<bigint>")


def shared_regions(members: DataFrame) -> DataFrame:
    """(region, p, x) of (region, node): the other sets of the regions that have several, with the first one, their pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            region, node = (c.to_numpy() for c in batch.columns)
            starts = np.concatenate([[last is None or region[0] != last[0]], region[1:] != region[:-1]])
            other = np.concatenate([[last is not None and node[0] != last[1]], node[1:] != node[:-1]]) & ~starts
            begin = np.maximum.accumulate(np.where(starts, np.arange(len(region)), -1))
            pivot = np.where(begin >= 0, node[begin], last[2] if last else 0)
            last = region[-1], node[-1], pivot[-1]
            made = [pa.array(c[other]) for c in (region, pivot, node)]
            yield pa.RecordBatch.from_arrays(made, ["region", "p", "x"])

    rows = members.select("region", "node").repartition("region").sortWithinPartitions("region", "node")
    return rows.mapInArrow(run, "region bigint, p bigint, x bigint")


def may_link(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (p, x) of ``sets`` (node, n, sketch) that neither sizes nor sketches rule out."""
    for side in ("p", "x"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}")), side)
    pairs = pairs.where(F.least("n_p", "n_x") * den >= F.greatest("n_p", "n_x") * num)
    for side in ("p", "x"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("sketch").alias(f"of_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, a, b in zip(*[batch.column(c).to_pylist() for c in ("n_p", "n_x", "of_p", "of_x")]):
                width = min(len(a), len(b))
                differ = int((narrowed(a, width) != narrowed(b, width)).sum())
                keep.append(differ * (den + num) <= (n + m) * (den - num))
            yield batch.select(["p", "x"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("p", "x", "n_p", "n_x", "of_p", "of_x").mapInArrow(run, "p bigint, x bigint")


def _narrow(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds n, the set's size, and its ``sketch`` of SKETCH bytes to rows with a node x."""
    kept = [c for c in rows.columns if c != "n"]
    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            narrow = pa.array([narrowed(s).tobytes() for s in batch.column("sketch").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], narrow], batch.schema.names)

    joined = rows.select(*kept).join(sets.select(F.col("node").alias("x"), "n", "sketch"), "x")
    return joined.select(*kept, "n", "sketch").mapInArrow(run, f"{types}, n bigint, sketch binary")


def close_pairs(small: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(p, x): pairs of different components in regions of at most DIRECT sets (region, x, comp) that sizes and sketches leave possible.

    A region is compared in the task that has it, with half a byte for each part of its sets' own sketches, so
    that only pairs go on that these can't tell apart, however long the sets are.
    """

    def halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = (np.frombuffer(s, np.uint8) & 15 for s in batch.column("sketch").to_pylist())
            packed = pa.array([(p[::2] | (p[1::2] << 4)).tobytes() for p in parts], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.select(["x", "size"]).columns, packed], ["x", "size", "halves"])

    named = sets.select(F.col("node").alias("x"), F.col("n").alias("size"), "sketch").join(small.select("x").distinct(), "x")
    halves = materialize(named.select("x", "size", "sketch").mapInArrow(halved, "x bigint, size bigint, halves binary"), "halves")
    rows = small.select("region", "x", "comp").join(halves, "x").select("region", "comp", "x", "size", "halves")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if held is None else pa.concat_batches([held, batch])
            region = held.column("region").to_numpy()
            last = int(np.searchsorted(region, region[-1]))  # the last region may go on in the next batch
            yield from _close_in_regions(held.slice(0, last), num, den)
            held = held.slice(last)
        if held is not None:
            yield from _close_in_regions(held, num, den)

    return rows.repartition("region").sortWithinPartitions("region").mapInArrow(compare, "p bigint, x bigint")


def _close_in_regions(rows: pa.RecordBatch, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """(p, x) of whole regions (region, comp, x, size, halves), sorted by region: each row with those that follow it."""
    region, comp, x, size = (rows.column(c).to_numpy() for c in ("region", "comp", "x", "size"))
    halves = rows.column("halves").to_pylist()
    narrow = np.array([_unpacked(h, PARTS) for h in halves], np.uint8).reshape(-1, PARTS)
    at, step = np.arange(len(region)), 0
    while len(at):
        step += 1
        at = at[at + step < len(region)]
        at = at[region[at] == region[at + step]]
        for start in range(0, len(at), PAIRS):
            one = at[start : start + PAIRS]
            near = (comp[one] != comp[one + step]) & (np.minimum(size[one], size[one + step]) * den >= np.maximum(size[one], size[one + step]) * num)
            one = one[near]
            most = (size[one] + size[one + step]) * (den - num) // (den + num)
            kept = (narrow[one] != narrow[one + step]).sum(axis=1) <= most
            pairs = [i for i, m in zip(one[kept].tolist(), most[kept].tolist()) if _differ(halves[i], halves[i + step]) <= m]
            if pairs:
                ends = x[pairs], x[np.array(pairs) + step]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(*ends)), pa.array(np.maximum(*ends))], ["p", "x"])


def _unpacked(halves: bytes, width: int) -> np.ndarray:
    """Half a byte for each of ``width`` parts."""
    both = np.frombuffer(halves, np.uint8)
    return np.stack([both & 15, both >> 4], axis=1).reshape(width, -1).sum(axis=1, dtype=np.uint8) & 15


def _differ(a: bytes, b: bytes) -> int:
    width = 2 * min(len(a), len(b))
    return int((_unpacked(a, width) != _unpacked(b, width)).sum())


def _tallied(batches: Iterator[pa.RecordBatch], codes_of, done) -> Iterator[pa.RecordBatch]:
    """``done`` of each region, sorted, and how often its rows have each code; ``codes_of`` rows: (codes, how often or None)."""
    region, tally = None, np.zeros(0, np.int64)
    for batch in batches:
        ids = batch.column("region").to_numpy()
        starts = np.flatnonzero(np.concatenate([[len(ids) > 0], ids[1:] != ids[:-1]])).tolist()
        for start, end in zip(starts, [*starts[1:], len(ids)]):
            if not len(tally) or ids[start] != region:
                if len(tally):
                    yield done(region, tally)
                region, tally = ids[start], np.zeros(SKETCH * 256, np.int64)
            codes, n = codes_of(batch.slice(start, end - start))
            tally += np.bincount(codes, weights=n, minlength=SKETCH * 256).astype(np.int64)
    if len(tally):
        yield done(region, tally)


def commonest(placed: DataFrame) -> DataFrame:
    """(region, common) of (region, x, sketch): the byte most sketches of a region have at each place, the larger one of a tie.

    Sketches are counted where they lie, TALLIED of a region at a time, so that what moves on is a
    region's counts, and no row for each byte.
    """

    def bytes_of(rows: pa.RecordBatch):
        sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
        return (sketches + np.arange(0, SKETCH * 256, 256)).ravel(), None

    def counts(region, tally: np.ndarray) -> pa.RecordBatch:
        codes = np.flatnonzero(tally)
        return pa.RecordBatch.from_pylist([{"region": region, "codes": codes, "n": tally[codes]}], part)

    def counted(rows: pa.RecordBatch):
        return rows.column("codes").flatten().to_numpy(), rows.column("n").flatten().to_numpy()

    def common(region, tally: np.ndarray) -> pa.RecordBatch:
        most = 255 - tally.reshape(SKETCH, 256)[:, ::-1].argmax(axis=1)
        return pa.RecordBatch.from_pylist([{"region": region, "common": most.astype(np.uint8).tobytes()}], whole)

    part = pa.schema([("region", pa.int64()), ("codes", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])
    whole = pa.schema([("region", pa.int64()), ("common", pa.binary())])
    shares = placed.groupBy("region").agg(F.ceil(F.count("*") / TALLIED).cast("int").alias("shares"))
    dealt = placed.join(shares, "region").select("region", "sketch", F.pmod(F.xxhash64("x"), "shares").cast("int").alias("share"))
    dealt = dealt.repartition("region", "share").sortWithinPartitions("region").select("region", "sketch")
    tallied = dealt.mapInArrow(lambda b: _tallied(b, bytes_of, counts), "region bigint, codes array<int>, n array<bigint>")
    tallied = tallied.repartition("region").sortWithinPartitions("region")
    return tallied.mapInArrow(lambda b: _tallied(b, counted, common), "region bigint, common binary")


def central_pairs(large: DataFrame, sets: DataFrame, turn: int) -> DataFrame:
    """(p, x): the sets of large regions (region, x, n), each in one of its regions, with the region's new pivot.

    The pivot is the set whose sketch differs least from the region's commonest bytes, so that the
    common origin of edited copies is found. The first turn takes a set's largest region, later ones
    another each.
    """
    rank = F.col("n") if turn == 0 else F.xxhash64("region", F.lit(turn))
    placed = large.groupBy("x").agg(F.max(F.struct(rank.alias("rank"), "region"))["region"].alias("region"))
    placed = materialize(_narrow(placed, sets).select("region", "x", "sketch"), "placed")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = [
                int((np.frombuffer(a, np.uint8) != np.frombuffer(b, np.uint8)).sum())
                for a, b in zip(batch.column("sketch").to_pylist(), batch.column("common").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([*batch.select(["region", "x"]).columns, pa.array(far, pa.int32())], ["region", "x", "far"])

    far = placed.join(commonest(placed), "region").select("region", "x", "sketch", "common").mapInArrow(run, "region bigint, x bigint, far int")
    pivots = far.groupBy("region").agg(F.min(F.struct("far", "x"))["x"].alias("p"))
    return placed.select("region", "x").join(pivots, "region").where("x != p").select("p", "x").distinct()


def _small(df: DataFrame) -> DataFrame:
    """For a materialized side of a join: a broadcast if its rows are few, else whatever Spark picks."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def distances(docs: DataFrame, reps: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(p, x, both, either): sizes of intersection and union for pairs of nodes, from the whole texts.

    ``reps``: (node, id) names a row of ``docs`` (id, text) for each node. Texts move once for each
    pair of theirs, a pivot's once for CHUNK pairs.
    """
    counted = pairs.groupBy("p").agg(F.count("*").alias("n")).select("p", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    dealt = pairs.join(counted, "p").select("p", "x", F.pmod(F.xxhash64("x"), F.col("chunks")).cast("int").alias("chunk"), "chunks")
    dealt = materialize(dealt, "pairs")
    others = dealt.select("p", "chunk", F.col("x").alias("node"), F.lit(1).alias("role"))
    pivots = dealt.select("p", "chunk", F.col("p").alias("node"), F.lit(0).alias("role")).distinct()
    wanted = materialize(others.unionByName(pivots), "wanted")
    rows = _texts(docs, reps, wanted.select("node").distinct(), k)
    rows = rows.join(_small(wanted), "node").select("p", "chunk", "role", "node", "text")
    rows = rows.repartition("p", "chunk").sortWithinPartitions("p", "chunk", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pivot = None, None
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c) for c in ("p", "chunk", "role", "node", "text")]
            for i in range(batch.num_rows):
                p, chunk, role, node = (c[i].as_py() for c in columns[:4])
                elements = shingles(columns[4][i].as_py(), k)
                if role == 0:
                    at, pivot = (p, chunk), elements
                    continue
                if at != (p, chunk):
                    raise AssertionError("the pivot's text is missing")
                both = len(np.intersect1d(pivot, elements, assume_unique=True))
                out.append((p, node, both, len(pivot) + len(elements) - both))
            made = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(m, pa.int64()) for m in made], ["p", "x", "both", "either"])

    return rows.mapInArrow(run, "p bigint, x bigint, both bigint, either bigint").distinct()


def _texts(docs: DataFrame, reps: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, text) of nodes; a repeated id may bring a text of another node, which is left out.

    Rows without an id are found by their node, which is computed where they are read.
    """
    needed = materialize(nodes.join(reps, "node").select("node", "id"), "needed")
    picked = docs.join(_small(needed), "id").select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [set_hash(shingles(t.as_py(), k)) == n.as_py() for n, t in zip(batch.column("node"), batch.column("text"))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    found = picked.mapInArrow(run, "node bigint, text string")
    unnamed = needed.where("id is null").select("node")
    if unnamed.isEmpty():
        return found

    def noded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), k) for t in batch.column("text")]
            nodes = pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([nodes, batch.column("text")], ["node", "text"])

    bare = docs.where("id is null").select(F.col("text").cast("string").alias("text")).mapInArrow(noded, "node bigint, text string")
    return found.union(bare.join(_small(unnamed), "node").dropDuplicates(["node"]).select("node", "text"))


def _crowd_pairs(crowd: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(p, x) of a crowd (x, comp): all pairs of different components that may be partners by their sketches."""
    spark = crowd.sparkSession
    sketched = materialize(_narrow(crowd, sets), "sketches")
    wanted = min(max(1, sketched.count() // PER_PIVOT), MAX_PIVOTS)
    pivots = sketched.orderBy(F.xxhash64("x"), "x").limit(wanted).select("sketch").collect()  # MAX_PIVOTS * SKETCH bytes
    shared = spark.sparkContext.broadcast(np.frombuffer(b"".join(r.sketch for r in pivots), np.uint8).reshape(-1, SKETCH))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, regions = [], []
            for i, (n, own) in enumerate(zip(batch.column("n").to_pylist(), batch.column("sketch").to_pylist())):
                far = (shared.value != np.frombuffer(own, np.uint8)).sum(axis=1)
                # a partner has at most n * den / num elements
                reach = n * (den - num) // num
                near = np.flatnonzero(far <= far.min() + 2 * reach)
                rows += [i] * len(near)
                regions += near.tolist()
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(rows, pa.int64())).columns, pa.array(regions, pa.int32())], [*batch.schema.names, "region"])

    dealt = materialize(sketched.select("x", "n", "sketch", "comp").mapInArrow(deal, "x bigint, n bigint, sketch binary, comp bigint, region int"), "dealt")
    blocks = dealt.groupBy("region").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int")
    celled = dealt.join(F.broadcast(blocks), "region").withColumn("own", own)  # MAX_PIVOTS rows
    celled = celled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    celled = celled.select("region", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "x", "n", "comp", "sketch")
    celled = celled.repartition("region", "a", "b").sortWithinPartitions("region", "a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[:3] != cell:
                    yield from _close(cell, held, num, den)
                    cell, held = row[:3], []
                held.append(row[3:])
        yield from _close(cell, held, num, den)

    return celled.mapInArrow(compare, "p bigint, x bigint").distinct()


def _close(cell, held: list[tuple], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs of one cell (two blocks of a region, or one with itself) that may be partners."""
    if len(held) < 2:
        return
    own, x, n, comp = (np.array([h[i] for h in held], np.int64) for i in range(4))
    sketches = np.frombuffer(b"".join(h[4] for h in held), np.uint8).reshape(-1, SKETCH)
    for i in range(len(held) - 1):
        rest = slice(i + 1, None)
        may = (comp[rest] != comp[i]) & (np.minimum(n[rest], n[i]) * den >= np.maximum(n[rest], n[i]) * num)
        if cell[1] != cell[2]:
            may &= own[rest] != own[i]
        at = np.flatnonzero(may) + i + 1
        if len(at):
            differ = (sketches[at] != sketches[i]).sum(axis=1)
            at = at[differ * (den + num) <= (n[at] + n[i]) * (den - num)]
        if len(at):
            pairs = [pa.array(np.minimum(x[at], x[i])), pa.array(np.maximum(x[at], x[i]))]
            yield pa.RecordBatch.from_arrays(pairs, ["p", "x"])


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over (p, x), for nodes with an edge. Labels go along
    edges, then labels of labels are taken, so chains shorten by half and more each time."""
    both = edges.select(F.col("p").alias("a"), F.col("x").alias("b"))
    both = materialize(both.union(both.select("b", "a")).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("comp"))
    labels = materialize(labels, "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("low"))
        now = labels.join(near, labels["node"] == near["a"]).select("node", F.least("comp", "low").alias("new"), "comp")
        now = materialize(now, "labels")
        heads = now.select(F.col("node").alias("head"), F.col("new").alias("further"))
        jumped = now.join(heads, now["new"] == heads["head"]).select("node", F.least("new", "further").alias("comp"), F.col("comp").alias("old"))
        jumped = materialize(jumped, "labels")
        labels = jumped.select("node", "comp")
        if jumped.where(F.col("comp") != F.col("old")).isEmpty():
            return labels


def _with_comp(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds comp; a node without a link is its own."""
    renamed = labels.select(F.col("node").alias("x"), "comp")
    return members.join(renamed, "x", "left").withColumn("comp", F.coalesce("comp", "x"))


def _is_link(num: int, den: int):
    return F.col("both") * den >= F.col("either") * num


def linked_nodes(docs: DataFrame, sigs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(node, comp) of the nodes that have a partner; ``sigs`` as ``signatures`` makes them, materialized."""
    named = sigs.where("node is not null")
    sets = named.groupBy("node").agg(F.min("id").alias("id"), F.max("n_shingles").alias("n"), F.first("sketch", True).alias("sketch"))
    sets = materialize(sets, "sets")
    found = materialize(shared_regions(named.select("node", F.explode("keys").alias("region"))), "regions")
    known = None

    def measured(pairs: DataFrame) -> DataFrame:
        pairs = pairs.distinct()
        if known is not None:
            before = known.select("p", "x").union(known.select(F.col("x").alias("p"), F.col("p").alias("x")))
            pairs = pairs.join(before, ["p", "x"], "left_anti")
        possible = materialize(may_link(pairs, sets, num, den), "pairs")
        apart = distances(docs, sets, possible, k)
        with small_batches(docs.sparkSession, TEXTS):
            return materialize(apart, "distances")

    def opened(members: DataFrame) -> DataFrame:
        """(region, x, comp, n) of the regions that aren't one component yet; n counts their sets."""
        active = materialize(_with_comp(members.select("region", "x"), labels), "active")
        stats = active.groupBy("region").agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        stats = materialize(stats.where(F.col("low") != F.col("high")).select("region", "n"), "open")
        return materialize(active.join(stats, "region"), "active")

    known = measured(found.select("p", "x"))
    labels = components(known.where(_is_link(num, den)).select("p", "x"))
    active = opened(found)
    for turn in range(ROUNDS):
        large = active.where(F.col("n") > SMALL)
        if large.isEmpty():
            break
        fresh = measured(central_pairs(large, sets, turn))
        known = known.unionByName(fresh)
        if fresh.where(_is_link(num, den)).isEmpty():
            break
        labels = components(known.where(_is_link(num, den)).select("p", "x"))
        active = opened(active)
    small, large = active.where(F.col("n") <= DIRECT), active.where(F.col("n") > DIRECT)
    wanted = close_pairs(small, sets, num, den)
    crowd = materialize(large.select("x", "comp").distinct(), "crowd")
    if not crowd.isEmpty():
        wanted = wanted.union(_crowd_pairs(crowd, sets, num, den))
    known = known.unionByName(measured(wanted))
    return components(known.where(_is_link(num, den)).select("p", "x"))


def join_classes(docs: DataFrame, k: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text", with_node: bool = False) -> DataFrame:
    """(id, n_shingles, component_id, first) of every row: the smallest id among the documents that
    links lead to, and whether the row is its component's first (the least id; among rows with that id
    the one whose set hash is least).

    Two documents are linked if den * |A & B| >= num * |A | B|. Null, empty and blank texts have no
    shingles and no links. Null ids count as greater than all others; a component of such rows only has
    a null id. Equal sets are one node, known by a 64-bit hash; repeated rows fall together. Other columns
    aren't read. ``with_node`` adds the node and ``text_hash``, by which rows of one id are told apart.
    """
    if not 4 * den <= 5 * num <= 5 * den:
        raise ValueError("num / den must be from 0.8 to 1: below, regions and sketches rule out too little")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    hashed = ["text_hash"] if with_node else []
    sigs = rows.withColumn("text_hash", _text_hash("text")) if with_node else rows
    sigs = signatures(sigs, k, num, den)
    with small_batches(docs.sparkSession, TEXTS):
        sigs = materialize(sigs, "signatures")
    labels = linked_nodes(rows, sigs, k, num, den)
    placed = sigs.select("id", *hashed, "n_shingles", "node").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    placed = materialize(placed.select("id", *hashed, "n_shingles", "node", "comp"), "placed")
    linked = placed.where("node is not null")
    least = materialize(linked.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull(), "id", "node")).alias("least")), "least")
    node = ["node", *hashed] if with_node else []
    joined = linked.join(least, "comp").select(
        "id",
        *node,
        "n_shingles",
        F.col("least.id").alias("component_id"),
        (F.col("id").eqNullSafe(F.col("least.id")) & (F.col("node") == F.col("least.node"))).alias("first"),
    )
    blank = placed.where("node is null").select("id", *node, "n_shingles", F.col("id").alias("component_id"), F.lit(True).alias("first"))
    return joined.union(blank)


def keep_one_of_each(docs: DataFrame, k: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of ``join_classes``: its first; rows without shingles all stay.

    Columns stay as they are, whatever their names. Of repeated rows one stays.
    """
    found = join_classes(docs, k, num, den, id_col, text_col, with_node=True)
    found = materialize(found.where("node is not null").select("id", "node", "text_hash", "first"), "classes")
    counted = found.groupBy("id", "node", "text_hash", "first").agg(F.count("*").alias("n"))
    counted = counted.withColumn("n_rows", F.sum("n").over(Window.partitionBy("id", "node")))  # over different texts
    marks = counted.where("not first or n_rows > 1").select(
        F.col("id").alias("of_id"), F.col("text_hash").alias("of_text"), F.when(F.col("first"), F.col("node")).alias("one")
    )
    right = _small(materialize(marks, "marks"))
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col(id_col).alias("id"), _text_hash(text_col).alias("text_hash"), record.alias("record"))
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_text"))
    plain = rows.join(right, same, "left_anti").select("record")
    again = right.where("one is not null")
    if again.isEmpty():
        return plain.select("record.*")
    one = rows.join(again, same).dropDuplicates(["id", "one"]).select("record")
    return plain.union(one).select("record.*")


@query("op10_jaccard_join")
def op10_jaccard_join(spark, sf_dir):
    found = join_classes(read(spark, sf_dir, "documents"), 3, 90, 100)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
