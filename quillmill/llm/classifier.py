"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A bounded, documented sample of labelled rows (``SAMPLE`` per label, the smallest hashes of
their ids) gives inverse document frequencies of hashed byte trigrams and their leading singular
directions. The labelled latent vectors (``2 * SAMPLE`` rows of ``DIMS`` floats, 1 MB) go to all
workers, which compute each document's exact cosine with every one of them in blocks and let the
``NEIGHBOURS`` nearest vote, weighted by similarity. Every document is scored, from its text alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import read
from quillmill.llm.quality import repeated_words
from quillmill.llm.registry import query

#: Labelled rows per label at most, hashed features, latent dimensions, voters, documents per block.
SAMPLE, FEATURES, DIMS, NEIGHBOURS, BLOCK = 2048, 2048, 64, 31, 512


#: Cells after the trigrams': words equal to the word before, words in repeated windows, words in
#: capitals; each per word (and 20 more), raised so that a text full of them points their way.
STYLES, STYLE_WEIGHT = 3, 8.0


def text_counts(text: str | None) -> np.ndarray:
    """Counts of the text's byte trigrams in FEATURES hashed cells, then STYLES shares of its words."""
    data = (text or "").encode()
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    out = np.zeros(FEATURES + STYLES, np.float32)
    if len(raw) < 3:
        return out
    mixed = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    mixed = mixed * np.uint32(2654435761)
    out[:FEATURES] = np.bincount(mixed >> np.uint32(21), minlength=FEATURES)
    words = data.split()
    if words:
        again = sum(a == b for a, b in zip(words, words[1:]))
        loud = sum(len(w) > 2 and w.isupper() for w in words)
        out[FEATURES:] = np.array([again, repeated_words(words), loud]) / (len(words) + 20)
    return out


def _damped(counts: np.ndarray) -> np.ndarray:
    """Logs of counts per thousand, so that long and short texts are alike."""
    out = counts.astype(np.float32)
    total = out[:, :FEATURES].sum(axis=1, keepdims=True)
    out[:, :FEATURES] = np.log1p(out[:, :FEATURES] * (1000.0 / np.maximum(total, 1.0)))
    out[:, FEATURES:] = STYLE_WEIGHT * np.log1p(1000.0 * out[:, FEATURES:])
    return out


class Voters:
    """What the workers need: feature weights, latent directions, labelled vectors and their labels."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray):
        self.prior = float(labels.mean()) if len(labels) else 0.5
        if not len(labels):
            self.vectors = np.zeros((0, DIMS), np.float32)
            return
        seen = (counts > 0).sum(axis=0)
        self.weights = np.log((1.0 + len(counts)) / (1.0 + seen)).astype(np.float32) + 1.0
        self.weights[FEATURES:] = 1.0
        x = _damped(counts) * self.weights
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        values, directions = np.linalg.eigh((x.T @ x).astype(np.float64))
        self.directions = directions[:, np.argsort(-values)[:DIMS]].astype(np.float32)
        self.vectors = self._unit(x @ self.directions)
        self.labels = labels.astype(np.float32)

    @staticmethod
    def _unit(z: np.ndarray) -> np.ndarray:
        return (z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest, weighted by cosine; texts with no trigram get the sample's share."""
        out = np.full(len(counts), self.prior)
        full = np.flatnonzero(counts[:, :FEATURES].sum(axis=1) > 0)
        if not len(self.vectors) or not len(full):
            return out
        z = self._unit((_damped(counts[full]) * self.weights) @ self.directions)
        near = z @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        at = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, at, axis=1), 0.0).astype(np.float64)
        total = weight.sum(axis=1)
        vote = (weight * self.labels[at]).sum(axis=1)
        out[full] = np.where(total > 0, vote / np.maximum(total, 1e-12), self.prior)
        return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame) -> Voters:
    """``labels``: (id, label 0 or 1), only rows to learn from; ``docs``: (id, text).

    Takes SAMPLE rows per label. Only their fixed-size counts reach the driver (at most 2 * SAMPLE *
    FEATURES floats, 34 MB). Null ids and labels are left out; without any row all scores are 0.5.
    The order of rows and partitions changes scores by rounding at most: voters are ordered by (label, counts).
    """
    usable = labels.select("id", F.col("label").cast("int").alias("label")).where("id is not null and label in (0, 1)")
    usable = usable.dropDuplicates(["id"])
    picked = None
    for label in (0, 1):
        part = usable.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
        picked = part if picked is None else picked.union(part)
    chosen = docs.select("id", "text").join(F.broadcast(picked), "id")  # 2 * SAMPLE rows

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [text_counts(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(counted, pa.binary()), batch.column("label")], ["counts", "label"])

    rows = chosen.select("text", "label").mapInArrow(count, "counts binary, label int").distinct().collect()
    rows.sort(key=lambda r: (r.label, bytes(r.counts)))  # ties among voters go by this order, not by how rows arrive
    counts = np.array([np.frombuffer(r.counts, np.float32) for r in rows], np.float32).reshape(len(rows), FEATURES + STYLES)
    return Voters(counts, np.array([r.label for r in rows], np.float64))


def score(docs: DataFrame, voters: Voters) -> DataFrame:
    """(id, score) of every row of (id, text), in one narrow stage; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(voters)
    rows = docs.select("id", F.col("text").cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                counts = np.array([text_counts(t.as_py()) for t in part.column("text")], np.float32)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(model.scores(counts), pa.float64())], ["id", "score"])

    return rows.mapInArrow(run, f"id {id_type}, score double")


def held_out(doc_id: str):
    """Rows never learnt from: crc32 of the id's text leaves 1 by 3."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def is_held_out(doc_id) -> bool:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 3 == 1


@query("op3_quality")
def op3_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    labels = read(spark, sf_dir, "labels").where(~held_out("doc_id"))
    voters = fit(docs, labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")))
    return score(docs, voters).select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
