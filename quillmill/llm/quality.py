"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Each text gives a vector of transformed statistics. For every (language, source) a minimum
covariance determinant estimate is found by concentration steps over all its distinct vectors:
from medians and absolute deviations, the ``CORE`` share nearest by Mahalanobis distance gives the
next mean and covariance, and so on; a last step reweights. Sources with fewer than ``LEAST``
vectors share an estimate by language, languages by the rest. A text is rejected beyond ``CUT``.
All steps are aggregates of a few sums per group, so no group meets in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import materialize, read
from quillmill.llm.registry import query

#: The vector's parts: log mean word length; symbols, capitals and other marks per word or letter;
#: shares of words in repeated windows and of repeated lines. All are drawn towards TYPICAL by
#: PRIOR_WORDS words, as short texts say little, and taken to spread by FLOOR at least, so that a
#: crowd of (near) copies can't make everything else an outlier.
PARTS = ("length", "symbols", "capitals", "marks", "repeats", "duplicates")
TYPICAL = (1.6, 0.0, 0.05, 0.15, 0.0, 0.0)
FLOOR = (0.12, 0.08, 0.05, 0.08, 0.08, 0.10)
PRIOR_WORDS = 40
CORE, STEPS, LEAST = 0.75, 3, 200
#: A text is rejected beyond the squared distance that normal data exceed with this chance. As the
#: floors widen every estimate, ordinary texts stay far within.
TAIL = 0.01
BROADCAST_GROUPS = 20_000
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"

_CLASS = np.zeros(256, np.uint8)
for _kind, _members in enumerate((BLANKS, SYMBOLS, bytes(range(65, 91)), bytes(range(97, 123)), b"!\"'(),-./:;=?@[\\]^_`{}~+"), 1):
    _CLASS[list(_members)] = _kind


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """How many words lie in a window of ``window`` words that the text has twice or more."""
    n = len(words)
    if n <= window:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    if len(known) == n:
        return 0
    codes, have = ids, 1
    while have < window:  # exact codes of ever longer runs: each step pairs two runs that overlap or touch
        step = min(have, window - have)
        paired = codes[: len(codes) - step] * np.int64(n) + codes[step:]
        codes = np.unique(paired, return_inverse=True)[1].astype(np.int64)
        have += step
    counts = np.bincount(codes)
    starts = np.flatnonzero(counts[codes] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_statistics(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the vector."""
    data = (text or "").encode()
    words = data.split()
    raw = np.frombuffer(data, np.uint8)
    kinds = np.bincount(_CLASS[raw], minlength=6)
    chars = int(((raw & 0xC0) != 0x80).sum())
    n, word_chars, symbols = len(words), chars - int(kinds[1]), int(kinds[2])
    seen, dup, lines = set(), 0, 0
    for line in data.split(b"\n"):
        if line.strip(BLANKS):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeats = repeated_words(words)
    w = n + PRIOR_WORDS
    letters = int(kinds[3] + kinds[4]) + 5 * PRIOR_WORDS
    vector = (
        math.log((word_chars + PRIOR_WORDS * math.exp(TYPICAL[0])) / w),
        math.log1p(symbols / w),
        (int(kinds[3]) + TYPICAL[2] * 5 * PRIOR_WORDS) / letters,
        math.log1p((int(kinds[5]) + TYPICAL[3] * PRIOR_WORDS) / w),
        repeats / w,
        dup / (lines + 5),
    )
    return n, word_chars, symbols, dup, repeats, *vector


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with the five counts and the six parts of the vector."""
    rows = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    schema += "".join(f", {c} bigint" for c in COUNTS) + "".join(f", {p} double" for p in PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(zip(*[text_statistics(t.as_py()) for t in batch.column("__text")])) or [()] * 11
            made = [pa.array(v, pa.int64() if i < 5 else pa.float64()) for i, v in enumerate(found)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + made, [*keep, *COUNTS, *PARTS])

    return rows.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def chi_square_cdf(x: float, p: int) -> float:
    """For an even number of parts p."""
    half, term, total = x / 2, 1.0, 0.0
    for k in range(p // 2):
        total += term
        term *= half / (k + 1)
    return 1.0 - math.exp(-half) * total


def chi_square_tail_quantile(tail: float, p: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        half, term, total = mid / 2, 1.0, 0.0
        for k in range(p // 2):
            total += term
            term *= half / (k + 1)
        low, high = (mid, high) if math.exp(-half) * total > tail else (low, mid)
    return high


P = len(PARTS)
CUT = chi_square_tail_quantile(TAIL, P)
_UPPER = [(i, j) for i in range(P) for j in range(i, P)]
_ESTIMATE = [f"m{i}" for i in range(P)] + [f"q{i}_{j}" for i, j in _UPPER]


def _distance() -> Column:
    """Squared Mahalanobis distance of a vector from its group's estimate."""
    off = [F.col(p) - F.col(f"m{i}") for i, p in enumerate(PARTS)]
    total = F.lit(0.0)
    for i, j in _UPPER:
        total = total + off[i] * off[j] * F.col(f"q{i}_{j}") * (1.0 if i == j else 2.0)
    return total


def _inverse(moments: DataFrame, spread: float) -> DataFrame:
    """(lang_key, source_key, mean, inverse covariance) from sums; few rows, done where they are.

    ``spread`` makes the covariance of a central share consistent; FLOOR is then added.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            mean = part[[f"m{i}" for i in range(P)]].to_numpy()
            cov = np.zeros((len(part), P, P))
            for i, j in _UPPER:
                cov[:, i, j] = cov[:, j, i] = (part[f"c{i}_{j}"].to_numpy() - mean[:, i] * mean[:, j]) * spread
            # rounding may leave tiny negative variances; the floor keeps the matrix regular
            cov[:, range(P), range(P)] = np.maximum(cov[:, range(P), range(P)], 0.0) + np.square(FLOOR)
            low = np.minimum(np.linalg.eigvalsh(cov)[:, 0] - 1e-6, 0.0)
            cov[:, range(P), range(P)] -= low[:, None]
            inv = np.linalg.inv(cov)
            out = part[["lang_key", "source_key", *[f"m{i}" for i in range(P)]]].copy()
            for i, j in _UPPER:
                out[f"q{i}_{j}"] = inv[:, i, j]
            yield out

    schema = "lang_key string, source_key string, " + ", ".join(f"{c} double" for c in _ESTIMATE)
    return moments.mapInPandas(run, schema)


def _attach(vectors: DataFrame, estimates: DataFrame, groups: int) -> DataFrame:
    """By broadcast for a checked number of groups, by a join that Spark may split beyond."""
    return vectors.join(_near(estimates, groups), ["lang_key", "source_key"])


def grouped(vectors: DataFrame, least: int) -> DataFrame:
    """lang_key and source_key: own group if it has ``least`` rows, else the language's rest, else all's rest."""
    sizes = vectors.groupBy("lang", "source").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("source_key", F.when(F.col("n") >= least, F.concat(F.lit("="), F.coalesce("source", F.lit("")))).otherwise("*"))
    by_lang = sizes.groupBy("lang", "source_key").agg(F.sum("n").alias("m"))
    big = (F.col("m") >= least) | (F.col("source_key") != "*")
    keys = by_lang.withColumn("lang_key", F.when(big, F.concat(F.lit("="), F.coalesce("lang", F.lit("")))).otherwise("*"))
    return sizes.alias("s").join(keys.alias("k"), F.col("s.lang").eqNullSafe(F.col("k.lang")) & (F.col("s.source_key") == F.col("k.source_key"))).select(
        F.col("s.lang").alias("of_lang"), F.col("s.source").alias("of_source"), "lang_key", F.col("s.source_key").alias("source_key")
    )


def estimates_of(vectors: DataFrame, groups: int) -> DataFrame:
    """Minimum covariance determinant estimates of (lang_key, source_key, parts), by concentration."""
    key = ["lang_key", "source_key"]
    medians = vectors.groupBy(*key).agg(*[F.percentile_approx(p, 0.5).alias(f"m{i}") for i, p in enumerate(PARTS)])
    medians = materialize(medians, "medians")
    off = _attach(vectors, medians, groups)
    spreads = off.groupBy(*key).agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(P)],
        *[F.percentile_approx(F.abs(F.col(p) - F.col(f"m{i}")), 0.5).alias(f"d{i}") for i, p in enumerate(PARTS)],
    )
    diagonal = [
        (1.0 / (F.pow(F.col(f"d{i}") * 1.4826, 2) + FLOOR[i] ** 2) if i == j else F.lit(0.0)).alias(f"q{i}_{j}") for i, j in _UPPER
    ]
    now = materialize(spreads.select(*key, *[f"m{i}" for i in range(P)], *diagonal), "estimates")
    core = chi_square_tail_quantile(1 - CORE, P)
    inner = CORE / chi_square_cdf(core, P + 2)
    for step in range(STEPS + 1):
        last = step == STEPS
        measured = _attach(vectors, now, groups).select(*key, *PARTS, _distance().alias("d"))
        if last:  # reweighting: all that lies within the 97.5 % quantile
            chosen, spread = measured.where(F.col("d") <= chi_square_tail_quantile(0.025, P)), 1.0
        else:
            limits = materialize(measured.groupBy(*key).agg(F.percentile_approx("d", CORE).alias("limit")), "limits")
            chosen, spread = _attach(measured, limits, groups).where(F.col("d") <= F.col("limit")), inner
        sums = chosen.groupBy(*key).agg(
            *[F.avg(p).alias(f"m{i}") for i, p in enumerate(PARTS)],
            *[F.avg(F.col(PARTS[i]) * F.col(PARTS[j])).alias(f"c{i}_{j}") for i, j in _UPPER],
        )
        fresh = _inverse(sums, spread)
        if last:  # a group that lost all its rows keeps its estimate
            kept = now.join(fresh.select(*key), key, "left_anti")
            fresh = fresh.unionByName(kept)
        now = materialize(fresh, "estimates")
    return now


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(id, five counts, base_failed, distance, kept) of every row.

    Null texts are empty (and fail); null languages and sources are groups of their own. Exact
    copies count once in an estimate; repeated rows are all judged alike. Other columns aren't read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text")
    )
    measured = materialize(with_statistics(rows, ["id", "lang", "source"]), "statistics")
    return _judged(measured, *_fit(measured)).select("id", *COUNTS, "base_failed", "distance", "kept")


def _fit(measured: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(groups, estimates, number of groups) from all rows of (lang, source, counts, parts)."""
    distinct = materialize(measured.where(~base_failed()).select("lang", "source", *PARTS).distinct(), "vectors")
    keys = materialize(grouped(distinct, LEAST), "groups")
    groups = keys.count()
    vectors = distinct.join(_near(keys, groups), _same_group()).select("lang_key", "source_key", *PARTS)
    return keys, estimates_of(materialize(vectors, "vectors"), groups), groups


def _near(df: DataFrame, groups: int) -> DataFrame:
    return F.broadcast(df) if groups <= BROADCAST_GROUPS else df


def _same_group() -> Column:
    return F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))


def _judged(measured: DataFrame, keys: DataFrame, estimates: DataFrame, groups: int) -> DataFrame:
    """Adds base_failed, distance and kept; groups of failed rows only have no estimate, nor need one."""
    joined = measured.withColumn("base_failed", base_failed()).join(_near(keys, groups), _same_group(), "left")
    joined = joined.join(_near(estimates, groups), ["lang_key", "source_key"], "left")
    joined = joined.withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    return joined.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUT))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns as they are, whatever their names.

    The statistics are taken twice, so that whole texts needn't be shuffled to meet their verdicts.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"), record.alias("record")
    )
    fitted = _fit(materialize(with_statistics(rows, ["lang", "source"]), "statistics"))
    judged = _judged(with_statistics(rows, ["lang", "source", "record"]), *fitted)
    return judged.where("kept").select("record.*")


@query("op8_rules")
def op8_rules(spark, sf_dir):
    judged = judge(read(spark, sf_dir, "documents"))
    return judged.withColumnRenamed("id", "doc_id")
