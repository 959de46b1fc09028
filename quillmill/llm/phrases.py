"""Collocations by set-oriented mining (SETM) over sorted occurrence relations.

A relation of level k holds every place where k words of the last frequent groups stand side by side.
It is written in *runs*: word ids in text order, in which every k neighbours are a tuple and 0 ends a
run, so it is sorted by piece and position by itself, and the merge join of a relation with itself at
the adjacent position compares neighbours. Each level counts its tuples in Spark (pre-aggregated per
block), keeps the frequent groups, semi-joins the relation with them and writes it again before the
next word is added. Ids are dense numbers of (language, word), so counts need no language column and
a phrase is two longs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm.common import materialize, read
from quillmill.llm.registry import query
from quillmill.operators.ordering import row_index

#: Words of a phrase at most, and its occurrences at least.
LONGEST, LEAST = 4, 30
#: Bytes of text whose occurrences are counted together in a task.
BLOCK = 4 << 20
#: Bits of the filter that stands for the frequent groups of a level: so many for each, up to a limit.
#: Beyond it more infrequent groups pass and are counted in vain; counts stay exact.
BITS_EACH, MAX_BITS = 16, 1 << 27

#: Parts of a language that are ranked by themselves first.
LANES = 64

_TEXT = bytearray(range(256))
for _b in range(65, 91):
    _TEXT[_b] = _b + 32
for _b in b".,;:!?\n\x0b\x0c\r":
    _TEXT[_b] = 10
_TEXT = bytes(_TEXT)
_WORD = np.ones(256, bool)
_WORD[[9, 10, 32]] = False

_BLOCKS = "block bigint, lang string, words array<int>, word array<string>, uses array<bigint>"


def _coded(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Runs of word numbers from 1, the words by number, and how often each is used."""
    data = b"\n".join(texts).translate(_TEXT)
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number) + 1) for w in data.split()), np.int32)
    at = np.frombuffer(data, np.uint8)
    is_word = _WORD[at]
    starts = np.flatnonzero(is_word & ~np.concatenate(([False], is_word[:-1])))
    piece = np.cumsum(at == 10, dtype=np.int32)[starts]
    new = np.flatnonzero(piece[1:] != piece[:-1]) + 1
    return np.insert(codes, new, 0), list(number), np.bincount(codes, minlength=len(number) + 1)[1:]


def _relation(docs: DataFrame) -> DataFrame:
    """Blocks (block, lang, words: runs of the block's word numbers, word, uses) of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = block = 0
        first = TaskContext.get().partitionId() << 32

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block
            for lang, texts in held.items():
                words, word, uses = _coded(texts)
                one = [[first + block], [lang], [words], [[w.decode() for w in word]], [uses]]
                block += 1
                kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(one, kinds)], ["block", "lang", "words", "word", "uses"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                raw = text.as_buffer().to_pybytes()
                held.setdefault(lang.as_py(), []).append(raw)
                size += len(raw)
                if size >= BLOCK:
                    yield from flush()
                    size = 0
        yield from flush()

    return docs.mapInArrow(run, _BLOCKS)


def _numbered(relation: DataFrame, words: DataFrame) -> DataFrame:
    """(words): the runs with ids of ``words`` (lang, word, id); words that aren't among them end a run.

    Only the blocks' lists of words are joined with the vocabulary, not their occurrences.
    """
    listed = relation.select("block", "lang", F.posexplode("word").alias("number", "word"))
    known = listed.join(words, ["lang", "word"]).groupBy("block").agg(
        F.collect_list(F.struct("number", "id")).alias("known")  # at most the words of a block
    )
    joined = relation.select("block", "words").join(known, "block").select("words", "known.number", "known.id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for words, number, ident in zip(*[batch.column(c) for c in ("words", "number", "id")]):
                words = words.values.to_numpy(zero_copy_only=False)
                of = np.zeros(max(int(words.max(initial=0)), 0) + 1, np.int32)
                of[number.values.to_numpy(zero_copy_only=False) + 1] = ident.values.to_numpy(zero_copy_only=False)
                made.append(_tidy(of[words]))
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.int32()))], ["words"])

    return joined.mapInArrow(run, "words array<int>")


def _tidy(words: np.ndarray) -> np.ndarray:
    """Without a second 0 in a row."""
    return words[(words != 0) | np.concatenate(([False], words[:-1] != 0))] if len(words) else words


def _tuples(words: np.ndarray, k: int) -> np.ndarray:
    """Positions at which k words of one run begin."""
    whole = np.ones(max(len(words) - k + 1, 0), bool)
    for i in range(k):
        whole &= words[i : i + len(whole)] != 0
    return np.flatnonzero(whole)


def _keys(words: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k words from each position of ``at`` as two longs; words beyond the last are 0."""
    parts = [words[at + i].astype(np.int64) if i < k else 0 for i in range(LONGEST)]
    return (parts[0] << 32) + parts[1], (parts[2] << 32) + parts[3] + np.zeros(len(at), np.int64)


def _bit(high: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    """A place in the filter; ``bits`` is a power of two."""
    with np.errstate(over="ignore"):
        x = high.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + low.astype(np.uint64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
    return (x & np.uint64(bits - 1)).astype(np.int64)


def _count(relation: DataFrame, k: int) -> DataFrame:
    """(high, low, uses) of the tuples of level k that occur at least LEAST times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in batch.column("words"):
                words = words.values.to_numpy(zero_copy_only=False)
                at = _tuples(words, k)
                high, low = _keys(words, at, k)
                if k > 2:
                    _, pair = np.unique(high, return_inverse=True)
                    _, rest = np.unique(low, return_inverse=True)
                    both = pair.astype(np.int64) * (int(rest.max(initial=0)) + 1) + rest
                    _, one, uses = np.unique(both, return_index=True, return_counts=True)
                    high, low = high[one], low[one]
                else:
                    high, uses = np.unique(high, return_counts=True)
                    low = np.zeros(len(high), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (high, low, uses)], ["high", "low", "uses"])

    counted = relation.mapInArrow(run, "high bigint, low bigint, uses bigint")
    return counted.groupBy("high", "low").agg(F.sum("uses").alias("uses")).where(F.col("uses") >= LEAST)


def _filter_of(groups: DataFrame) -> np.ndarray:
    """Bits set for ``groups`` (high, low): the size is bounded by MAX_BITS, whatever their number."""
    wanted = max(groups.count() * BITS_EACH, 64)
    bits = min(1 << int(wanted - 1).bit_length(), MAX_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("high", "low"))
            place = np.unique(_bit(high, low, bits))
            slot, first = np.unique(place >> 6, return_index=True)
            mask = np.bitwise_or.reduceat(np.uint64(1) << (place & 63).astype(np.uint64), first) if len(place) else place
            yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(mask.view(np.int64), pa.int64())], ["slot", "mask"])

    slots = groups.select("high", "low").mapInArrow(run, "slot bigint, mask bigint").groupBy("slot").agg(F.bit_or("mask").alias("mask"))
    found = slots.toArrow()  # at most MAX_BITS / 64 rows of 16 bytes
    out = np.zeros(bits >> 6, np.int64)
    out[found.column("slot").to_numpy()] = found.column("mask").to_numpy()
    return out


def _semi_joined(relation: DataFrame, k: int, groups: DataFrame) -> DataFrame:
    """The runs of ``relation`` whose k neighbours are always among ``groups`` (and a few others)."""
    sent = relation.sparkSession.sparkContext.broadcast(_filter_of(groups))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        bits = len(table) << 6
        for batch in batches:
            made = []
            for words in batch.column("words"):
                words = words.values.to_numpy(zero_copy_only=False)
                at = _tuples(words, k)
                place = _bit(*_keys(words, at, k), bits)
                at = at[(table[place >> 6] >> (place & 63)) & 1 == 1]
                made.append(_runs(words, at, k))
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.int32()))], ["words"])

    return relation.mapInArrow(run, "words array<int>")


def _runs(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The words of the k-tuples that begin at ``at``, in runs; a run ends where the next position isn't in ``at``."""
    if not len(at):
        return np.zeros(0, np.int32)
    new = np.flatnonzero(np.diff(at) != 1) + 1
    first = at[np.concatenate(([0], new))]
    last = at[np.concatenate((new - 1, [len(at) - 1]))]
    lengths = last - first + k + 1  # with the 0 at the end
    ends = np.cumsum(lengths)
    index = np.arange(ends[-1]) + np.repeat(first - (ends - lengths), lengths)
    out = words[np.minimum(index, len(words) - 1)]
    out[ends - 1] = 0
    return out


def _key(ids: list[Column]) -> list[Column]:
    """(high, low) of a phrase's words."""
    zero = F.lit(0).cast("bigint")
    ids = [i.cast("bigint") for i in ids] + [zero] * (LONGEST - len(ids))
    return [F.shiftleft(ids[0], 32).bitwiseOR(ids[1]), F.shiftleft(ids[2], 32).bitwiseOR(ids[3])]


def _ids(k: int) -> list[Column]:
    low = F.lit((1 << 32) - 1)
    both = [F.shiftright(F.col("high"), 32), F.col("high").bitwiseAND(low), F.shiftright(F.col("low"), 32), F.col("low").bitwiseAND(low)]
    return both[:k]


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def frequent_groups(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(lang, n), (lang, word, id, uses) and, for k = 1 to LONGEST, (high, low, uses) of ``docs``: totals, frequent words and groups."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    relation = materialize(_relation(docs.select(lang.alias("lang"), text.alias("text"))), "occurrences-0")
    used = relation.select("lang", F.explode(F.arrays_zip("word", "uses")).alias("w")).select("lang", "w.word", "w.uses")
    totals = used.groupBy("lang").agg(F.sum("uses").alias("n"))
    words = used.groupBy("lang", "word").agg(F.sum("uses").alias("uses")).where(F.col("uses") >= LEAST)
    words = row_index(materialize(words, "frequent-words"), ["lang", "word"], name="id")
    ident = F.when(F.col("id") < (1 << 31) - 1, (F.col("id") + 1).cast("int")).otherwise(F.raise_error(F.lit("too many frequent words")).cast("int"))
    words = materialize(words.select("lang", "word", "uses", ident.alias("id")), "words-1")
    levels = [words.select(*[c.alias(n) for n, c in zip(("high", "low"), _key([F.col("id")]))], "uses")]
    relation = materialize(_numbered(relation, words.select("lang", "word", "id")), "occurrences-1")
    for k in range(2, LONGEST + 1):
        groups = materialize(_count(relation, k), f"groups-{k}")
        levels.append(groups)
        if k < LONGEST:
            relation = materialize(_semi_joined(relation, k, groups), f"occurrences-{k}")
    return totals, words, levels


def scored(levels: list[DataFrame]) -> DataFrame:
    """(k, high, low, a, l, r, score) of the candidates that no longer candidate covers."""
    parts = _union([level.select("high", "low", "uses") for level in levels])
    cuts, inner = [], []
    for k, level in list(enumerate(levels, 1))[1:]:
        ids = _ids(k)
        each = [F.struct(F.lit(i).alias("cut"), *[c.alias(n) for n, c in zip(("lh", "ll", "rh", "rl"), _key(ids[:i]) + _key(ids[i:]))]) for i in range(1, k)]
        cuts.append(level.select(F.lit(k).alias("k"), "high", "low", F.col("uses").alias("a"), F.explode(F.array(*each)).alias("c")))
        within = [F.struct(*[c.alias(n) for n, c in zip(("high", "low"), _key(ids[i : i + j]))]) for j in range(2, k) for i in range(k - j + 1)]
        if within:
            inner.append(level.select("uses", F.explode(F.array(*within)).alias("w")).select("w.high", "w.low", "uses"))
    cut = _union(cuts).select("k", "high", "low", "a", "c.*")
    left = parts.select(F.col("high").alias("lh"), F.col("low").alias("ll"), F.col("uses").alias("l"))
    right = parts.select(F.col("high").alias("rh"), F.col("low").alias("rl"), F.col("uses").alias("r"))
    cut = cut.join(left, ["lh", "ll"]).join(right, ["rh", "rl"])
    # 38 digits: exact where 64 bits would not do
    score = F.expr("cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0)) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    least = cut.select("k", "high", "low", "a", F.struct(score.alias("score"), "cut", "l", "r").alias("c"))
    least = least.groupBy("k", "high", "low", "a").agg(F.min("c").alias("c"))
    most = _union(inner).groupBy("high", "low").agg(F.max("uses").alias("longer"))
    kept = least.join(most, ["high", "low"], "left")
    kept = kept.where(F.col("longer").isNull() | (F.col("longer").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * 80))
    return kept.select("k", "high", "low", "a", "c.l", "c.r", "c.score")


def collocations(docs: DataFrame, top: int, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases by score.

    Words are runs of anything but blanks and tabs within pieces that .,;:!? and line breaks end, ASCII
    letters in lower case. ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut,
    ``n`` all words of the language. Ties go by ``a``, then by the phrase's bytes. Null languages count
    as ``und``, null and empty texts have no words; repeated rows count as often as they occur; other
    columns aren't read; no rows give no rows.
    """
    totals, words, levels = frequent_groups(docs, lang_col, text_col)
    found = scored(levels)
    first = words.select(F.col("id").alias("first"), "lang")
    found = found.join(first, F.shiftright("high", 32) == F.col("first")).drop("first")
    # the best of each lane first, so that one language's task gets at most LANES times as many as stay
    for lane in ([F.pmod(F.xxhash64("high", "low"), F.lit(LANES))], []):
        by = Window.partitionBy("lang", *lane).orderBy(F.desc("score"), F.desc("a"))
        found = found.withColumn("rank", F.rank().over(by)).where(F.col("rank") <= top).drop("rank")
    found = materialize(found, "best-phrases")
    ids = F.filter(F.array(*_ids(LONGEST)), lambda i: i > 0)
    spelled = found.select("lang", "high", "low", F.posexplode(ids).alias("at", "id")).join(words.select("id", "word"), "id")
    spelled = spelled.groupBy("lang", "high", "low").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    phrase = F.array_join("words.word", " ")
    named = found.join(spelled.select("lang", "high", "low", phrase.alias("phrase")), ["lang", "high", "low"])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


TOP = 2000

SQL = f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, (SELECT unnest([1, 2, 3, 4]) AS k)) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
found AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= {LEAST}),
cut AS (
  SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score, i
  FROM (SELECT *, unnest(range(1, k)) AS i FROM found) c
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:i], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[i + 1:], ' ')),
least AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
kept AS (
  SELECT * FROM least s WHERE NOT EXISTS (
    SELECT 1 FROM found q WHERE q.lang = s.lang AND q.k > len(string_split(s.phrase, ' '))
    AND contains(' ' || q.phrase || ' ', ' ' || s.phrase || ' ') AND 100::HUGEINT * q.a >= 80::HUGEINT * s.a))
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN totals USING (lang)
WHERE rank <= {TOP}"""


@query("op12_collocations", SQL)
def op12_collocations(spark, sf_dir):
    return collocations(read(spark, sf_dir, "documents").select("lang", "text"), TOP)
