"""Column expressions for paths, shard keys, token arrays and numeric checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE_RUN = r"[ \t\n\x0B\f\r]+"
IGNORE_INDEX = -100


def reroot_path(path: Column, root: str, drop: int = 6) -> Column:
    """Replace the first ``drop`` components of a path by ``root``."""
    parts = F.split(path, "/")
    kept = F.slice(parts, drop + 1, F.greatest(F.size(parts) - drop, F.lit(0)))
    return F.concat(F.lit(root.rstrip("/") + "/"), F.array_join(kept, "/"))


def shard_key(year: Column, month: Column) -> Column:
    """The composite month of a manifest: year 1, month 2 is 102."""
    return year * 100 + month


def shard_label(year: Column, month: Column) -> Column:
    """The four-digit form of :func:`shard_key` used in file names."""
    return F.lpad(shard_key(year, month).cast("string"), 4, "0")


def checkpoint_step(path: Column) -> Column:
    """Step number in a checkpoint name, null for other names."""
    digits = F.regexp_extract(path, "checkpoint-([0-9]+)", 1)
    return F.when(digits != "", digits.cast("long"))


def tokens_of(text: Column) -> Column:
    """Whitespace-separated tokens; none for an empty text."""
    # a leading or trailing space leaves an empty piece
    return F.array_remove(F.split(text, SPACE_RUN), "")


def unify_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def decode_text(content: Column) -> Column:
    """UTF-8 where the whole file is valid UTF-8, Latin-1 otherwise."""
    as_utf8 = content.cast("string")
    decoded = F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(F.decode(content, "ISO-8859-1"))
    return unify_newlines(decoded)


def pad_right(values: Column, length: Column, filler: int) -> Column:
    missing = F.greatest(length - F.size(values), F.lit(0))
    return F.concat(values, F.array_repeat(F.lit(filler), missing))


def is_nan(value: Column) -> Column:
    return F.isnan(value)


def is_inf(value: Column) -> Column:
    return F.abs(value) == F.lit(float("inf"))


def is_nonfinite(value: Column) -> Column:
    return is_nan(value) | is_inf(value)


def argmax_token(logits: Column) -> Column:
    """Index of the largest logit, the first one on ties."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def with_ignored_pads(ids: Column, pad_id: int, ignore: int = IGNORE_INDEX) -> Column:
    return F.transform(ids, lambda x: F.when(x == pad_id, F.lit(ignore)).otherwise(x))


def round_binary(value: Column, places: int) -> Column:
    """Round the exact binary value, ties to even, as Python's ``round`` does.

    Spark's ``round`` looks at the shortest decimal form, so it takes 32.87875
    (really a little less) for a tie. Here the distance to the nearest half step
    is computed without error by splitting the value into two short parts.
    """
    scale = float(2 * 10**places)
    halves = F.rint(value * scale)
    head = value.cast("float").cast("double")
    rest = (head * scale - halves) + (value - head) * scale
    down, up = (halves - 1) / 2, (halves + 1) / 2
    steps = (
        F.when(halves % 2 == 0, halves / 2)
        .when(rest > 0, up)
        .when(rest < 0, down)
        .otherwise(F.when(down % 2 == 0, down).otherwise(up))
    )
    return steps / float(10**places)


def epoch_of(epoch: Column, step_in_epoch: Column, steps_in_epoch: Column, skipped: Column | None = None) -> Column:
    """Fractional epoch after a batch, as it is logged."""
    done = step_in_epoch + 1 + (skipped if skipped is not None else F.lit(0))
    return round_binary(epoch + done / steps_in_epoch, 2)
