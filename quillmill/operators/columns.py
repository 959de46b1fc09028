"""Filters and column selection."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from quillmill.functions.columns import is_inf, is_nan

log = logging.getLogger(__name__)


def shard_filter(df: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of one shard of a manifest, whose ``month`` is the composite key."""
    return df.where((F.col("year") == year) & (F.col("month") == year * 100 + month))


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def select_signature(df: DataFrame, accepted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The columns a consumer accepts, in its order, and the names left out."""
    kept = [c for c in accepted if c in df.columns]
    ignored = [c for c in df.columns if c not in accepted]
    if ignored:
        log.info("ignored columns: %s", ", ".join(ignored))
    return df.select(*kept), ignored


def text_column(df: DataFrame) -> DataFrame:
    """Name the text column ``text``: the one so called, else the first one."""
    if "text" in df.columns:
        return df
    return df.withColumnRenamed(df.columns[0], "text")


def nonfinite_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: values checked, NaN values, infinite values."""
    types = {f.name: f.dataType for f in df.schema.fields}
    measured = []
    for name in columns:
        kind = types[name]
        c = F.col(name)
        if isinstance(kind, ArrayType):
            if not isinstance(kind.elementType, (DoubleType, FloatType)):
                raise TypeError(f"{name} is not a numeric array")
            checked = F.size(c)
            nan = F.size(F.filter(c, is_nan))
            inf = F.size(F.filter(c, is_inf))
        else:
            checked = c.isNotNull().cast("int")
            nan = is_nan(c).cast("int")
            inf = is_inf(c).cast("int")
        measured.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.coalesce(F.sum(checked), F.lit(0)).alias("n_values"),
                F.coalesce(F.sum(nan), F.lit(0)).alias("n_nan"),
                F.coalesce(F.sum(inf), F.lit(0)).alias("n_inf"),
                F.coalesce(F.sum(((nan > 0) | (inf > 0)).cast("int")), F.lit(0)).alias("n_bad_rows"),
            )
        )
    return df.agg(F.array(*measured).alias("r")).select(F.inline("r"))
