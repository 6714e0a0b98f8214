"""Key sets: which keys repeat, which keys have no counterpart.

Both look at key columns only and merge equal keys on the map side before they shuffle,
so a key held by a large share of the rows costs one row per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType


_COUNT, _KNOWN = "__siftwork_count", "__siftwork_known"


def key_column(df: DataFrame, name: str) -> Column:
    """The key, with NaN read as missing."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return F.when(~F.isnan(column), column)
    return column


def duplicate_keys(df: DataFrame, *columns: str, missing_repeats: bool = True) -> DataFrame:
    """Keys held by more than one row; null counts as a key like any other, or not at all."""
    keys = df.select(*[key_column(df, name).alias(name) for name in columns])
    if not missing_repeats:
        keys = keys.dropna(subset=list(columns))
    return (
        keys.groupBy(*[F.col(f"`{name}`") for name in columns])
        .agg(F.count(F.lit(1)).alias(_COUNT))
        .filter(F.col(_COUNT) > 1)
        .drop(_COUNT)
    )


def orphan_keys(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Non-null keys of ``df`` that no row of ``reference`` holds."""
    own_type = df.schema[column].dataType
    known = reference.select(
        _as_type(reference, reference_column, own_type).alias(_KNOWN)
    ).filter(F.col(_KNOWN).isNotNull())
    used = df.select(key_column(df, column).alias(column)).filter(F.col(column).isNotNull())
    return used.distinct().join(
        known.distinct(), F.col(column) == F.col(_KNOWN), "left_anti"
    )


def rows_holding(df: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys``, missing keys included."""
    renamed = keys.select(*[F.col(f"`{name}`").alias(f"__siftwork_key_{name}") for name in columns])
    same = reduce(
        lambda left, right: left & right,
        [key_column(df, name).eqNullSafe(F.col(f"__siftwork_key_{name}")) for name in columns],
    )
    return df.join(renamed, same, "left_semi")


def _as_type(df: DataFrame, column: str, wanted: DataType) -> Column:
    """A reference key in the type of the referring key; unreadable keys match nothing."""
    key = key_column(df, column)
    own = df.schema[column].dataType
    if own == wanted or not (isinstance(own, StringType) or isinstance(wanted, StringType)):
        return key
    return key.try_cast(wanted)
