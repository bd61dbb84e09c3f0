"""Temporal scope."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def within_dates(df: DataFrame, start: date, end: date, column: str = "data") -> DataFrame:
    """Rows from ``start`` to ``end``, both days included.

    The raw column is compared, never a cast of it, so the filter reaches the
    Parquet scan; a timestamp column becomes a half-open interval.
    """
    dtype = df.schema[column].dataType
    value = F.col(column)
    if isinstance(dtype, T.DateType):
        return df.filter(value.between(F.lit(start), F.lit(end)))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        bound = lambda d: F.lit(d.isoformat()).cast(dtype)
        return df.filter((value >= bound(start)) & (value < bound(end + timedelta(days=1))))
    raise TypeError(f"{column} is neither a date nor a timestamp")
