"""Implausible trip durations. No threshold has a default: callers choose."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def within_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies in [low, high]; a missing value is not an implausible one and stays."""
    return df.filter(F.col(column).between(low, high) | F.col(column).isNull())


def quantile_fences(df: DataFrame, group: str, column: str, low: float, high: float) -> DataFrame:
    """Exact interpolated quantiles per group, NULL values left out.

    Values are counted first: durations are whole minutes, so a group comes down
    to one row per distinct minute on the map side, however many trips it has. Other
    types are refused, since nothing bounds their distinct values.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{column} is {kind.simpleString()}; fences need whole numbers")
    counted = df.groupBy(group, column).agg(F.count(column).alias("n")).filter(F.col("n") > 0)
    return counted.groupBy(group).agg(
        F.percentile(column, F.lit(low), F.col("n")).alias("limite_inferior"),
        F.percentile(column, F.lit(high), F.col("n")).alias("limite_superior"),
    )


def rank_error(k: int) -> float:
    """How far the rank of a sketched quantile may be from the asked one, as a share of the rows, at 99 %.

    Fixed values: the published error constants of the KLL sketch.
    """
    return 2.296 / k**0.9021


def sketched_fences(df: DataFrame, group: str, column: str, low: float, high: float, k: int = 400) -> DataFrame:
    """Quantiles per group of a column of any number type from mergeable sketches, within ``rank_error(k)`` of the rank.

    A group comes down to a sketch of a few kilobytes on the map side, however many distinct values it
    has. Groups of up to ``k`` values are exact. NULL and NaN are left out; a group without values has no fences.
    """
    value = F.col(column).cast("double")
    fine = df.filter(value.isNotNull() & ~F.isnan(value))
    sketched = fine.groupBy(group).agg(F.kll_sketch_agg_double(value, k).alias("__sketch"))
    quantile = lambda q: F.kll_sketch_get_quantile_double("__sketch", F.lit(float(q)))
    return sketched.select(group, quantile(low).alias("limite_inferior"), quantile(high).alias("limite_superior"))


def within_fences(
    df: DataFrame, group: str, column: str, low: float, high: float, sketch: int | None = None
) -> DataFrame:
    """Rows between the ``low`` and ``high`` quantile of their group.

    Quantiles are exact, for whole numbers; with ``sketch``, the size of a sketch, they are within its rank error, for
    numbers of any type. Rows that cannot be judged, without a value (NULL or NaN) or without a group, stay. The join is
    left to Spark, which knows the size of the fences when they are there.
    """
    fences = sketched_fences(df, group, column, low, high, sketch) if sketch else quantile_fences(df, group, column, low, high)
    joined = df.join(fences, group, "left")
    kept = F.col(column).between(F.col("limite_inferior"), F.col("limite_superior"))
    if sketch:
        kept = kept | F.isnan(F.col(column).cast("double"))
    return joined.filter(F.coalesce(kept, F.lit(True)) | F.col(group).isNull()).select(*df.columns)
