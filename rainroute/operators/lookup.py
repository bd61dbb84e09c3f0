"""Row-preserving lookups against a side that is unique on the join key.

A side is broadcast when its exact row number is known and small. Otherwise the join is left to
Spark: adaptive execution broadcasts what turns out small and splits the partition of a hot
key, and only the columns that are used later are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of a hashed relation; a row costs its columns' widths and about this much besides.
BROADCAST_BYTES = 64 << 20
ROW_BYTES, TEXT_BYTES = 32, 64


def row_bytes(df: DataFrame) -> int:
    """Estimated width of a row: 8 bytes a column, more for text."""
    return ROW_BYTES + sum(TEXT_BYTES if kind == "string" else 8 for _, kind in df.dtypes)


def fits(right: DataFrame, rows: int | None, broadcast_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a side of so many rows is broadcast."""
    return rows is not None and rows * row_bytes(right) <= broadcast_bytes


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    rows: int | None,
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``right`` (unique on ``keys``) to ``left``.

    ``rows`` is ``right``'s exact row number or an upper bound, None if unknown.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    if fits(right, rows, broadcast_bytes):
        right = F.broadcast(right)
    return left.join(right, list(keys), how)


def group_rows(df: DataFrame, *keys) -> int:
    """Exact number of groups of the keys; one narrow aggregate."""
    return df.groupBy(*keys).agg(F.lit(1).alias("one")).count()
