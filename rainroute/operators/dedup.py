"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row that is greatest on ``order``, then on all other columns.

    An aggregate rather than a window: duplicates fold on the map side, so a key
    holding a large share of the rows never meets in one task. Rows with a NULL
    in the key cannot be told apart and are all kept.
    """
    key, order = list(key), list(order)
    rest = [c for c in df.columns if c not in key and c not in order]
    payload = [*order, *rest]
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    best = (
        df.filter(complete)
        .groupBy(*key)
        .agg(F.max(F.struct(*payload)).alias("__best"))
        .select(*key, *[F.col(f"__best.{c}").alias(c) for c in payload])
        .select(*df.columns)
    )
    return best.unionByName(df.filter(~complete))
