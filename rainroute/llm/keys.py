"""Rows picked by their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENT = 2_000_000  # keys that are broadcast at most: 32 MB


def picked(rows: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose (k1, k2) is among ``keys`` (``left_anti``: is not), ``keys`` being a written table.

    Up to ``SENT`` keys are counted first and broadcast, so long rows stay where they are; beyond that both
    sides are dealt by key.
    """
    if keys.limit(SENT + 1).count() <= SENT:
        keys = F.broadcast(keys)
    return rows.join(keys, ["k1", "k2"], how)
