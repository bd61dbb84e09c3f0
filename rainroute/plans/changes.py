"""What a build has to do again: the months that changed since the build before.

Silver and the fact are published in slots ``origem=<source>/parte=<part>``: batch rows by month of the trip, streamed
rows by query and batch. A build keeps, beside its version, which publications of its inputs it has read; the next one
compares them with the present ones and reads only the files of slots that differ to see which months they touch.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainroute.sources.versions import Store

KEYS = ("origem", "parte")
BATCH = "lote"
NO_MONTH = "msem-data"
BASES = "versao string, trips bigint, rain bigint, options string"


def month_part(column: str) -> Column:
    """Part of a batch row: the month of its date."""
    return F.coalesce(F.date_format(column, "'m'yyyy-MM"), F.lit(NO_MONTH))


def batch_slot(part: str) -> str:
    return f"origem={BATCH}/parte={part}"


def is_batch(slot: str) -> bool:
    return slot.startswith(f"origem={BATCH}/")


def in_months(column: str, parts: Sequence[str]) -> Column:
    """Whether a date lies in one of the months; as ranges of dates, which reach the files' statistics."""
    condition = F.lit(False)
    if NO_MONTH in parts:
        condition = condition | F.col(column).isNull()
    numbers = sorted(int(p[1:-3]) * 12 + int(p[-2:]) - 1 for p in parts if p != NO_MONTH)
    first = 0
    for i, n in enumerate(numbers):
        if i + 1 == len(numbers) or numbers[i + 1] != n + 1:
            low, high = numbers[first], n + 1
            days = [date(x // 12, x % 12 + 1, 1) for x in (low, high)]
            condition = condition | ((F.col(column) >= F.lit(days[0])) & (F.col(column) < F.lit(days[1])))
            first = i + 1
    return condition


def months_of(rows: DataFrame, column: str) -> set[str]:
    return {r[0] for r in rows.select(month_part(column)).distinct().collect()}  # a row per month


class Bases:
    """The input publications each build has read."""

    def __init__(self, store: Store):
        self.store = store
        self._path = f"{store.root}/_bases"

    def add(self, version: str, trips: int | None, rain: int | None, options: str) -> None:
        row = [(version, trips, rain, options)]
        self.store.spark.createDataFrame(row, BASES).coalesce(1).write.mode("append").parquet(self._path)

    def last(self):
        """Row of the latest build that was published, undone or not; None before the first."""
        if not self.store.folders(self._path):
            return None
        known = self.store.spark.read.schema(BASES).parquet(self._path)
        built = self.store.history().where("NOT volta").groupBy("versao").agg(F.max("ordem").alias("ordem"))
        return known.join(built, "versao").orderBy(F.desc("ordem")).first()
