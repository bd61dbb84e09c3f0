"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-category labels and Spark's dayofweek numbers of the weekend.
WEEKEND_LABEL = "Final de Semana"
WORKDAY_LABEL = "Dia Útil"
SUNDAY, SATURDAY = 1, 7


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of_timestamp(ts: Column | str) -> Column:
    """Hour 0-23 of a timestamp, NULL for NULL."""
    return F.hour(_col(ts)).cast("int")


def hour_of_clock(clock: Column | str) -> Column:
    """Hour of an ``HH:mm:ss`` text as the contracts produce it; NULL outside 0-23 and for other text."""
    hour = F.substring(_col(clock), 1, 2).try_cast("int")
    return F.when(hour.between(0, 23), hour)


def is_weekend(day: Column | str) -> Column:
    """True on Saturday and Sunday, False otherwise and for a NULL date."""
    return F.coalesce(F.dayofweek(_col(day)).isin(SUNDAY, SATURDAY), F.lit(False))


def day_category(weekend: Column | str) -> Column:
    """Label of the weekend flag; NULL counts as a working day."""
    return F.when(_col(weekend), WEEKEND_LABEL).otherwise(WORKDAY_LABEL)
