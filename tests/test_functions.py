from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rainroute.functions import (
    canonical_name,
    day_category,
    hour_of_clock,
    hour_of_timestamp,
    is_weekend,
    mapped_name,
    rain_band,
    rain_band_contiguous,
)

DRY = "Sem Chuva"
BANDS = [
    (None, DRY), (-1.0, DRY), (0.0, DRY), (0.05, DRY), (0.1, "Fraca"), (5.0, "Fraca"),
    (5.0001, "Moderada"), (25.0, "Moderada"), (25.05, DRY), (25.1, "Forte"), (50.0, "Forte"),
    (50.01, "Muito Forte"),
]


def test_rain_band_limits_first_match_and_hole(spark):
    df = spark.createDataFrame(BANDS, "mm double, expected string")
    assert df.filter(rain_band("mm") != F.col("expected")).count() == 0
    assert df.filter(rain_band("mm").isNull()).count() == 0


def test_contiguous_band_only_fills_the_hole(spark):
    df = spark.createDataFrame(BANDS, "mm double, expected string")
    changed = df.filter(rain_band_contiguous("mm") != F.col("expected"))
    assert rows(changed.select("mm", rain_band_contiguous("mm"))) == [(25.05, "Forte")]


def test_weekend_is_saturday_or_sunday_and_false_for_null(spark):
    days = [(date(2024, 3, 23), True), (date(2024, 3, 24), True), (date(2024, 3, 25), False), (None, False)]
    df = spark.createDataFrame(days, "d date, expected boolean").select(is_weekend("d").alias("got"), "expected")
    assert all(r["got"] is r["expected"] for r in df.collect())


def test_day_category_of_null_is_a_working_day(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "w boolean")
    assert rows(df, "w", day_category("w")) == [
        (None, "Dia Útil"), (False, "Dia Útil"), (True, "Final de Semana")]


def test_hours(spark):
    df = spark.sql("SELECT timestamp'2024-03-25 23:59:59' AS ts, '07:45:00' AS clock")
    assert rows(df, hour_of_timestamp("ts"), hour_of_clock("clock")) == [(23, 7)]
    odd = spark.createDataFrame([("00:00:00",), ("24:00:00",), ("-1:00:00",), ("xx:00",), ("",), (None,)], "clock string")
    assert rows(odd, hour_of_clock("clock")) == [(None,)] * 5 + [(0,)]


@pytest.mark.parametrize(
    "name, wanted",
    [("  inter  norte ", "INTER NORTE"), ("Intersul", "INTERSUL"), ("   ", None), (None, None), ("a\t b", "A B")],
)
def test_canonical_name(spark, name, wanted):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(canonical_name("n")).first()[0] == wanted


def test_mapped_name_keeps_unknown_names(spark):
    df = spark.createDataFrame([("sta cruz",), ("Intersul",), (None,)], "n string")
    got = rows(df, mapped_name("n", {"STA CRUZ": "SANTA CRUZ"}))
    assert got == [(None,), ("INTERSUL",), ("SANTA CRUZ",)]
