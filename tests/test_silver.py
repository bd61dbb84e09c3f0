from datetime import date, datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rainroute.contracts import CONTRACTS
from rainroute.operators.lookup import group_rows, lookup_join
from rainroute.plans import questions, silver
from rainroute.sources import proxy

DAY = date(2024, 3, 25)


def trips_frame(spark, *departures):
    """(id, date, departure) records as bronze trips."""
    df = spark.createDataFrame(list(departures), "id_viagem string, data date, datetime_partida timestamp")
    given = set(df.columns)
    return df.select(
        *[
            F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name)
            for f in CONTRACTS["viagens_onibus"].schema.fields
        ]
    )


def rain_frame(spark, *readings):
    """(date, clock, mm) readings; at least the schema when there are none."""
    return spark.createDataFrame(
        list(readings), "data_particao date, horario string, acumulado_chuva_1_h double"
    )


def test_hourly_rain_is_the_plain_mean_over_stations_and_readings(spark):
    eight = [(DAY, f"06:{m:02d}:00", float(v)) for v, m in enumerate([0, 15, 30, 45] * 2)]
    got = rows(silver.hourly_rain(rain_frame(spark, *eight, (DAY, "07:00:00", None), (DAY, "08:00:00", 2.0),
                                             (DAY, "08:15:00", None))))
    assert got == [(DAY, 6, 3.5), (DAY, 7, None), (DAY, 8, 2.0)]


def test_every_trip_is_kept_once(spark):
    trips = trips_frame(
        spark,
        ("wet", DAY, datetime(2024, 3, 25, 6, 30)),
        ("other hour", DAY, datetime(2024, 3, 25, 9)),
        ("null reading", DAY, datetime(2024, 3, 25, 7)),
        ("no departure", DAY, None),
        ("no date", None, datetime(2024, 3, 25, 6)),
    )
    rain = rain_frame(spark, (DAY, "06:00:00", 4.0), (DAY, "06:15:00", 8.0), (DAY, "07:00:00", None))
    got = rows(silver.silver_trips(trips, rain), "id_viagem", "hora_partida", "chuva_no_horario", "condicao_clima")
    assert got == [
        ("no date", 6, 0.0, "Sem Chuva"),
        ("no departure", None, 0.0, "Sem Chuva"),
        ("null reading", 7, 0.0, "Sem Chuva"),
        ("other hour", 9, 0.0, "Sem Chuva"),
        ("wet", 6, 6.0, "Moderada"),
    ]


def test_silver_columns(spark, tiny):
    got = silver.silver_trips(proxy.trips(spark, tiny), proxy.rain(spark, tiny))
    assert tuple(got.columns) == silver.SILVER_COLUMNS
    types = dict(got.dtypes)
    assert (types["hora_partida"], types["is_weekend"], types["chuva_no_horario"]) == ("int", "boolean", "double")


def test_no_rain_at_all(spark):
    got = silver.silver_trips(trips_frame(spark, ("a", DAY, datetime(2024, 3, 25, 6))), rain_frame(spark))
    assert rows(got, "id_viagem", "condicao_clima") == [("a", "Sem Chuva")]


def test_preclassified_rain_does_not_multiply_trips(spark):
    trips = trips_frame(
        spark, ("a", DAY, datetime(2024, 3, 25, 6)), ("b", DAY, datetime(2024, 3, 25, 6, 5)), ("c", DAY, None)
    )
    classified = spark.createDataFrame(
        [(DAY, datetime(2024, 3, 25, 6, 1), 2.0, "Fraca"), (DAY, datetime(2024, 3, 25, 6, 2), 30.0, "Forte")],
        "data_particao date, datetime_partida timestamp, chuva_1h_no_inicio double, tipo_chuva string",
    )
    unguarded = trips.join(
        classified.withColumnRenamed("datetime_partida", "medida"),
        (F.col("data") == F.col("data_particao")) & (F.hour("datetime_partida") == F.hour("medida")),
        "left",
    )
    assert unguarded.filter(F.col("id_viagem") != "c").count() == 4
    got = silver.silver_trips_preclassified(trips, classified)
    assert rows(got, "id_viagem", "chuva_no_horario", "condicao_clima") == [
        ("a", 30.0, "Forte"), ("b", 30.0, "Forte"), ("c", 0.0, "Sem Chuva")]
    assert "linha" not in got.columns and "servico" in got.columns


def test_hours_are_counted_not_bounded_by_the_span_of_days(spark):
    rain = rain_frame(spark, (date(2024, 1, 1), "00:00:00", 1.0), (date(2024, 1, 3), "05:00:00", 1.0), (None, "05:00:00", 1.0))
    assert group_rows(rain, "data_particao", "horario") == silver.hourly_rain(rain).count() == 3
    assert group_rows(rain_frame(spark), "data_particao", "horario") == 0


def test_one_date_of_long_ago_does_not_turn_the_join(spark, tiny):
    stray = rain_frame(spark, (date(1190, 1, 1), "00:00:00", 1.0))
    rain = proxy.rain(spark, tiny).unionByName(stray, allowMissingColumns=True)
    joined = silver.silver_trips(proxy.trips(spark, tiny), rain)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(joined).count("BroadcastHashJoin LeftOuter") >= 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_only_below_the_bound_and_same_rows_either_way(spark, tiny):
    attributes = silver.trip_attributes(proxy.trips(spark, tiny, consortium=False))
    hourly = silver.hourly_rain(proxy.rain(spark, tiny))
    small, unknown = silver.enrich(attributes, hourly, 1000), silver.enrich(attributes, hourly, None)
    assert "BroadcastHashJoin LeftOuter" in plan(small)
    assert "Exchange hashpartitioning" not in plan(small).split("BroadcastExchange")[0].split("HashAggregate")[0]
    assert small.exceptAll(unknown).count() == 0 and unknown.exceptAll(small).count() == 0


def test_lookup_without_broadcast(spark, tiny):
    """Hot and NULL keys lose and repeat nothing, and only the columns in use are shuffled."""
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50).alias("k"), "id"
    )
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lookup_join(left, right, ["k"], rows=None)
        text = plan(got)
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
        assert got.count() == 3000
        assert got.filter(F.col("k").isNotNull() & (F.col("v") != F.col("k") * 10)).count() == 0
        assert got.filter(F.col("v").isNull()).count() == 1000
        assert lookup_join(left, right, ["k"], rows=None, how="inner").count() == 2000
        assert lookup_join(left, right, ["k"], rows=10**9).count() == 3000
        items = proxy.table(spark, tiny, "lineitem")
        wide = lookup_join(items, right.withColumnRenamed("k", "l_suppkey"), ["l_suppkey"], rows=None)
        scan = next(x for x in plan(wide.groupBy("v").count()).split("\n\n") if "ReadSchema" in x)
        assert "struct<l_suppkey" in scan and "," not in scan.split("ReadSchema: struct<")[1].split(">")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        lookup_join(left, right, ["k"], rows=1, how="full")


def test_heaviest_rain_is_found_without_sorting_the_readings(spark, tiny):
    text = plan(silver.one_rain_per_hour(proxy.classified_rain(spark, tiny)))
    assert "SortAggregate" not in text and "partial_max" in text


def test_unmatched_share(spark):
    trips = trips_frame(
        spark, ("a", DAY, datetime(2024, 3, 25, 6)), ("b", DAY, datetime(2024, 3, 25, 7)), ("c", DAY, None)
    )
    got = questions.unmatched_rain_share(trips, rain_frame(spark, (DAY, "06:00:00", 0.0)))
    assert rows(got) == [(3, 2)]
