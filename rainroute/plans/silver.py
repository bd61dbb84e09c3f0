"""Silver: one row per trip, carrying the rain of its departure hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rainroute.functions import DRY, hour_of_clock, hour_of_timestamp, is_weekend, rain_band
from rainroute.operators.lookup import group_rows, lookup_join

SILVER_COLUMNS = (
    "data_viagem",
    "id_viagem",
    "linha",
    "consorcio",
    "tipo_dia",
    "distancia_planejada",
    "tempo_viagem",
    "hora_partida",
    "is_weekend",
    "chuva_no_horario",
    "condicao_clima",
)
HOUR_KEY = ("data_viagem", "hora_partida")


def hourly_rain(rain: DataFrame) -> DataFrame:
    """Mean 1-hour accumulation over all stations and readings of each (date, hour)."""
    return rain.groupBy("data_particao", hour_of_clock("horario").alias("hora_medicao")).agg(
        F.avg("acumulado_chuva_1_h").alias("avg_chuva_1h")
    )


def trip_attributes(trips: DataFrame) -> DataFrame:
    """The silver columns that need no rain."""
    return trips.select(
        F.col("data").alias("data_viagem"),
        "id_viagem",
        F.col("servico").alias("linha"),
        "consorcio",
        "tipo_dia",
        "distancia_planejada",
        "tempo_viagem",
        hour_of_timestamp("datetime_partida").alias("hora_partida"),
        is_weekend("data").alias("is_weekend"),
    )


def enrich(
    attributes: DataFrame,
    hourly: DataFrame,
    hourly_rows: int | None,
    band=rain_band,
) -> DataFrame:
    """Attach the hour's rain to every trip; hours without a measurement are dry.

    ``hourly`` has one row per (date, hour) because it is an aggregate on that
    key, so every trip comes out exactly once.
    """
    keyed = hourly.select(
        F.col("data_particao").alias(HOUR_KEY[0]),
        F.col("hora_medicao").alias(HOUR_KEY[1]),
        F.col("avg_chuva_1h").alias("__mm"),
    )
    return lookup_join(attributes, keyed, HOUR_KEY, rows=hourly_rows).select(
        *attributes.columns,
        F.coalesce("__mm", F.lit(0.0)).alias("chuva_no_horario"),
        band("__mm").alias("condicao_clima"),
    ).select(*[c for c in SILVER_COLUMNS if c in (*attributes.columns, "chuva_no_horario", "condicao_clima")])


def reenrich(wide: DataFrame, hourly: DataFrame, hourly_rows: int | None, band=rain_band) -> DataFrame:
    """Silver rows with their rain looked up again, for measurements that came after the trips."""
    return enrich(wide.drop("chuva_no_horario", "condicao_clima"), hourly, hourly_rows, band)


def silver_trips(trips: DataFrame, rain: DataFrame, band=rain_band) -> DataFrame:
    """Wide trip table from bronze trips and rain readings."""
    hours = group_rows(rain, "data_particao", hour_of_clock("horario"))
    return enrich(trip_attributes(trips), hourly_rain(rain), hours, band)


def one_rain_per_hour(classified: DataFrame) -> DataFrame:
    """Reduce already classified rain to one row per (date, hour): the heaviest record.

    Amount and class stay a pair. Joining trips to the raw records instead would
    multiply every trip by the records of its hour. The heaviest record per class folds in a hash
    aggregate before the shuffle; the window then sees one row per hour and class.
    """
    heaviest = classified.groupBy(
        F.col("data_particao").alias(HOUR_KEY[0]),
        hour_of_timestamp("datetime_partida").alias(HOUR_KEY[1]),
        "tipo_chuva",
    ).agg(F.max("chuva_1h_no_inicio").alias("chuva_1h_no_inicio"))
    order = Window.partitionBy(*HOUR_KEY).orderBy(F.desc_nulls_last("chuva_1h_no_inicio"), F.desc_nulls_last("tipo_chuva"))
    first = heaviest.withColumn("__n", F.row_number().over(order)).filter("__n = 1")
    return first.select(*HOUR_KEY, "chuva_1h_no_inicio", "tipo_chuva")


def _preclassified_columns(amount: Column, kind: Column) -> list[Column]:
    return [
        F.coalesce(amount, F.lit(0.0)).alias("chuva_no_horario"),
        F.coalesce(kind, F.lit(DRY)).alias("condicao_clima"),
    ]


def silver_trips_preclassified(trips: DataFrame, classified: DataFrame) -> DataFrame:
    """Alternative silver: rain amount and class come ready from upstream."""
    base = trip_attributes(trips).withColumnRenamed("linha", "servico")
    hours = group_rows(classified, "data_particao", hour_of_timestamp("datetime_partida"))
    joined = lookup_join(base, one_rain_per_hour(classified), HOUR_KEY, rows=hours)
    return joined.select(
        "data_viagem",
        "id_viagem",
        "servico",
        "consorcio",
        "tipo_dia",
        "hora_partida",
        "is_weekend",
        "tempo_viagem",
        "distancia_planejada",
        *_preclassified_columns(F.col("chuva_1h_no_inicio"), F.col("tipo_chuva")),
    )
