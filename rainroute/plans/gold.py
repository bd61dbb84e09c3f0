"""Gold: star schema with natural keys over the silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainroute.functions import day_category

# Fact column -> silver column; the fact is a projection, one row per trip.
FACT_COLUMNS = {
    "id_viagem": "id_viagem",
    "data_id": "data_viagem",
    "consorcio_id": "consorcio",
    "clima_id": "condicao_clima",
    "linha": "linha",
    "hora_partida": "hora_partida",
    "tempo_viagem": "tempo_viagem",
    "distancia_planejada": "distancia_planejada",
    "chuva_no_horario": "chuva_no_horario",
}


def dim_calendar(silver: DataFrame) -> DataFrame:
    """Distinct (date, day type); two day types on one date give two rows."""
    days = silver.select("data_viagem", "is_weekend", "tipo_dia").distinct()
    return days.select(
        F.col("data_viagem").alias("data_id"),
        F.dayofmonth("data_viagem").alias("dia"),
        F.month("data_viagem").alias("mes"),
        F.year("data_viagem").alias("ano"),
        day_category("is_weekend").alias("desc_categoria_dia"),
        F.col("tipo_dia").alias("desc_sazonalidade"),
    )


def _key_and_label(silver: DataFrame, column: str, key: str, label: str) -> DataFrame:
    members = silver.select(column).distinct()
    return members.select(F.col(column).alias(key), F.col(column).alias(label))


def dim_consortium(silver: DataFrame) -> DataFrame:
    return _key_and_label(silver, "consorcio", "consorcio_id", "nome_consorcio")


def dim_weather(silver: DataFrame) -> DataFrame:
    return _key_and_label(silver, "condicao_clima", "clima_id", "desc_intensidade")


def fact_trips(silver: DataFrame) -> DataFrame:
    """Fact rows; a silver frame without the rain columns gives a fact without them."""
    return silver.select(
        *[F.col(source).alias(name) for name, source in FACT_COLUMNS.items() if source in silver.columns]
    )
