"""Rain readings by station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rain_by_station(rain: DataFrame, stations: DataFrame) -> DataFrame:
    """Readings and mean rain per station, with the station's master data.

    Readings are aggregated first, so the station table meets one row per
    station id. Ids without master data stay, with NULL attributes; a master
    table listing an id twice is reduced to its latest record.
    """
    measured = rain.groupBy("id_estacao").agg(
        F.count(F.lit(1)).alias("leituras"),
        F.avg("acumulado_chuva_1_h").alias("media_chuva_1h"),
        F.max("acumulado_chuva_1_h").alias("maior_chuva_1h"),
    )
    master = (
        stations.groupBy("id_estacao")
        .agg(F.max(F.struct("data_atualizacao", "estacao", "situacao")).alias("m"))
        .select("id_estacao", "m.estacao", "m.situacao")
    )
    return measured.join(master, "id_estacao", "left")
