"""Fleet register: composition and amenities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AMENITIES = {
    "ar_condicionado": "indicador_ar_condicionado",
    "elevador": "indicador_elevador",
    "usb": "indicador_usb",
    "wifi": "indicador_wifi",
}


def fleet_profile(fleet: DataFrame, as_of_year: int) -> DataFrame:
    """Vehicles, amenity shares and years since the last inspection, by technology and fuel."""
    shares = [
        F.avg(F.col(column).cast("int")).alias(f"fracao_{name}") for name, column in AMENITIES.items()
    ]
    return fleet.groupBy("tecnologia", "tipo_combustivel").agg(
        F.count(F.lit(1)).alias("veiculos"),
        *shares,
        F.avg(F.lit(as_of_year) - F.col("ano_ultima_vistoria")).alias("anos_desde_vistoria"),
    )
