"""Adapter: read the TPC-H-like test tables as trips, rain, stations and fleet.

Only tests, the benchmark and ``__spark_entry__`` use it. Column rules are the
ones of FIXTURES.md section 2. Lookups keep every trip, so a query that does not
ask for the consortium can leave that join out (``consortium=False``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainroute.contracts import CONTRACTS
from rainroute.functions import rain_band

LINES_PER_SUPPLIER = 12
STATIONS = 33


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is taken from the footer once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _joined_text(*parts: str) -> Column:
    return F.concat_ws("-", *[F.col(p).cast("string") for p in parts])


def _day_type(day: Column) -> Column:
    weekday = F.dayofweek(day)
    return F.when(weekday == 1, "Domingo").when(weekday == 7, "Sábado").otherwise("Dia Útil")


def _padded(df: DataFrame, dataset: str, given: dict[str, Column]) -> DataFrame:
    """All contract columns in order; those without a proxy are NULL."""
    return df.select(
        *[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CONTRACTS[dataset].schema.fields
        ]
    )


def with_region(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """Add r_name by l_suppkey. Each table joins on its own, so Catalyst sees its file
    size: small ones are broadcast, a large supplier table is shuffled."""
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return (
        df.join(supplier, "l_suppkey", "left")
        .join(nation, "s_nationkey", "left")
        .join(region, "n_regionkey", "left")
    )


def trips(
    spark: SparkSession,
    sf_dir: str,
    *,
    consortium: bool = True,
    clashing_day_type: bool = False,
    lineitem: DataFrame | None = None,
) -> DataFrame:
    """Trips in the ``viagens_onibus`` contract.

    ``clashing_day_type`` gives every date two day types.
    """
    items = table(spark, sf_dir, "lineitem") if lineitem is None else lineitem
    if consortium:
        items = with_region(spark, sf_dir, items)
    day = F.col("l_shipdate").cast("date")
    hours = (F.col("l_orderkey") % 24).cast("int")
    minutes = F.floor("l_quantity").cast("int")
    departure = F.col("l_shipdate") + F.make_dt_interval(hours=hours)
    given = {
        "data": day,
        "tipo_dia": F.col("l_linestatus") if clashing_day_type else _day_type(day),
        "id_empresa": F.col("l_returnflag"),
        "id_veiculo": F.col("l_partkey"),
        "id_viagem": _joined_text("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "servico": F.concat_ws(
            "-", F.col("l_suppkey").cast("string"), (F.col("l_orderkey") % LINES_PER_SUPPLIER).cast("string")
        ),
        "sentido": F.col("l_linestatus"),
        "datetime_partida": departure,
        "datetime_chegada": departure + F.make_dt_interval(mins=minutes),
        "tempo_viagem": minutes,
        "distancia_planejada": F.col("l_extendedprice") / 1000,
    }
    if consortium:
        given["consorcio"] = F.col("r_name")
    return _padded(items, "viagens_onibus", given)


def _hourly_mm(price: Column) -> Column:
    u = price / 500000
    return 80 * u * u * u * u * u * u


def rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in the ``clima_pluviometria`` contract."""
    hour = (F.col("o_orderkey") % 24).cast("string")
    return _padded(
        table(spark, sf_dir, "orders"),
        "clima_pluviometria",
        {
            "primary_key": F.col("o_orderkey"),
            "id_estacao": F.col("o_custkey") % STATIONS,
            "acumulado_chuva_1_h": _hourly_mm(F.col("o_totalprice")),
            "horario": F.concat(F.lpad(hour, 2, "0"), F.lit(":00:00")),
            "data_particao": F.col("o_orderdate").cast("date"),
        },
    )


def classified_rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rain at record grain with amount and class ready, several records per hour."""
    records = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("data_particao"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int")))
        .cast("timestamp")
        .alias("datetime_partida"),
        _hourly_mm(F.col("o_totalprice")).alias("chuva_1h_no_inicio"),
    )
    return records.withColumn("tipo_chuva", rain_band("chuva_1h_no_inicio"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations 0-24 in the ``estacoes_clima`` contract; ids 25-32 stay without master data."""
    return _padded(
        table(spark, sf_dir, "nation"),
        "estacoes_clima",
        {
            "id_estacao": F.col("n_nationkey"),
            "estacao": F.col("n_name"),
            "latitude": F.lit(-22.9) - F.col("n_regionkey") * 0.01,
            "longitude": F.lit(-43.2) - F.col("n_nationkey") * 0.01,
            "situacao": F.when(F.col("n_regionkey") == 0, "Nao operante").otherwise("Operante"),
        },
    )


def fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles in the ``licenciamento_frota`` contract, from the part table."""
    key = F.col("p_partkey")
    return _padded(
        table(spark, sf_dir, "part"),
        "licenciamento_frota",
        {
            "nome_chassi": F.col("p_name"),
            "id_chassi": key,
            "tecnologia": F.col("p_type"),
            "tipo_combustivel": F.when(F.col("p_size") > 25, "DIESEL").otherwise("ELETRICO"),
            "indicador_ar_condicionado": key % 2 == 0,
            "indicador_elevador": key % 3 == 0,
            "indicador_usb": key % 5 == 0,
            "indicador_wifi": F.col("p_size") % 2 == 1,
            "ano_ultima_vistoria": 2015 + F.col("p_size") % 10,
        },
    )
