"""The six business questions, as asked of the star, and their close variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rainroute.plans.silver import HOUR_KEY, hourly_rain, trip_attributes

# Lines need more trips than this to be ranked.
MIN_TRIPS = 50
# A relative change below this is "stable".
STABLE_BELOW = 0.05


def _largest_first(df: DataFrame, value: str, key: str) -> DataFrame:
    """Descending by value, NULL last, ties in key order."""
    return df.orderBy(F.desc_nulls_last(value), F.asc_nulls_last(key))


def _hours(fact: DataFrame) -> DataFrame:
    return fact.groupBy("hora_partida").agg(F.count(F.lit(1)).alias("total_viagens"))


def peak_hours(fact: DataFrame) -> DataFrame:
    """Trips per departure hour, busiest first."""
    return _largest_first(_hours(fact), "total_viagens", "hora_partida")


def weekend_supply(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Trips on working days and on weekends.

    Trips are counted per date before they meet the calendar, which gives the
    same sums as joining every trip (also where a date is listed twice) while
    only dates are shuffled.
    """
    per_day = fact.groupBy("data_id").agg(F.count("id_viagem").alias("viagens"))
    return (
        per_day.join(calendar.select("data_id", "desc_categoria_dia"), "data_id")
        .groupBy("desc_categoria_dia")
        .agg(F.sum("viagens").alias("volume_viagens"))
    )


def _mean_duration(fact: DataFrame, key: str, name: str) -> DataFrame:
    means = fact.groupBy(key).agg(F.avg("tempo_viagem").alias(name))
    return _largest_first(means, name, key)


def consortium_duration(fact: DataFrame) -> DataFrame:
    """Mean trip duration per consortium, longest first."""
    return _mean_duration(fact, "consorcio_id", "tempo_medio_minutos")


def _line_spread(fact: DataFrame, min_trips: int) -> DataFrame:
    return (
        fact.groupBy("linha")
        .agg(
            F.avg("tempo_viagem").alias("media_minutos"),
            F.stddev_samp("tempo_viagem").alias("desvio_padrao"),
            F.count(F.lit(1)).alias("__n"),
        )
        .filter(F.col("__n") > min_trips)
        .drop("__n")
    )


def line_unpredictability(fact: DataFrame, min_trips: int = MIN_TRIPS) -> DataFrame:
    """Mean and sample deviation of the duration per line with enough trips."""
    return _largest_first(_line_spread(fact, min_trips), "desvio_padrao", "linha")


def least_predictable_lines(fact: DataFrame, top: int = 15, min_trips: int = MIN_TRIPS) -> DataFrame:
    """The ``top`` lines by deviation, without sorting the others."""
    return _largest_first(_line_spread(fact, min_trips), "desvio_padrao", "linha").limit(top)


def rain_duration(fact: DataFrame) -> DataFrame:
    """Mean trip duration per rain band, longest first."""
    return _mean_duration(fact, "clima_id", "tempo_medio")


def rain_volume(fact: DataFrame) -> DataFrame:
    """Trips per rain band."""
    return fact.groupBy("clima_id").agg(F.count(F.lit(1)).alias("total_viagens"))


# --- The same questions taken literally --------------------------------------


def day_hour_volume(fact: DataFrame) -> DataFrame:
    """Trips per date and departure hour."""
    return fact.groupBy("data_id", "hora_partida").agg(F.count(F.lit(1)).alias("total_viagens"))


def _with_empty_hours(volume: DataFrame) -> DataFrame:
    """All 24 hours of every date that has trips, empty ones with 0.

    A date's hours are held in one map of at most 24 entries.
    """
    counted = F.map_from_entries(F.collect_list(F.struct("hora_partida", "total_viagens")))
    return (
        volume.groupBy("data_id")
        .agg(counted.alias("m"))
        .select("data_id", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hora_partida"), "m")
        .select(
            "data_id",
            "hora_partida",
            F.coalesce(F.try_element_at("m", F.col("hora_partida")), F.lit(0)).alias("total_viagens"),
        )
    )


def hour_change_class(
    fact: DataFrame, stable_below: float = STABLE_BELOW, fill_gaps: bool = False
) -> DataFrame:
    """Each hour against the previous one of its date: rise, fall or stable.

    The window runs over at most 24 counted rows per date. The first hour has no
    class; hours without trips are skipped unless ``fill_gaps``.
    """
    volume = day_hour_volume(fact.filter(F.col("hora_partida").isNotNull()))
    if fill_gaps:
        volume = _with_empty_hours(volume)
    previous = F.lag("total_viagens").over(Window.partitionBy("data_id").orderBy("hora_partida"))
    delta = F.col("total_viagens") - F.col("anterior")
    unchanged = (delta == 0) | (F.abs(delta) < F.lit(stable_below) * F.col("anterior"))
    return volume.withColumn("anterior", previous).withColumn(
        "variacao",
        F.when(F.col("anterior").isNull(), F.lit(None))
        .when(unchanged, "estavel")
        .when(delta > 0, "aumenta")
        .otherwise("diminui"),
    )


def hour_regime(fact: DataFrame, plateau_from: float, valley_below: float) -> DataFrame:
    """Label each hour by its share of the busiest hour: pico, plato, vale or transicao."""
    hours = _hours(fact.filter(F.col("hora_partida").isNotNull()))
    share = F.col("total_viagens") / F.max("total_viagens").over(Window.partitionBy())  # <= 24 rows
    regime = (
        F.when(F.col("fracao_do_pico") == 1, "pico")
        .when(F.col("fracao_do_pico") >= plateau_from, "plato")
        .when(F.col("fracao_do_pico") < valley_below, "vale")
        .otherwise("transicao")
    )
    return hours.withColumn("fracao_do_pico", share).withColumn("regime", regime)


def day_category_share(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Weekday and weekend volume with their percentage of all trips."""
    total = F.sum("volume_viagens").over(Window.partitionBy())  # two rows
    return weekend_supply(fact, calendar).withColumn("percentual", F.col("volume_viagens") * 100.0 / total)


def rainy_days(rain: DataFrame, threshold: float) -> DataFrame:
    """Date -> is its mean rain above the threshold?"""
    return rain.groupBy(F.col("data_particao").alias("data_id")).agg(
        F.coalesce(F.avg("acumulado_chuva_1_h") > threshold, F.lit(False)).alias("dia_chuvoso")
    )


def rainy_day_duration(fact: DataFrame, rain: DataFrame, threshold: float) -> DataFrame:
    """Mean duration and trips on rainy against dry days.

    Durations are summed per date first; only dates meet the rain. Days without
    readings count as dry.
    """
    per_day = fact.groupBy("data_id").agg(
        F.sum("tempo_viagem").alias("minutos"),
        F.count("tempo_viagem").alias("medidas"),
        F.count(F.lit(1)).alias("viagens"),
    )
    flagged = per_day.join(rainy_days(rain, threshold), "data_id", "left").withColumn(
        "dia_chuvoso", F.coalesce("dia_chuvoso", F.lit(False))
    )
    return flagged.groupBy("dia_chuvoso").agg(
        ratio(F.sum("minutos"), F.sum("medidas")).alias("tempo_medio"),
        F.sum("viagens").alias("total_viagens"),
    )


def consortium_pace(fact: DataFrame) -> DataFrame:
    """Minutes per planned kilometre by consortium, over trips that have both."""
    both = fact.filter(F.col("tempo_viagem").isNotNull() & F.col("distancia_planejada").isNotNull())
    return both.groupBy("consorcio_id").agg(
        ratio(F.sum("tempo_viagem"), F.sum("distancia_planejada")).alias("minutos_por_km"),
        F.count(F.lit(1)).alias("total_viagens"),
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator)


def unmatched_rain_share(trips: DataFrame, rain: DataFrame) -> DataFrame:
    """How many trips depart in an hour without any rain measurement (shown as 0 mm)."""
    per_hour = trip_attributes(trips).groupBy(*HOUR_KEY).agg(F.count(F.lit(1)).alias("n"))
    measured = hourly_rain(rain).select(
        F.col("data_particao").alias(HOUR_KEY[0]),
        F.col("hora_medicao").alias(HOUR_KEY[1]),
        F.col("avg_chuva_1h").alias("mm"),
    )
    joined = per_hour.join(measured, list(HOUR_KEY), "left")
    return joined.agg(
        F.sum("n").alias("total_viagens"),
        F.coalesce(F.sum(F.when(F.col("mm").isNull(), F.col("n"))), F.lit(0)).alias("sem_medicao"),
    )
