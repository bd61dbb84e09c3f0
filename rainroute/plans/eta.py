"""Arrival-time regression on the gold fact: trip duration from line history, hour and rain."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainroute.functions import is_weekend
from rainroute.operators.lookup import lookup_join
from rainroute.session import materialise

FEATURES = (
    "media_linha",
    "desvio_linha",
    "distancia_planejada",
    "chuva_no_horario",
    "hora_seno",
    "hora_cosseno",
    "fim_de_semana",
)
TARGET = "tempo_viagem"
#: Columns of the fact that histories, models and forecasts read.
COLUMNS = ("data_id", "linha", "hora_partida", "distancia_planejada", "chuva_no_horario", TARGET)
MODELS = ("media", "linear", "arvores")


def line_history(fact: DataFrame) -> DataFrame:
    """Mean and deviation of the duration per line (0 deviation for a single trip)."""
    return (
        fact.filter(F.col("linha").isNotNull())
        .groupBy("linha")
        .agg(
            F.avg(TARGET).alias("media_linha"),
            F.coalesce(F.stddev_samp(TARGET), F.lit(0.0)).alias("desvio_linha"),
        )
    )


def eta_features(fact: DataFrame, history: DataFrame) -> DataFrame:
    """Numeric features per trip; trips of lines without history are left out.

    ``history`` is written once, so the join knows its size. Lines enter as
    their history, not as one column each: the feature vector stays at seven.
    """
    known = materialise(history, "line_history")
    angle = F.col("hora_partida") * (2 * math.pi / 24)
    return lookup_join(fact, known, ["linha"], rows=known.count(), how="inner").select(
        TARGET,
        "media_linha",
        "desvio_linha",
        "distancia_planejada",
        "chuva_no_horario",
        F.sin(angle).alias("hora_seno"),
        F.cos(angle).alias("hora_cosseno"),
        is_weekend("data_id").cast("double").alias("fim_de_semana"),
    )


def _vectors(features: DataFrame) -> DataFrame:
    complete = features.dropna(subset=[*FEATURES])
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    return assembler.transform(complete.withColumn("label", F.col(TARGET).cast("double")))


def fit(features: DataFrame) -> LinearRegressionModel:
    """Least squares by the normal equations: one pass, a 7x7 matrix reaches the driver."""
    return LinearRegression(solver="normal").fit(_vectors(features.dropna(subset=[TARGET])))


def predict(model: LinearRegressionModel, features: DataFrame) -> DataFrame:
    return model.transform(_vectors(features)).drop("features", "label").withColumnRenamed(
        "prediction", "tempo_previsto"
    )


def fit_trees(features: DataFrame, rounds: int = 10, depth: int = 4) -> GBTRegressionModel:
    """Boosted trees: each round one distributed tree over binned features; only split statistics reach the driver."""
    trees = GBTRegressor(maxIter=rounds, maxDepth=depth, seed=7)
    return trees.fit(_vectors(features.dropna(subset=[TARGET])))


def walk_forward(fact: DataFrame, cuts: Sequence[date], models: Sequence[str] = MODELS) -> DataFrame:
    """Forecasts made as time went on: corte, modelo, tempo_viagem, tempo_previsto.

    For each cut date, line history and models are made from trips before it, and forecast the trips from it until
    the next cut (after the last one: all). No trip is forecast from itself or from a later one. Trips of lines without
    history, or with a missing feature, are left out of every model alike.
    """
    parts = []
    for cut, until in zip(cuts, [*cuts[1:], None], strict=True):
        day = F.col("data_id")
        known = fact.filter(day < F.lit(cut))
        asked = fact.filter((day >= F.lit(cut)) if until is None else ((day >= F.lit(cut)) & (day < F.lit(until))))
        history = materialise(line_history(known), "line_history")
        before = materialise(eta_features(known, history), "eta_before")
        after = materialise(eta_features(asked, history).dropna(subset=[*FEATURES]), "eta_after")
        forecast = after.withColumn("media", F.col("media_linha")) if "media" in models else after
        for name, train in (("linear", fit), ("arvores", fit_trees)):
            if name in models:
                forecast = predict(train(before), forecast).withColumnRenamed("tempo_previsto", name)
        each = F.explode(F.array(*[F.struct(F.lit(m).alias("modelo"), F.col(m).alias("tempo_previsto")) for m in models]))
        parts.append(forecast.select(F.lit(cut).alias("corte"), TARGET, each.alias("each")))
    return reduce(DataFrame.unionAll, parts).select("corte", "each.modelo", TARGET, "each.tempo_previsto")


def errors(predicted: DataFrame, *by: str) -> DataFrame:
    """Mean absolute and root mean square error in minutes."""
    miss = F.col("tempo_previsto") - F.col(TARGET)
    return predicted.groupBy(*by).agg(
        F.count(TARGET).alias("viagens"),
        F.avg(F.abs(miss)).alias("erro_absoluto_medio"),
        F.sqrt(F.avg(miss * miss)).alias("raiz_erro_quadratico"),
    )
