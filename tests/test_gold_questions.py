from datetime import date

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rainroute.plans import eta, fleet, gold, questions, rain_stations, silver
from rainroute.sources import proxy

MON, SUN = date(2024, 3, 25), date(2024, 3, 24)


@pytest.fixture(scope="module")
def wide(spark, tiny):
    kept = silver.silver_trips(proxy.trips(spark, tiny), proxy.rain(spark, tiny)).cache()
    yield kept
    kept.unpersist()  # else plans of later tests would read it from memory


def fact_frame(spark, *records, schema="linha string, tempo_viagem int"):
    return spark.createDataFrame(list(records), schema)


def silver_days(spark, *days):
    return spark.createDataFrame(list(days), "data_viagem date, is_weekend boolean, tipo_dia string, id_viagem string")


def test_dimensions_list_every_member_once_null_included(spark):
    df = spark.createDataFrame([("A",), ("A",), (None,), ("B",)], "consorcio string")
    assert rows(gold.dim_consortium(df)) == [(None, None), ("A", "A"), ("B", "B")]


def test_calendar_columns(spark):
    got = gold.dim_calendar(silver_days(spark, (SUN, True, "Domingo", "1"), (SUN, True, "Domingo", "2")))
    assert got.columns == ["data_id", "dia", "mes", "ano", "desc_categoria_dia", "desc_sazonalidade"]
    assert rows(got) == [(SUN, 24, 3, 2024, "Final de Semana", "Domingo")]


def test_two_day_types_on_a_date_double_the_weekend_count(spark):
    base = silver_days(
        spark, (SUN, True, "Domingo", "1"), (SUN, True, "Ponto Facultativo", "2"), (MON, False, "Dia Útil", "3"),
        (MON, False, "Dia Útil", None),
    )
    calendar = gold.dim_calendar(base)
    assert calendar.filter(F.col("data_id") == SUN).count() == 2
    fact = gold.fact_trips(base)
    got = rows(questions.weekend_supply(fact, calendar))
    assert got == [("Dia Útil", 1), ("Final de Semana", 4)]
    joined = fact.join(calendar, "data_id").groupBy("desc_categoria_dia").agg(F.count("id_viagem"))
    assert rows(joined) == got
    shares = rows(questions.day_category_share(fact, calendar), "desc_categoria_dia", "percentual")
    assert shares == [("Dia Útil", 20.0), ("Final de Semana", 80.0)]


def test_fact_is_a_projection_of_silver(wide):
    fact = gold.fact_trips(wide)
    assert fact.columns == list(gold.FACT_COLUMNS)
    assert fact.count() == wide.count()
    assert "Exchange" not in plan(gold.fact_trips(wide)).split("InMemoryRelation")[0]


def test_sums_agree_across_questions(wide):
    fact, calendar = gold.fact_trips(wide), gold.dim_calendar(wide)
    total = fact.count()
    add = lambda df, c: df.agg(F.sum(c)).first()[0]
    assert add(questions.peak_hours(fact), "total_viagens") == total
    assert add(questions.rain_volume(fact), "total_viagens") == total
    assert add(questions.weekend_supply(fact, calendar), "volume_viagens") == total


def test_questions_are_ordered_largest_first_with_ties_by_key(spark):
    fact = fact_frame(spark, (6,), (6,), (7,), (5,), (None,), schema="hora_partida int")
    assert [tuple(r) for r in questions.peak_hours(fact).collect()] == [(6, 2), (5, 1), (7, 1), (None, 1)]
    pairs = fact_frame(spark, ("A", 10), ("B", 30), ("C", None), schema="consorcio_id string, tempo_viagem int")
    assert [tuple(r) for r in questions.consortium_duration(pairs).collect()] == [("B", 30.0), ("A", 10.0), ("C", None)]


def test_lines_need_more_than_fifty_trips(spark):
    records = [("fifty", i) for i in range(50)] + [("fifty-one", i) for i in range(51)]
    got = questions.line_unpredictability(fact_frame(spark, *records)).collect()
    assert [r["linha"] for r in got] == ["fifty-one"]
    assert got[0]["media_minutos"] == 25.0
    assert abs(got[0]["desvio_padrao"] - 14.866068747318506) < 1e-9
    assert got[0].asDict().keys() == {"linha", "media_minutos", "desvio_padrao"}


def test_one_trip_has_no_deviation(spark):
    got = questions.line_unpredictability(fact_frame(spark, ("a", 5), ("b", 1), ("b", 3)), min_trips=0).collect()
    assert [(r["linha"], r["desvio_padrao"]) for r in got][1] == ("a", None)


def test_top_lines_do_not_sort_everything(wide):
    top = questions.least_predictable_lines(gold.fact_trips(wide), top=15)
    assert "TakeOrderedAndProject" in plan(top)
    every = questions.line_unpredictability(gold.fact_trips(wide)).collect()
    assert top.collect() == every[:15]


def hour_counts(spark, counts, day=MON):
    records = [(day, hour) for hour, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(records, "data_id date, hora_partida int")


def test_hour_change_below_five_percent_is_stable(spark):
    fact = hour_counts(spark, {0: 100, 1: 104, 2: 105, 3: 200, 4: 190})
    got = questions.hour_change_class(fact).orderBy("hora_partida").collect()
    assert [r["variacao"] for r in got] == [None, "estavel", "estavel", "aumenta", "diminui"]
    exact = questions.hour_change_class(hour_counts(spark, {0: 100, 1: 105, 2: 105})).orderBy("hora_partida")
    assert [r["variacao"] for r in exact.collect()] == [None, "aumenta", "estavel"]


def test_missing_hours_are_skipped_unless_filled(spark):
    fact = hour_counts(spark, {5: 2, 8: 2})
    assert questions.hour_change_class(fact).count() == 2
    filled = questions.hour_change_class(fact, fill_gaps=True).orderBy("hora_partida").collect()
    assert len(filled) == 24
    assert [filled[h]["variacao"] for h in (0, 1, 5, 6, 7, 8)] == [
        None, "estavel", "aumenta", "diminui", "estavel", "aumenta"]


def test_hour_regime(spark):
    got = questions.hour_regime(hour_counts(spark, {6: 20, 9: 16, 12: 8, 2: 1}), 0.75, 0.1)
    assert rows(got, "hora_partida", "regime") == [(12, "transicao"), (2, "vale"), (6, "pico"), (9, "plato")]


def test_rainy_days(spark):
    fact = fact_frame(
        spark, (MON, 10), (MON, 20), (SUN, 50), (date(2024, 3, 26), 30), (MON, None),
        schema="data_id date, tempo_viagem int",
    )
    rain = spark.createDataFrame(
        [(MON, 0.0), (MON, 0.1), (SUN, 3.0), (SUN, None)], "data_particao date, acumulado_chuva_1_h double"
    )
    got = rows(questions.rainy_day_duration(fact, rain, 0.1))
    assert got == [(False, 20.0, 4), (True, 50.0, 1)]


def test_pace_ignores_incomplete_trips_and_zero_distance(spark):
    fact = fact_frame(
        spark, ("A", 30, 10.0), ("A", 30, 20.0), ("A", None, 5.0), ("B", 10, 0.0),
        schema="consorcio_id string, tempo_viagem int, distancia_planejada double",
    )
    assert rows(questions.consortium_pace(fact)) == [("A", 2.0, 2), ("B", None, 1)]


def test_rain_by_station_keeps_unknown_stations(spark, tiny):
    got = rain_stations.rain_by_station(proxy.rain(spark, tiny), proxy.stations(spark, tiny))
    assert got.count() == 33
    assert got.filter(F.col("estacao").isNull()).count() == 8


def test_station_listed_twice_does_not_multiply_readings(spark):
    rain = spark.createDataFrame([("1", 2.0), ("1", 4.0)], "id_estacao string, acumulado_chuva_1_h double")
    stations = spark.createDataFrame(
        [("1", None, "old", "x"), ("1", date(2024, 1, 1), "new", "y")],
        "id_estacao string, data_atualizacao date, estacao string, situacao string",
    )
    got = rain_stations.rain_by_station(rain, stations)
    assert rows(got, "id_estacao", "leituras", "media_chuva_1h", "estacao") == [("1", 2, 3.0, "new")]


def test_fleet_profile(spark):
    schema = (
        "tecnologia string, tipo_combustivel string, indicador_ar_condicionado boolean, indicador_elevador boolean, "
        "indicador_usb boolean, indicador_wifi boolean, ano_ultima_vistoria bigint"
    )
    df = spark.createDataFrame(
        [("PADRON", "DIESEL", True, True, False, None, 2023), ("PADRON", "DIESEL", False, True, False, True, 2021)],
        schema,
    )
    assert rows(fleet.fleet_profile(df, 2025)) == [("PADRON", "DIESEL", 2, 0.5, 1.0, 0.0, 1.0, 3.0)]


def test_regression_equals_least_squares(spark, wide):
    import numpy as np

    fact = gold.fact_trips(wide)
    features = eta.eta_features(fact, eta.line_history(fact)).cache()
    model = eta.fit(features)
    table = np.array([[float(r[c]) for c in (*eta.FEATURES, eta.TARGET)] for r in features.collect()])
    design = np.column_stack([table[:, :-1], np.ones(len(table))])
    solved, *_ = np.linalg.lstsq(design, table[:, -1], rcond=None)
    assert np.allclose([*model.coefficients, model.intercept], solved, atol=1e-6)
    report = eta.errors(eta.predict(model, features)).first()
    assert report["viagens"] == fact.count()
    assert abs(report["raiz_erro_quadratico"] - np.sqrt(np.mean((design @ solved - table[:, -1]) ** 2))) < 1e-6
    features.unpersist()


def test_forecasts_know_only_what_came_before(spark, wide):
    """Errors recomputed trip by trip from plain rows."""
    import math
    from collections import defaultdict

    fact = gold.fact_trips(wide)
    cuts = [date(1996, 1, 1), date(1997, 6, 1)]
    forecasts = eta.walk_forward(fact, cuts)
    trips = [(r.data_id, r.linha, r.tempo_viagem) for r in fact.select("data_id", "linha", "tempo_viagem").collect()]
    got = {(r.corte, r.modelo): r for r in eta.errors(forecasts, "corte", "modelo").collect()}
    assert set(got) == {(c, m) for c in cuts for m in eta.MODELS}
    for cut, until in zip(cuts, [cuts[1], date.max], strict=True):
        seen = defaultdict(list)
        for day, line, minutes in trips:
            if day < cut:
                seen[line].append(minutes)
        misses = [sum(seen[line]) / len(seen[line]) - m for day, line, m in trips if cut <= day < until and line in seen]
        row = got[cut, "media"]
        assert row.viagens == len(misses) == got[cut, "linear"].viagens == got[cut, "arvores"].viagens
        assert math.isclose(row.erro_absoluto_medio, sum(map(abs, misses)) / len(misses), abs_tol=1e-9)
        assert math.isclose(row.raiz_erro_quadratico, math.sqrt(sum(x * x for x in misses) / len(misses)), abs_tol=1e-9)
        for model in ("linear", "arvores"):  # the error table follows from the forecasts
            pairs = [(r.tempo_viagem, r.tempo_previsto) for r in forecasts.where((F.col("corte") == F.lit(cut)) & (F.col("modelo") == model)).collect()]
            assert math.isclose(got[cut, model].erro_absoluto_medio, sum(abs(a - b) for a, b in pairs) / len(pairs), abs_tol=1e-9)


def test_forecasts_write_what_they_read_and_read_a_cut_once(spark, tiny):
    from conftest import plan

    from rainroute.checks import registry

    fact = registry._eta_fact(spark, tiny)
    assert tuple(fact.columns) == eta.COLUMNS
    forecasts = eta.walk_forward(fact, [date(1996, 1, 1), date(1997, 1, 1)], ["linear", "media"])
    assert sum("Location" in line and "eta_after" in line for line in plan(forecasts).splitlines()) == 2
    assert forecasts.columns == ["corte", "modelo", "tempo_viagem", "tempo_previsto"]
    assert {r.modelo for r in forecasts.select("modelo").distinct().collect()} == {"linear", "media"}


def test_trees_learn_what_a_line_cannot(spark):
    """Durations that jump at an hour: trees see it, least squares over sine and cosine of the hour less well."""
    n = F.col("id")
    fact = spark.range(4000).select(
        F.date_add(F.lit(date(2024, 1, 1)), (n / 100).cast("int")).alias("data_id"), F.lit("L").alias("linha"),
        F.pmod(n, F.lit(24)).cast("int").alias("hora_partida"), F.lit(1.0).alias("distancia_planejada"), F.lit(0.0).alias("chuva_no_horario"),
        F.when(F.pmod(n, F.lit(24)).isin(7, 8, 17), 60).otherwise(20).alias("tempo_viagem"),
    )
    found = {r.modelo: r.erro_absoluto_medio for r in eta.errors(eta.walk_forward(fact, [date(2024, 1, 25)]), "modelo").collect()}
    assert found["arvores"] < 0.5 * found["linear"] and found["arvores"] < 0.5 * found["media"]
