"""DuckDB SQL with the same results as the registered queries.

Written from the definitions, not from the Spark plans: every statement goes the
whole way from the raw tables (all columns, the rain join, the star) even where
the Spark query can leave a step out.
"""

from __future__ import annotations

_TRIPS = """
trips AS (
    SELECT CAST(l_shipdate AS DATE) AS data,
           r_name AS consorcio,
           CASE dayofweek(l_shipdate) WHEN 0 THEN 'Domingo' WHEN 6 THEN 'Sábado' ELSE 'Dia Útil' END AS tipo_dia,
           l_returnflag AS id_empresa,
           CAST(l_partkey AS VARCHAR) AS id_veiculo,
           l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id_viagem,
           l_suppkey || '-' || (l_orderkey % 12) AS servico,
           l_linestatus AS sentido,
           l_shipdate + to_hours(l_orderkey % 24) AS datetime_partida,
           CAST(floor(l_quantity) AS INTEGER) AS tempo_viagem,
           l_extendedprice / 1000 AS distancia_planejada
    FROM lineitem
    LEFT JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN nation ON n_nationkey = s_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
)"""
_TRIPS_CLASH = _TRIPS.replace(
    "CASE dayofweek(l_shipdate) WHEN 0 THEN 'Domingo' WHEN 6 THEN 'Sábado' ELSE 'Dia Útil' END AS tipo_dia",
    "l_linestatus AS tipo_dia",
)
_MM = "80 * " + " * ".join(["(o_totalprice / 500000)"] * 6)
_RAIN = f"""
rain AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS primary_key,
           CAST(o_custkey % 33 AS VARCHAR) AS id_estacao,
           {_MM} AS mm,
           CAST(o_orderkey % 24 AS INTEGER) AS hora,
           CAST(o_orderdate AS DATE) AS dia
    FROM orders
)"""
_HOURLY = """
hourly AS (SELECT dia, hora, avg(mm) AS mm FROM rain GROUP BY ALL)"""


# Limits and labels of the rain bands.
def _bands(mm: str) -> str:
    return (
        f"CASE WHEN {mm} >= 0.1 AND {mm} <= 5 THEN 'Fraca' WHEN {mm} >= 5 AND {mm} <= 25 THEN 'Moderada' "
        f"WHEN {mm} >= 25.1 AND {mm} <= 50 THEN 'Forte' WHEN {mm} > 50 THEN 'Muito Forte' ELSE 'Sem Chuva' END"
    )


_GAP_FREE = (
    "CASE WHEN mm > 50 THEN 'Muito Forte' WHEN mm > 25 THEN 'Forte' WHEN mm > 5 THEN 'Moderada' "
    "WHEN mm >= 0.1 THEN 'Fraca' ELSE 'Sem Chuva' END"
)


def _silver(band: str) -> str:
    return f"""
silver AS (
    SELECT t.data AS data_viagem, id_viagem, servico AS linha, consorcio, tipo_dia,
           distancia_planejada, tempo_viagem, CAST(hour(datetime_partida) AS INTEGER) AS hora_partida,
           coalesce(dayofweek(t.data) IN (0, 6), false) AS is_weekend,
           coalesce(mm, 0) AS chuva_no_horario, {band} AS condicao_clima
    FROM trips t LEFT JOIN hourly h ON h.dia = t.data AND h.hora = hour(t.datetime_partida)
)"""


_CALENDAR = """
calendar AS (
    SELECT DISTINCT data_viagem AS data_id, CAST(day(data_viagem) AS INTEGER) AS dia,
           CAST(month(data_viagem) AS INTEGER) AS mes, CAST(year(data_viagem) AS INTEGER) AS ano,
           if(is_weekend, 'Final de Semana', 'Dia Útil') AS desc_categoria_dia,
           tipo_dia AS desc_sazonalidade
    FROM silver
)"""
_VOLUME = """
volume AS (SELECT data_viagem AS data_id, hora_partida, count(*) AS total_viagens FROM silver GROUP BY ALL)"""
_SUPPLY = """
supply AS (
    SELECT desc_categoria_dia, count(id_viagem) AS volume_viagens
    FROM silver JOIN calendar ON data_id = data_viagem GROUP BY desc_categoria_dia
)"""
_SPREAD = """
spread AS (
    SELECT linha, round(avg(tempo_viagem), 6) AS media_minutos,
           round(stddev_samp(tempo_viagem), 6) AS desvio_padrao, stddev_samp(tempo_viagem) AS exact
    FROM silver GROUP BY linha HAVING count(*) > 50
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _on_silver(select: str, *extra: str, trips: str = _TRIPS, band: str | None = None) -> str:
    return _with(trips, _RAIN, _HOURLY, _silver(band or _bands("mm")), *extra, select=select)


def _change(volume: str) -> str:
    return f"""
SELECT data_id, hora_partida, total_viagens, anterior,
       CASE WHEN anterior IS NULL THEN NULL
            WHEN total_viagens = anterior OR abs(total_viagens - anterior) < 0.05 * anterior THEN 'estavel'
            WHEN total_viagens > anterior THEN 'aumenta' ELSE 'diminui' END AS variacao
FROM (SELECT *, lag(total_viagens) OVER (PARTITION BY data_id ORDER BY hora_partida) AS anterior FROM {volume})"""


def _text_profile(column: str, distinct: bool) -> str:
    distinct_sql = f"count(DISTINCT {column})" if distinct else "CAST(NULL AS BIGINT)"
    return (
        f"SELECT '{column}' AS coluna, count(*) AS linhas, count(*) - count({column}) AS nulos, "
        f"{distinct_sql} AS distintos, CAST(min({column}) AS VARCHAR) AS minimo, "
        f"CAST(max({column}) AS VARCHAR) AS maximo FROM trips"
    )


def _orphans(dim: str, key: str, column: str) -> str:
    return f"""
SELECT '{dim}: chave repetida' AS verificacao,
       (SELECT count(*) FROM (SELECT {key} FROM {dim} GROUP BY {key} HAVING count(*) > 1)) AS violacoes
UNION ALL
SELECT '{dim}: fato sem dimensao',
       (SELECT count(*) FROM silver s WHERE {column} IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = s.{column}))
UNION ALL
SELECT '{dim}: chave nula no fato', (SELECT count(*) FROM silver WHERE {column} IS NULL)"""


_DIMS = (
    _CALENDAR.replace("calendar AS", "dim_calendario AS"),
    "\ndim_consorcio AS (SELECT DISTINCT consorcio AS consorcio_id, consorcio AS nome_consorcio FROM silver)",
    "\ndim_clima AS (SELECT DISTINCT condicao_clima AS clima_id, condicao_clima AS desc_intensidade FROM silver)",
)


def _null_columns(**columns: str) -> str:
    return ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in columns.items())


def _tested(rule: str, condition: str) -> str:
    return (
        f"SELECT '{rule}' AS regra, count(*) AS linhas, "
        f"count(*) FILTER (WHERE ({condition}) IS NOT TRUE) AS falhas, "
        f"count(*) FILTER (WHERE ({condition}) IS NOT TRUE) = 0 AS aprovada FROM silver"
    )


ORACLE: dict[str, str] = {
    "bronze_trips": _with(
        _TRIPS,
        select="SELECT data, consorcio, tipo_dia, id_empresa, id_veiculo, id_viagem, servico, sentido, "
        "datetime_partida, datetime_partida + to_minutes(tempo_viagem) AS datetime_chegada, tempo_viagem, "
        "distancia_planejada, "
        + _null_columns(
            shape_id="VARCHAR",
            perc_conformidade_shape="DOUBLE",
            perc_conformidade_registros="DOUBLE",
            versao_modelo="VARCHAR",
        )
        + " FROM trips",
    ),
    "bronze_rain": _with(
        _RAIN,
        select="SELECT primary_key, id_estacao, round(mm, 6) AS acumulado_chuva_1_h, "
        "lpad(CAST(hora AS VARCHAR), 2, '0') || ':00:00' AS horario, dia AS data_particao, "
        + _null_columns(
            acumulado_chuva_15_min="DOUBLE",
            acumulado_chuva_4_h="DOUBLE",
            acumulado_chuva_24_h="DOUBLE",
            acumulado_chuva_96_h="DOUBLE",
        )
        + " FROM rain",
    ),
    "bronze_stations": "SELECT CAST(n_nationkey AS VARCHAR) AS id_estacao, n_name AS estacao, "
    "CAST(-22.9 AS DOUBLE) - n_regionkey * CAST(0.01 AS DOUBLE) AS latitude, "
    "CAST(-43.2 AS DOUBLE) - n_nationkey * CAST(0.01 AS DOUBLE) AS longitude, "
    "if(n_regionkey = 0, 'Nao operante', 'Operante') AS situacao, "
    + _null_columns(
        cota="DOUBLE",
        x="DOUBLE",
        y="DOUBLE",
        endereco="VARCHAR",
        data_inicio_operacao="TIMESTAMP",
        data_fim_operacao="TIMESTAMP",
        data_atualizacao="TIMESTAMP",
    )
    + " FROM nation",
    "rain_hourly": _with(
        _RAIN,
        _HOURLY,
        select="SELECT dia AS data_particao, hora AS hora_medicao, round(mm, 6) AS avg_chuva_1h FROM hourly",
    ),
    "silver_trips": _on_silver("SELECT * REPLACE (round(chuva_no_horario, 6) AS chuva_no_horario) FROM silver"),
    "silver_trips_preclassified": _with(
        _TRIPS,
        _RAIN,
        "\nheaviest AS (SELECT dia, hora, max(mm) AS mm FROM rain GROUP BY ALL)",
        select=f"""SELECT t.data AS data_viagem, id_viagem, servico, consorcio, tipo_dia,
       CAST(hour(datetime_partida) AS INTEGER) AS hora_partida,
       coalesce(dayofweek(t.data) IN (0, 6), false) AS is_weekend, tempo_viagem, distancia_planejada,
       round(coalesce(mm, 0), 6) AS chuva_no_horario, {_bands("mm")} AS condicao_clima
FROM trips t LEFT JOIN heaviest h ON h.dia = t.data AND h.hora = hour(t.datetime_partida)""",
    ),
    "rain_band_contiguous": _on_silver(
        "SELECT condicao_clima AS clima_id, count(*) AS total_viagens FROM silver GROUP BY ALL", band=_GAP_FREE
    ),
    "rain_unmatched": _with(
        _TRIPS,
        _RAIN,
        _HOURLY,
        select="SELECT count(*) AS total_viagens, count(*) FILTER (WHERE mm IS NULL) AS sem_medicao "
        "FROM trips t LEFT JOIN hourly h ON h.dia = t.data AND h.hora = hour(t.datetime_partida)",
    ),
    "dim_calendar": _on_silver("SELECT * FROM calendar", _CALENDAR),
    "dim_calendar_clash": _on_silver("SELECT * FROM calendar", _CALENDAR, trips=_TRIPS_CLASH),
    "dim_consortium": _on_silver("SELECT * FROM dim_consorcio", _DIMS[1]),
    "dim_weather": _on_silver("SELECT * FROM dim_clima", _DIMS[2]),
    "fact_trips": _on_silver(
        "SELECT id_viagem, data_viagem AS data_id, consorcio AS consorcio_id, condicao_clima AS clima_id, "
        "linha, hora_partida, tempo_viagem, distancia_planejada, round(chuva_no_horario, 6) AS chuva_no_horario "
        "FROM silver"
    ),
    "q1_peak_hours": _on_silver("SELECT hora_partida, count(*) AS total_viagens FROM silver GROUP BY 1"),
    "q2_weekend_supply": _on_silver("SELECT * FROM supply", _CALENDAR, _SUPPLY),
    "q2_weekend_supply_clash": _on_silver("SELECT * FROM supply", _CALENDAR, _SUPPLY, trips=_TRIPS_CLASH),
    "q3_consortium_duration": _on_silver(
        "SELECT consorcio AS consorcio_id, round(avg(tempo_viagem), 6) AS tempo_medio_minutos "
        "FROM silver GROUP BY 1"
    ),
    "q4_line_unpredictability": _on_silver("SELECT * EXCLUDE (exact) FROM spread", _SPREAD),
    "q5_rain_duration": _on_silver(
        "SELECT condicao_clima AS clima_id, round(avg(tempo_viagem), 6) AS tempo_medio FROM silver GROUP BY 1"
    ),
    "q6_rain_volume": _on_silver(
        "SELECT condicao_clima AS clima_id, count(*) AS total_viagens FROM silver GROUP BY 1"
    ),
    "top15_lines": _on_silver(
        "SELECT * EXCLUDE (exact) FROM spread ORDER BY exact DESC NULLS LAST, linha LIMIT 15", _SPREAD
    ),
    "day_hour_volume": _on_silver("SELECT * FROM volume", _VOLUME),
    "hour_change_class": _on_silver(_change("volume"), _VOLUME),
    "hour_change_class_filled": _on_silver(
        _change("filled"),
        _VOLUME,
        "\nfilled AS (SELECT d.data_id, h.hora_partida, coalesce(total_viagens, 0) AS total_viagens "
        "FROM (SELECT DISTINCT data_id FROM volume) d "
        "CROSS JOIN (SELECT CAST(range AS INTEGER) AS hora_partida FROM range(24)) h "
        "LEFT JOIN volume v ON v.data_id = d.data_id AND v.hora_partida = h.hora_partida)",
    ),
    "hour_regime": _on_silver(
        "SELECT hora_partida, total_viagens, round(fraction, 6) AS fracao_do_pico, "
        "CASE WHEN fraction = 1 THEN 'pico' WHEN fraction >= 0.99 THEN 'plato' "
        "WHEN fraction < 0.95 THEN 'vale' ELSE 'transicao' END AS regime "
        "FROM (SELECT hora_partida, count(*) AS total_viagens, "
        "CAST(count(*) AS DOUBLE) / max(count(*)) OVER () AS fraction FROM silver GROUP BY 1)"
    ),
    "day_category_share": _on_silver(
        "SELECT *, round(volume_viagens * 100.0 / sum(volume_viagens) OVER (), 6) AS percentual FROM supply",
        _CALENDAR,
        _SUPPLY,
    ),
    "rainy_day_duration": _on_silver(
        "SELECT coalesce(d.mm > 5.0, false) AS dia_chuvoso, round(avg(tempo_viagem), 6) AS tempo_medio, "
        "count(*) AS total_viagens FROM silver LEFT JOIN daily d ON d.dia = data_viagem GROUP BY 1",
        "\ndaily AS (SELECT dia, avg(mm) AS mm FROM rain GROUP BY dia)",
    ),
    "consortium_pace": _on_silver(
        "SELECT consorcio AS consorcio_id, round(sum(tempo_viagem) / sum(distancia_planejada), 6) "
        "AS minutos_por_km, count(*) AS total_viagens FROM silver GROUP BY 1"
    ),
    "rain_by_station": _with(
        _RAIN,
        select="SELECT id_estacao, count(*) AS leituras, round(avg(mm), 6) AS media_chuva_1h, "
        "round(max(mm), 6) AS maior_chuva_1h, any_value(n_name) AS estacao, "
        "any_value(CASE n_regionkey WHEN 0 THEN 'Nao operante' ELSE if(n_name IS NULL, NULL, 'Operante') END) "
        "AS situacao FROM rain LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = id_estacao GROUP BY id_estacao",
    ),
    "fleet_profile": """
SELECT p_type AS tecnologia, if(p_size > 25, 'DIESEL', 'ELETRICO') AS tipo_combustivel, count(*) AS veiculos,
       round(avg(if(p_partkey % 2 = 0, 1, 0)), 6) AS fracao_ar_condicionado,
       round(avg(if(p_partkey % 3 = 0, 1, 0)), 6) AS fracao_elevador,
       round(avg(if(p_partkey % 5 = 0, 1, 0)), 6) AS fracao_usb,
       round(avg(if(p_size % 2 = 1, 1, 0)), 6) AS fracao_wifi,
       round(avg(2025 - (2015 + p_size % 10)), 6) AS anos_desde_vistoria
FROM part GROUP BY 1, 2""",
    "trip_dedup": """
SELECT * EXCLUDE (place) FROM (
    SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS data, l_partkey, l_suppkey,
           l_quantity, l_extendedprice,
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CAST(l_shipdate AS DATE) DESC,
               l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS place
    FROM lineitem)
WHERE place = 1""",
    "duration_range_filter": _on_silver(
        "SELECT id_viagem, linha, tempo_viagem FROM silver WHERE coalesce(tempo_viagem BETWEEN 3 AND 45, true)"
    ),
    "duration_outlier_filter": _on_silver(
        "SELECT id_viagem, linha, tempo_viagem FROM silver LEFT JOIN fences USING (linha) "
        "WHERE coalesce(tempo_viagem BETWEEN low AND high, true)",
        "\nfences AS (SELECT linha, quantile_cont(CAST(tempo_viagem AS DOUBLE), 0.05) AS low, "
        "quantile_cont(CAST(tempo_viagem AS DOUBLE), 0.95) AS high FROM silver GROUP BY linha)",
    ),
    "consortium_normalise": _with(
        _TRIPS,
        select="SELECT if(consorcio = 'MIDDLE EAST', 'ORIENTE MEDIO', consorcio) AS consorcio, "
        "count(*) AS total_viagens FROM trips GROUP BY 1",
    ),
    "scope_filter": _on_silver(
        "SELECT id_viagem, data_viagem AS data_id, hora_partida, tempo_viagem FROM silver "
        "WHERE data_viagem BETWEEN DATE '1997-01-01' AND DATE '1998-08-24'"
    ),
    "column_profile": "WITH"
    + _TRIPS.replace(
        "l_linestatus AS sentido", "l_linestatus AS sentido, CAST(NULL AS VARCHAR) AS shape_id"
    )
    + "\n"
    + "\nUNION ALL ".join(
        _text_profile(c, c in ("consorcio", "tipo_dia", "servico", "shape_id"))
        for c in ("data", "consorcio", "tipo_dia", "id_viagem", "servico", "shape_id", "tempo_viagem")
    ),
    "category_counts": _with(
        _TRIPS,
        select="\nUNION ALL ".join(
            f"SELECT '{c}' AS coluna, {v} AS valor, count(*) AS linhas FROM trips GROUP BY 2"
            for c, v in (
                ("consorcio", "consorcio"),
                ("tipo_dia", "tipo_dia"),
                ("sentido", "sentido"),
                ("shape_id", "CAST(NULL AS VARCHAR)"),
            )
        ),
    ),
    "star_integrity": _on_silver(
        _orphans("dim_calendario", "data_id", "data_viagem")
        + "\nUNION ALL"
        + _orphans("dim_consorcio", "consorcio_id", "consorcio")
        + "\nUNION ALL"
        + _orphans("dim_clima", "clima_id", "condicao_clima")
        + "\nUNION ALL SELECT 'fato x silver: diferenca de linhas', "
        "abs((SELECT count(*) FROM silver) - (SELECT count(*) FROM lineitem))",
        *_DIMS,
        trips=_TRIPS_CLASH,
    ),
    "schema_drift": """
SELECT 'versao_modelo' AS coluna, 'missing' AS situacao, CAST(0 AS BIGINT) AS celulas
UNION ALL SELECT 'l_tax', 'added', 0
UNION ALL SELECT 'l_returnflag', 'changed', count(l_returnflag) FROM lineitem
UNION ALL SELECT 'l_shipdate', 'changed', count(*) FROM lineitem WHERE l_linenumber = 3""",
    "layer_expectations": _on_silver(
        "\nUNION ALL ".join(
            _tested(rule, condition)
            for rule, condition in (
                ("id_viagem presente", "id_viagem IS NOT NULL"),
                ("hora entre 0 e 23", "hora_partida BETWEEN 0 AND 23"),
                ("duracao ate 45", "tempo_viagem BETWEEN 1 AND 45"),
                ("consorcio conhecido", "consorcio <> 'ASIA'"),
            )
        )
    ),
    "lineage_by_file": "SELECT 'lineitem.parquet' AS arquivo, count(*) AS linhas FROM lineitem",
}
_KEPT = "silver.hora_partida <> 3"
ORACLE["star_integrity_planted"] = _on_silver(
    "SELECT * FROM (VALUES ('dim_calendario: chave repetida', CAST(0 AS BIGINT)), ('dim_calendario: fato sem dimensao', 0), "
    "('dim_calendario: chave nula no fato', 0), ('dim_consorcio: chave repetida', 0), ('dim_consorcio: chave nula no fato', 0), "
    "('dim_clima: fato sem dimensao', 0), ('dim_clima: chave nula no fato', 0)) t(verificacao, violacoes)\n"
    f"UNION ALL SELECT 'dim_consorcio: fato sem dimensao', count(*) FROM silver WHERE consorcio = 'ASIA' AND {_KEPT}\n"
    "UNION ALL SELECT 'dim_clima: chave repetida', count(*) FROM (SELECT DISTINCT condicao_clima FROM silver) "
    "WHERE condicao_clima = 'Sem Chuva'\n"
    f"UNION ALL SELECT 'fato x silver: diferenca de linhas', count(*) FROM silver WHERE NOT ({_KEPT})"
)
ORACLE["csv_to_bronze"] = ORACLE["bronze_trips"]
ORACLE["published_star_answer"] = ORACLE["q5_rain_duration"]
ORACLE["stream_enriched_trips"] = ORACLE["silver_trips"]
ORACLE["stream_hourly_counts"] = """
SELECT hora AS inicio, hora + INTERVAL 1 HOUR AS fim, event_type, count(*) AS total
FROM (SELECT date_trunc('hour', ts) AS hora, event_type FROM events)
GROUP BY hora, event_type"""
ORACLE["stream_late_rain"] = ORACLE["incremental_silver"] = ORACLE["silver_trips"]
# Of streamed copies of a trip one is published, and none if the batch has the trip.
ORACLE["streamed_beside_batch"] = _on_silver(
    "SELECT * REPLACE (round(chuva_no_horario, 6) AS chuva_no_horario) FROM batch UNION ALL "
    "SELECT * EXCLUDE n REPLACE (round(chuva_no_horario, 6) AS chuva_no_horario) FROM streamed WHERE n = 1",
    "\nbatch AS (SELECT * FROM silver WHERE data_viagem < DATE '1998-06-01')",
    "\nstreamed AS (SELECT *, row_number() OVER (PARTITION BY id_viagem ORDER BY data_viagem DESC, linha DESC, consorcio DESC, "
    "tipo_dia DESC, distancia_planejada DESC, tempo_viagem DESC) AS n FROM silver "
    "WHERE data_viagem >= DATE '1998-06-01' AND id_viagem NOT IN (SELECT id_viagem FROM batch))",
)
ORACLE["incremental_star"] = _on_silver(
    "SELECT desc_categoria_dia, consorcio AS consorcio_id, condicao_clima AS desc_intensidade, count(*) AS viagens, "
    "CAST(sum(tempo_viagem) AS BIGINT) AS minutos FROM silver JOIN calendar ON data_id = data_viagem GROUP BY ALL",
    _CALENDAR,
)
ORACLE["clustered_month_and_line"] = _on_silver(
    "SELECT linha, count(*) AS viagens, CAST(sum(tempo_viagem) AS BIGINT) AS minutos FROM silver "
    "WHERE data_viagem BETWEEN DATE '1998-06-01' AND DATE '1998-06-30' AND split_part(linha, '-', 1) IN ('1', '2', '3') GROUP BY linha"
)
ORACLE["two_deliveries_one_date"] = ORACLE["mixed_headers_to_bronze"] = ORACLE["bronze_trips"]
ORACLE["rollback_to_first"] = ORACLE["rain_hourly"]
ORACLE["bronze_lineage"] = (
    "SELECT 2024 AS ano, 8 AS mes, 24 AS dia, CAST(1 AS BIGINT) AS versoes, count(*) AS linhas, "
    "CAST(0 AS BIGINT) AS sem_arquivo FROM lineitem"
)
ORACLE["silver_view"] = _on_silver(
    "SELECT condicao_clima, count(*) AS viagens, CAST(sum(tempo_viagem) AS BIGINT) AS minutos FROM silver GROUP BY 1"
)
_BEFORE, _AFTER = "data_viagem < DATE '1997-01-01'", "data_viagem >= DATE '1997-01-01'"
_HISTORY = f"""
history AS (
    SELECT linha, avg(tempo_viagem) AS media_linha, coalesce(stddev_samp(tempo_viagem), 0) AS desvio_linha
    FROM silver WHERE linha IS NOT NULL AND {_BEFORE} GROUP BY linha
)"""
ORACLE["eta_line_history"] = _on_silver(
    "SELECT linha, round(media_linha, 6) AS media_linha, round(desvio_linha, 6) AS desvio_linha FROM history", _HISTORY
)
ORACLE["eta_baseline_errors"] = _on_silver(
    "SELECT count(tempo_viagem) AS viagens, round(avg(abs(media_linha - tempo_viagem)), 4) AS erro_absoluto_medio, "
    "round(sqrt(avg((media_linha - tempo_viagem) * (media_linha - tempo_viagem))), 4) AS raiz_erro_quadratico "
    f"FROM silver JOIN history USING (linha) WHERE {_AFTER}",
    _HISTORY,
)


def _mean_after(cut: str, until: str) -> str:
    return f"""
SELECT DATE '{cut}' AS corte, count(tempo_viagem) AS viagens, round(avg(abs(media - tempo_viagem)), 4) AS erro_absoluto_medio,
       round(sqrt(avg((media - tempo_viagem) * (media - tempo_viagem))), 4) AS raiz_erro_quadratico
FROM silver JOIN (SELECT linha, avg(tempo_viagem) AS media FROM silver WHERE data_viagem < DATE '{cut}' GROUP BY linha) USING (linha)
WHERE data_viagem >= DATE '{cut}' AND data_viagem < DATE '{until}'"""


ORACLE["eta_walk_forward_mean"] = _on_silver(
    "UNION ALL".join(_mean_after(*x) for x in (("1996-01-01", "1997-01-01"), ("1997-01-01", "1998-01-01"), ("1998-01-01", "9999-01-01")))
)
ORACLE["star_by_sql"] = ORACLE["incremental_star"]
ORACLE["landing_copy"] = _with(
    _TRIPS, select="SELECT consorcio, count(*) AS linhas, count(DISTINCT id_viagem) AS viagens FROM trips GROUP BY consorcio"
)
ORACLE["isolated_loads"] = (
    "SELECT 'viagens_onibus' AS dataset, 'published' AS status, count(*) AS linhas, true AS publicado FROM lineitem "
    "UNION ALL SELECT 'clima_pluviometria', 'failed', 0, false UNION ALL SELECT 'estacoes_clima', 'skipped', 0, false"
)
ORACLE["bronze_table"] = (
    "SELECT 2024 AS ano, 8 AS mes, CAST(if(l_shipdate < DATE '1997-01-01', 24, 25) AS INTEGER) AS dia, CAST(1 AS BIGINT) AS versoes, "
    "count(*) AS linhas, min(CAST(l_shipdate AS DATE)) AS primeira, max(CAST(l_shipdate AS DATE)) AS ultima FROM lineitem GROUP BY 3"
)


def _places(question: str, value: str, order: str, source: str) -> str:
    return (
        f"SELECT '{question}' AS pergunta, row_number() OVER (ORDER BY {order}) AS posicao, "
        f"CAST({value} AS VARCHAR) AS valor FROM ({source})"
    )


ORACLE["question_order"] = _on_silver(
    "\nUNION ALL ".join(
        (
            _places("q1", "hora_partida", "n DESC, hora_partida", "SELECT hora_partida, count(*) AS n FROM silver GROUP BY 1"),
            _places("q3", "consorcio", "m DESC, consorcio", "SELECT consorcio, avg(tempo_viagem) AS m FROM silver GROUP BY 1"),
            _places("q4", "linha", "exact DESC NULLS LAST, linha", "SELECT * FROM spread ORDER BY exact DESC NULLS LAST, linha LIMIT 15"),
            _places("q5", "condicao_clima", "m DESC, condicao_clima", "SELECT condicao_clima, avg(tempo_viagem) AS m FROM silver GROUP BY 1"),
        )
    ),
    _SPREAD,
)
ORACLE["as_of_version"] = ORACLE["rain_hourly"]
ORACLE["distance_fences"] = _on_silver(
    "SELECT consorcio AS consorcio_id, count(distancia_planejada) AS viagens, true AS limite_inferior_certo, "
    "true AS limite_superior_certo FROM silver GROUP BY consorcio"
)
ORACLE["distance_outlier_filter"] = _on_silver(
    "SELECT id_viagem, linha FROM silver JOIN fences USING (linha) WHERE distancia_planejada BETWEEN low AND high",
    "\nfences AS (SELECT linha, quantile_disc(distancia_planejada, 0.05) AS low, "
    "quantile_disc(distancia_planejada, 0.95) AS high FROM silver GROUP BY linha)",
)
ORACLE["profile_from_sketches"] = (
    "WITH" + _TRIPS.replace("l_linestatus AS sentido", "l_linestatus AS sentido, CAST(NULL AS VARCHAR) AS shape_id")
    + "\n" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS coluna, count(*) AS linhas, count(*) - count({c}) AS nulos, CAST(min({c}) AS VARCHAR) AS minimo, "
        f"CAST(max({c}) AS VARCHAR) AS maximo, count(DISTINCT {c}) AS exatos, true AS perto FROM trips"
        for c in ("data", "consorcio", "tipo_dia", "id_viagem", "servico", "shape_id", "tempo_viagem")
    )
)
ORACLE["row_count"] = "SELECT count(*) AS linhas FROM lineitem"
ORACLE["lenient_rejects"] = """
SELECT l_orderkey, l_linenumber, 'l_quantity' AS coluna, 'xx' AS valor FROM lineitem WHERE l_linenumber = 5
UNION ALL
SELECT l_orderkey, l_linenumber, 'l_shipdate', 'sem data' FROM lineitem WHERE l_linenumber >= 5"""
ORACLE["bronze_fleet"] = (
    "SELECT p_name AS nome_chassi, p_partkey AS id_chassi, p_type AS tecnologia, "
    "if(p_size > 25, 'DIESEL', 'ELETRICO') AS tipo_combustivel, "
    "p_partkey % 2 = 0 AS indicador_ar_condicionado, p_partkey % 3 = 0 AS indicador_elevador, "
    "p_partkey % 5 = 0 AS indicador_usb, p_size % 2 = 1 AS indicador_wifi, "
    "CAST(2015 + p_size % 10 AS BIGINT) AS ano_ultima_vistoria, "
    + _null_columns(
        carroceria="VARCHAR",
        id_fabricante_chassi="BIGINT",
        id_planta="BIGINT",
        tipo_veiculo="VARCHAR",
        status="VARCHAR",
        data_inicio_vinculo="DATE",
        data_ultima_vistoria="DATE",
        ultima_situacao="VARCHAR",
        quantidade_lotacao_pe="BIGINT",
        quantidade_lotacao_sentado="BIGINT",
        indicador_veiculo_lacrado="BOOLEAN",
        indicador_data_ultima_vistoria_tratada="BOOLEAN",
        data_arquivo_fonte="DATE",
        versao="VARCHAR",
        datetime_ultima_atualizacao="TIMESTAMP",
        id_execucao_dbt="VARCHAR",
        ano_ultima_vistoria_atualizado="BIGINT",
    )
    + " FROM part"
)
