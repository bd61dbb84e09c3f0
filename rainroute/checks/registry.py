"""Registered queries: every operator applied to the proxied test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainroute.contracts import CONTRACTS, schema_from_ddl
from rainroute.functions import mapped_name, rain_band_contiguous
from rainroute.operators import dedup, outliers, quality, scope
from rainroute.operators.casting import REJECTS, apply_contract, rejected
from rainroute.plans import clustering, eta, gold, jobs, questions, rain_stations, silver
from rainroute.plans import fleet as fleet_plan
from rainroute.session import materialise, scratch_path
from rainroute.sources import proxy
from rainroute.sources.csv_files import GZIP
from rainroute.sources.versions import Store, write_files
from rainroute.streaming import trips as trips_stream

Query = Callable[[SparkSession, str], DataFrame]

# Values no question states; chosen for the test tables, not claimed for real data.
RAINY_DAY_MM = 5.0
SCOPE = (date(1997, 1, 1), date(1998, 8, 24))
DURATION_RANGE = (3, 45)
DURATION_QUANTILES = (0.05, 0.95)
PLATEAU_FROM, VALLEY_BELOW = 0.99, 0.95
FLEET_YEAR = 2025
PROFILED = ("data", "consorcio", "tipo_dia", "id_viagem", "servico", "shape_id", "tempo_viagem")
RUN_DATE = date(2024, 8, 24)
ETA_SPLIT = date(1997, 1, 1)
LATER_FROM = date(1998, 6, 1)
MONTH = (date(1998, 6, 1), date(1998, 6, 30))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round sums and means of doubles, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- Bronze -------------------------------------------------------------------


def _typed(df: DataFrame, dataset: str) -> DataFrame:
    return apply_contract(df, CONTRACTS[dataset].schema)


def bronze_trips(spark, sf):
    as_text = proxy.trips(spark, sf).select(
        *[F.col(f.name).cast("string").alias(f.name) for f in CONTRACTS["viagens_onibus"].schema.fields]
    )
    return _typed(as_text, "viagens_onibus")


def bronze_rain(spark, sf):
    return rounded(_typed(proxy.rain(spark, sf), "clima_pluviometria"), "acumulado_chuva_1_h")


def bronze_stations(spark, sf):
    return _typed(proxy.stations(spark, sf), "estacoes_clima")


def bronze_fleet(spark, sf):
    return _typed(proxy.fleet(spark, sf), "licenciamento_frota")


def row_count(spark, sf):
    """The non-empty audit's count, from the file footers."""
    return proxy.table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("linhas"))


LENIENT_DDL = "l_orderkey BIGINT, l_linenumber INT, l_quantity INT, l_shipdate DATE"


def lenient_rejects(spark, sf):
    """Bad cells set aside by a lenient load, one row per cell."""
    line = F.col("l_linenumber")
    text = proxy.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        line.cast("string").alias("l_linenumber"),
        F.when(line == 5, "xx").otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.when(line >= 5, "sem data").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("l_shipdate"),
    )
    bad = rejected(apply_contract(text, schema_from_ddl(LENIENT_DDL), "lenient"))
    return bad.select("l_orderkey", "l_linenumber", F.explode(REJECTS).alias("r")).select(
        "l_orderkey", "l_linenumber", "r.coluna", "r.valor"
    )


# --- Silver -------------------------------------------------------------------


def _silver(spark, sf, **options) -> DataFrame:
    return silver.silver_trips(proxy.trips(spark, sf, **options), proxy.rain(spark, sf))


def rain_hourly(spark, sf):
    return rounded(silver.hourly_rain(proxy.rain(spark, sf)), "avg_chuva_1h")


def silver_trips(spark, sf):
    return rounded(_silver(spark, sf), "chuva_no_horario")


def silver_trips_preclassified(spark, sf):
    wide = silver.silver_trips_preclassified(proxy.trips(spark, sf), proxy.classified_rain(spark, sf))
    return rounded(wide, "chuva_no_horario")


def rain_band_gap_free(spark, sf):
    wide = silver.silver_trips(
        proxy.trips(spark, sf), proxy.rain(spark, sf), rain_band_contiguous
    )
    return questions.rain_volume(gold.fact_trips(wide))


def rain_unmatched(spark, sf):
    return questions.unmatched_rain_share(proxy.trips(spark, sf), proxy.rain(spark, sf))


# --- Gold ---------------------------------------------------------------------


def dim_calendar(spark, sf):
    return gold.dim_calendar(_silver(spark, sf))


def dim_calendar_clash(spark, sf):
    return gold.dim_calendar(_silver(spark, sf, clashing_day_type=True))


def dim_consortium(spark, sf):
    return gold.dim_consortium(_silver(spark, sf))


def dim_weather(spark, sf):
    return gold.dim_weather(_silver(spark, sf))


def fact_trips(spark, sf):
    return rounded(gold.fact_trips(_silver(spark, sf)), "chuva_no_horario")


# --- Questions ----------------------------------------------------------------


def _fact(spark, sf, **options) -> DataFrame:
    return gold.fact_trips(_silver(spark, sf, **options))


def q1_peak_hours(spark, sf):
    return questions.peak_hours(_fact(spark, sf))


def q2_weekend_supply(spark, sf):
    base = _silver(spark, sf)
    return questions.weekend_supply(gold.fact_trips(base), gold.dim_calendar(base))


def q2_weekend_supply_clash(spark, sf):
    base = _silver(spark, sf, clashing_day_type=True)
    return questions.weekend_supply(gold.fact_trips(base), gold.dim_calendar(base))


def q3_consortium_duration(spark, sf):
    return rounded(questions.consortium_duration(_fact(spark, sf)), "tempo_medio_minutos")


def q4_line_unpredictability(spark, sf):
    lines = questions.line_unpredictability(_fact(spark, sf))
    return rounded(lines, "media_minutos", "desvio_padrao")


def q5_rain_duration(spark, sf):
    return rounded(questions.rain_duration(_fact(spark, sf)), "tempo_medio")


def q6_rain_volume(spark, sf):
    return questions.rain_volume(_fact(spark, sf))


def top15_lines(spark, sf):
    lines = questions.least_predictable_lines(_fact(spark, sf))
    return rounded(lines, "media_minutos", "desvio_padrao")


def day_hour_volume(spark, sf):
    return questions.day_hour_volume(_fact(spark, sf))


def hour_change_class(spark, sf):
    return questions.hour_change_class(_fact(spark, sf))


def hour_change_class_filled(spark, sf):
    return questions.hour_change_class(_fact(spark, sf), fill_gaps=True)


def hour_regime(spark, sf):
    regimes = questions.hour_regime(_fact(spark, sf), PLATEAU_FROM, VALLEY_BELOW)
    return rounded(regimes, "fracao_do_pico")


def day_category_share(spark, sf):
    base = _silver(spark, sf)
    shares = questions.day_category_share(gold.fact_trips(base), gold.dim_calendar(base))
    return rounded(shares, "percentual")


def rainy_day_duration(spark, sf):
    answer = questions.rainy_day_duration(
        _fact(spark, sf), proxy.rain(spark, sf), RAINY_DAY_MM
    )
    return rounded(answer, "tempo_medio")


def consortium_pace(spark, sf):
    return rounded(questions.consortium_pace(_fact(spark, sf)), "minutos_por_km")


def rain_by_station(spark, sf):
    answer = rain_stations.rain_by_station(proxy.rain(spark, sf), proxy.stations(spark, sf))
    return rounded(answer, "media_chuva_1h", "maior_chuva_1h")


def fleet_profile(spark, sf):
    answer = fleet_plan.fleet_profile(proxy.fleet(spark, sf), FLEET_YEAR)
    return rounded(answer, *[f"fracao_{n}" for n in fleet_plan.AMENITIES], "anos_desde_vistoria")


# --- Quality ------------------------------------------------------------------


def trip_dedup(spark, sf):
    items = proxy.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("data"),
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    )
    return dedup.latest_per_key(items, ["l_orderkey", "l_linenumber"], ["data"])


def duration_range_filter(spark, sf):
    kept = outliers.within_range(_fact(spark, sf), "tempo_viagem", *DURATION_RANGE)
    return kept.select("id_viagem", "linha", "tempo_viagem")


def duration_outlier_filter(spark, sf):
    narrow = _fact(spark, sf).select("id_viagem", "linha", "tempo_viagem")
    return outliers.within_fences(narrow, "linha", "tempo_viagem", *DURATION_QUANTILES)


SKETCH_SIZE = 400


def distance_fences(spark, sf):
    """Sketched fences of a DOUBLE column per operator: whether their ranks are within the stated error of the asked ones."""
    trips = _fact(spark, sf).select("consorcio_id", "distancia_planejada")
    fences = outliers.sketched_fences(trips, "consorcio_id", "distancia_planejada", *DURATION_QUANTILES, SKETCH_SIZE)
    # A quantile's rank lies between the share of smaller values and that of values up to it.
    value, error = F.col("distancia_planejada"), 2 * outliers.rank_error(SKETCH_SIZE)
    figures = [F.count(value).alias("viagens")]
    for name, asked in zip(("limite_inferior", "limite_superior"), DURATION_QUANTILES, strict=True):
        below, until = F.count_if(value < F.col(name)) / F.count(value), F.count_if(value <= F.col(name)) / F.count(value)
        figures.append(((below - error <= asked) & (until + error >= asked)).alias(f"{name}_certo"))
    return trips.join(F.broadcast(fences), "consorcio_id").groupBy("consorcio_id").agg(*figures)


def distance_outlier_filter(spark, sf):
    """Trips between sketched fences of their line; lines have fewer trips than a sketch keeps whole, so these are exact."""
    narrow = _fact(spark, sf).select("id_viagem", "linha", "distancia_planejada")
    kept = outliers.within_fences(narrow, "linha", "distancia_planejada", *DURATION_QUANTILES, sketch=SKETCH_SIZE)
    return kept.select("id_viagem", "linha")


def profile_from_sketches(spark, sf):
    """Profile of all bronze trips, loaded on two run dates, merged from sketches; whether distinct counts are near enough."""
    lake = jobs.Lake.under(spark, scratch_path(spark, "lake"))
    trips = proxy.trips(spark, sf)
    for n, part in enumerate((trips.filter(F.col("data") < F.lit(ETA_SPLIT)), trips.filter(F.col("data") >= F.lit(ETA_SPLIT)))):
        folder = f"{lake.landing}-entrada/{n}"
        dataset = jobs.Dataset("viagens_onibus", _export(part, folder), profile=True)
        jobs.require_all(jobs.load_datasets(lake, [dataset], RUN_DATE + timedelta(days=n)))
    found = jobs.profile_bronze(lake, "viagens_onibus").where(F.col("coluna").isin(*PROFILED))
    columns = [F.count_distinct(F.col(c)).alias(c) for c in PROFILED]
    exact = trips.agg(*columns).select(F.explode(F.map_from_arrays(F.array(*map(F.lit, PROFILED)), F.array(*PROFILED))).alias("coluna", "exatos"))
    near = F.abs(F.col("distintos") - F.col("exatos")) <= 4 * quality.distinct_error() * F.col("exatos") + 1
    return found.join(exact, "coluna").select("coluna", "linhas", "nulos", "minimo", "maximo", "exatos", near.alias("perto"))


def _untidy(name, key):
    """Spell a name in one of three ways."""
    return (
        F.when(key % 3 == 0, F.lower(name))
        .when(key % 3 == 1, F.concat(F.lit("  "), F.regexp_replace(name, " ", "   "), F.lit(" ")))
        .otherwise(name)
    )


def consortium_normalise(spark, sf):
    """Trips with untidy consortium names, tidied trip by trip as the job does, then counted."""
    trips = proxy.trips(spark, sf)
    spelled = trips.withColumn("consorcio", _untidy(F.col("consorcio"), F.xxhash64("id_viagem") % 3))
    tidy = spelled.withColumn("consorcio", mapped_name("consorcio", {"MIDDLE EAST": "ORIENTE MEDIO"}))
    return tidy.groupBy("consorcio").agg(F.count(F.lit(1)).alias("total_viagens"))


def scope_filter(spark, sf):
    inside = scope.within_dates(proxy.table(spark, sf, "lineitem"), *SCOPE, column="l_shipdate")
    wide = proxy.trips(spark, sf, lineitem=inside)
    return gold.fact_trips(silver.silver_trips(wide, proxy.rain(spark, sf))).select(
        "id_viagem", "data_id", "hora_partida", "tempo_viagem"
    )


def column_profile(spark, sf):
    wide = proxy.trips(spark, sf).select(
        "data", "consorcio", "tipo_dia", "id_viagem", "servico", "shape_id", "tempo_viagem"
    )
    return quality.column_profile(wide, exact=["consorcio", "tipo_dia", "servico", "shape_id"]).select(
        "coluna", "linhas", "nulos", "distintos", "minimo", "maximo"
    )


def category_counts(spark, sf):
    return quality.category_counts(proxy.trips(spark, sf), ["consorcio", "tipo_dia", "sentido", "shape_id"])


def star_integrity(spark, sf):
    """Audit of a written star, as the build job runs it, with clashing day types."""
    wide = materialise(_silver(spark, sf, clashing_day_type=True), "silver")
    dims = {
        "dim_calendario": (gold.dim_calendar(wide), "data_id"),
        "dim_consorcio": (gold.dim_consortium(wide), "consorcio_id"),
        "dim_clima": (gold.dim_weather(wide), "clima_id"),
    }
    keys = {"dim_calendario": "data_id", "dim_consorcio": "consorcio_id", "dim_clima": "clima_id"}
    return quality.star_integrity(wide, gold.fact_trips(wide), dims, keys)


def star_integrity_planted(spark, sf):
    """The audit of a star with planted faults: an operator and a band's uniqueness gone, an hour of trips lost."""
    wide = materialise(_silver(spark, sf), "silver")
    weather = gold.dim_weather(wide)
    dims = {
        "dim_calendario": (gold.dim_calendar(wide), "data_id"),
        "dim_consorcio": (gold.dim_consortium(wide).filter("consorcio_id <> 'ASIA'"), "consorcio_id"),
        "dim_clima": (weather.unionAll(weather.filter("clima_id = 'Sem Chuva'")), "clima_id"),
    }
    keys = {"dim_calendario": "data_id", "dim_consorcio": "consorcio_id", "dim_clima": "clima_id"}
    return quality.star_integrity(wide, gold.fact_trips(wide).filter("hora_partida <> 3"), dims, keys)


DRIFT_CONTRACT = "l_orderkey BIGINT, l_quantity INT, l_returnflag DOUBLE, l_shipdate DATE, versao_modelo VARCHAR"


def schema_drift(spark, sf):
    incoming = proxy.table(spark, sf, "lineitem").select(
        *[F.col(c).cast("string").alias(c) for c in ("l_orderkey", "l_quantity", "l_returnflag", "l_tax")],
        F.when(F.col("l_linenumber") == 3, F.lit("sem data"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("l_shipdate"),
    )
    return quality.schema_drift(incoming, schema_from_ddl(DRIFT_CONTRACT))


def layer_expectations(spark, sf):
    fact = _fact(spark, sf)
    rules = {
        "id_viagem presente": F.col("id_viagem").isNotNull(),
        "hora entre 0 e 23": F.col("hora_partida").between(0, 23),
        "duracao ate 45": F.col("tempo_viagem").between(1, 45),
        "consorcio conhecido": F.col("consorcio_id") != "ASIA",
    }
    return quality.expectations(fact, rules)


def lineage_by_file(spark, sf):
    items = proxy.table(spark, sf, "lineitem")
    return items.groupBy(F.col("_metadata.file_name").alias("arquivo")).agg(
        F.count(F.lit(1)).alias("linhas")
    )


# --- Files, versions, streams, regression ---------------------------------------


EXPORT_ROWS = 500_000  # a file of some 15 MB, which one task reads


def _export(df: DataFrame, folder: str) -> str:
    """Write the proxied input as gzipped CSV files with a header, as the jobs expect them; returns their folder.

    Rows stay where they are read. Spark writes a file for its first partition even if that is empty, and an
    empty file fails the audit, but not so into the folder of a value.
    """
    writer = df.withColumn("entrega", F.lit(0)).write.mode("append").partitionBy("entrega")
    writer.options(**GZIP).option("header", True).option("maxRecordsPerFile", EXPORT_ROWS).csv(folder)
    return f"{folder}/entrega=0"


def _ordered(df: DataFrame) -> DataFrame:
    """The rows of a sorted answer, a handful, with their place in it: row ids follow the order of the sort."""
    return df.withColumn("__row", F.monotonically_increasing_id()).withColumn(
        "posicao", F.row_number().over(Window.orderBy("__row")).cast("long")
    )


def question_order(spark, sf):
    """The order of the answers to four questions: question, place, and what stands there."""
    fact = materialise(_fact(spark, sf), "fact")
    named = (
        ("q1", questions.peak_hours(fact), "hora_partida"),
        ("q3", questions.consortium_duration(fact), "consorcio_id"),
        ("q4", questions.least_predictable_lines(fact), "linha"),
        ("q5", questions.rain_duration(fact), "clima_id"),
    )
    answers = [
        _ordered(df).select(F.lit(q).alias("pergunta"), "posicao", F.col(c).cast("string").alias("valor")) for q, df, c in named
    ]
    return reduce(DataFrame.unionAll, answers)


def _loaded_lake(spark, sf, *names: str) -> jobs.Lake:
    root = scratch_path(spark, "lake")
    inputs = {
        "viagens_onibus": proxy.trips,
        "clima_pluviometria": proxy.rain,
        "estacoes_clima": proxy.stations,
    }
    datasets = [jobs.Dataset(name, _export(inputs[name](spark, sf), f"{root}/entrada/{name}")) for name in names]
    lake = jobs.Lake.under(spark, root)
    jobs.require_all(jobs.load_datasets(lake, datasets, RUN_DATE))
    return lake


def csv_to_bronze(spark, sf):
    """CSV files, landing copy, typed bronze load, audit, publication, read back."""
    lake = _loaded_lake(spark, sf, "viagens_onibus")
    return jobs.read_bronze(lake, "viagens_onibus").select(
        *[f.name for f in CONTRACTS["viagens_onibus"].schema.fields]
    )


def _two_deliveries(spark, sf, mixed: bool) -> jobs.Lake:
    """Trips in two folders of CSV files that come one after the other for one run date."""
    root = scratch_path(spark, "lake")
    lake = jobs.Lake.under(spark, root)
    trips = proxy.trips(spark, sf)
    even = F.pmod(F.xxhash64("id_viagem"), F.lit(2)) == 0
    other = [*reversed(trips.columns)] if mixed else trips.columns
    for name, part in (("a", trips.filter(even)), ("b", trips.filter(~even).select(*other))):
        folder = _export(part, f"{root}/entrada" if mixed else f"{root}/entrada/{name}")
        if not mixed:
            jobs.require_all(jobs.load_datasets(lake, [jobs.Dataset("viagens_onibus", folder)], RUN_DATE))
    if mixed:
        jobs.require_all(jobs.load_datasets(lake, [jobs.Dataset("viagens_onibus", folder)], RUN_DATE))
    return lake


def _contract_columns(lake: jobs.Lake) -> DataFrame:
    return jobs.read_bronze(lake, "viagens_onibus").select(*CONTRACTS["viagens_onibus"].schema.names)


def two_deliveries_one_date(spark, sf):
    """Two disjoint deliveries of one run date: readers see both."""
    return _contract_columns(_two_deliveries(spark, sf, mixed=False))


def mixed_headers_to_bronze(spark, sf):
    """Files of one folder whose columns stand in different orders."""
    return _contract_columns(_two_deliveries(spark, sf, mixed=True))


def bronze_lineage(spark, sf):
    """Bronze rows by run date and by whether file and version are known, through the view with lineage."""
    _loaded_lake(spark, sf, "viagens_onibus")
    return spark.sql(
        "SELECT ano, mes, dia, count(DISTINCT carga) AS versoes, count(*) AS linhas,"
        " count_if(_arquivo IS NULL OR _arquivo NOT LIKE '%.csv') AS sem_arquivo"
        " FROM bronze.viagens_onibus_linhagem GROUP BY ano, mes, dia"
    )


def landing_copy(spark, sf):
    """Lines and trips of the landing copy, which keeps every line of the delivered files."""
    lake = _loaded_lake(spark, sf, "viagens_onibus")
    names = CONTRACTS["viagens_onibus"].schema.names
    lines = spark.read.text(f"{lake.landing}/viagens_onibus/{RUN_DATE:%Y/%m/%d}").where(F.col("value") != ",".join(names))
    cell = F.split("value", ",")
    return lines.groupBy(cell[names.index("consorcio")].alias("consorcio")).agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct(cell[names.index("id_viagem")]).alias("viagens")
    )


def isolated_loads(spark, sf):
    """What becomes of three datasets of one run: good files, files without a column, no files. One retry each."""
    root = scratch_path(spark, "lake")
    lake = jobs.Lake.under(spark, root)
    sources = {
        "viagens_onibus": _export(proxy.trips(spark, sf), f"{root}/entrada/viagens_onibus"),
        "clima_pluviometria": _export(proxy.rain(spark, sf).drop("horario"), f"{root}/entrada/clima_pluviometria"),
        "estacoes_clima": f"{root}/entrada/estacoes_clima",
    }
    results = jobs.load_datasets(lake, [jobs.Dataset(*source) for source in sources.items()], RUN_DATE)
    seen = [(r.dataset, r.status, r.rows, bool(lake.bronze_store(r.dataset).current())) for r in results]
    return spark.createDataFrame(seen, "dataset string, status string, linhas bigint, publicado boolean")


def star_by_sql(spark, sf):
    """The weekend question in SQL over the four gold views."""
    lake = _loaded_lake(spark, sf, "viagens_onibus", "clima_pluviometria")
    jobs.build_silver(lake)
    jobs.build_gold(lake)
    jobs.register_views(lake, ["viagens_onibus"])
    return spark.sql(
        "SELECT d.desc_categoria_dia, c.nome_consorcio AS consorcio_id, w.desc_intensidade, count(*) AS viagens,"
        " sum(f.tempo_viagem) AS minutos FROM gold.fato_viagens f JOIN gold.dim_calendario d USING (data_id)"
        " JOIN gold.dim_consorcio c USING (consorcio_id) JOIN gold.dim_clima w USING (clima_id) GROUP BY ALL"
    )


def silver_view(spark, sf):
    """Trips and minutes by rain band, from the SQL view over published silver."""
    lake = _loaded_lake(spark, sf, "viagens_onibus", "clima_pluviometria")
    jobs.build_silver(lake)
    jobs.register_silver(lake)
    return spark.sql(
        "SELECT condicao_clima, count(*) AS viagens, sum(tempo_viagem) AS minutos"
        " FROM silver.viagens_processadas GROUP BY condicao_clima"
    )


def published_star_answer(spark, sf):
    """CSV to bronze to silver to gold, all published; then the rain question on the gold table."""
    lake = _loaded_lake(spark, sf, "viagens_onibus", "clima_pluviometria", "estacoes_clima")
    jobs.build_silver(lake)
    jobs.build_gold(lake)
    return rounded(
        questions.rain_duration(jobs.read_gold(lake, "fato_desempenho_viagem")), "tempo_medio"
    )


def as_of_version(spark, sf):
    """Hourly rain as first published, after a second version and a rollback have come and gone."""
    store = Store(spark, scratch_path(spark, "versions"))
    hourly = silver.hourly_rain(proxy.rain(spark, sf))
    write_files(hourly, store.path("v1"))
    first = store.publish("v1")
    write_files(store.read().withColumn("avg_chuva_1h", F.col("avg_chuva_1h") * 2), store.path("v2"))
    store.publish("v2")
    store.rollback()
    return rounded(store.read(as_of=first), "avg_chuva_1h")


def rollback_to_first(spark, sf):
    """Hourly rain after three versions and two rollbacks, the second one by name."""
    store = Store(spark, scratch_path(spark, "versions"))
    hourly = silver.hourly_rain(proxy.rain(spark, sf))
    for n, version in enumerate(("v1", "v2", "v3"), 1):
        write_files(hourly.withColumn("avg_chuva_1h", F.col("avg_chuva_1h") * n), store.path(version))
        store.publish(version)
    store.rollback()
    store.rollback(to="v1")
    return rounded(store.read(), "avg_chuva_1h")


def _file_stream(spark, sf, name: str) -> DataFrame:
    schema = proxy.table(spark, sf, name).schema
    if Store(spark, sf).folders(f"{sf}/{name}.parquet/*.parquet"):  # a table of several files
        return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parquet")
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def stream_enriched_trips(spark, sf):
    """Silver by stream: equal to the batch result."""
    hourly = materialise(silver.hourly_rain(proxy.rain(spark, sf)), "hourly")
    stream = proxy.trips(spark, sf, lineitem=_file_stream(spark, sf, "lineitem"))
    root = scratch_path(spark, "stream")
    trips_stream.write_enriched(
        stream, lambda: (hourly, hourly.count()), f"{root}/out", f"{root}/checkpoint"
    )
    written = spark.read.parquet(f"{root}/out").select(*silver.SILVER_COLUMNS)
    return rounded(written, "chuva_no_horario")


def stream_hourly_counts(spark, sf):
    """All hours, those that are still open included."""
    root = scratch_path(spark, "stream")
    store = Store(spark, f"{root}/out")
    trips_stream.write_touched(_file_stream(spark, sf, "events"), store, f"{root}/checkpoint", "ts", "event_type")
    return store.read()


FAR = "2100-01-01"


def stream_late_rain(spark, sf):
    """Silver from two streams, the rain of all hours coming after all trips; equal to the batch result.

    A trip and a reading of the far future close all hours at the end; that hour itself stays open.
    """
    root = scratch_path(spark, "late")
    rain = proxy.rain(spark, sf).select("primary_key", "data_particao", "horario", "acumulado_chuva_1_h")
    trips = proxy.trips(spark, sf).select(*jobs.TRIP_COLUMNS)
    inbox = {"trips": trips, "rain": rain}
    streams = {}
    for name, df in inbox.items():
        df.limit(0).write.parquet(f"{root}/{name}")
        streams[name] = spark.readStream.schema(df.schema).parquet(f"{root}/{name}")

    def pull():
        rows = trips_stream.wait_for_rain(streams["trips"], streams["rain"], "1 hour", "1 hour")
        return trips_stream.write_closed(rows, f"{root}/out", f"{root}/checkpoint")

    def end(name: str, day: str, clock: str, at: str) -> None:
        given = {day: F.lit(FAR).cast("date"), clock: F.lit(at).cast(inbox[name].schema[clock].dataType)}
        row = [given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in inbox[name].schema.fields]
        spark.range(1).select(*row).write.mode("append").parquet(f"{root}/{name}")

    trips.write.mode("append").parquet(f"{root}/trips")
    pull()
    rain.write.mode("append").parquet(f"{root}/rain")
    pull()
    end("trips", "data", "datetime_partida", f"{FAR} 00:00:00")
    end("rain", "data_particao", "horario", "00:00:00")
    pull()
    return rounded(spark.read.parquet(f"{root}/out").select(*silver.SILVER_COLUMNS), "chuva_no_horario")


def _two_run_dates(spark, sf, *datasets: str) -> jobs.Lake:
    """Trips loaded on two run dates, the second one with the last months; silver and gold built after each."""
    root = scratch_path(spark, "lake")
    lake = jobs.Lake.under(spark, root)
    trips = proxy.trips(spark, sf)
    later = F.col("data") >= F.lit(LATER_FROM)
    readings = _export(proxy.rain(spark, sf), f"{root}/entrada/clima_pluviometria")
    jobs.require_all(jobs.load_datasets(lake, [jobs.Dataset("clima_pluviometria", readings)], RUN_DATE))
    for n, part in enumerate((trips.filter(~later), trips.filter(later))):
        dataset = jobs.Dataset("viagens_onibus", _export(part, f"{root}/entrada/viagens_{n}"))
        jobs.require_all(jobs.load_datasets(lake, [dataset], RUN_DATE + timedelta(days=n)))
        jobs.build_silver(lake)
        jobs.build_gold(lake)
    return lake


def incremental_silver(spark, sf):
    """Silver after two builds, the second of which wrote the months of the second delivery only."""
    return rounded(jobs.read_silver(_two_run_dates(spark, sf)), "chuva_no_horario")


def incremental_star(spark, sf):
    """The star after two builds: minutes by day category, operator and rain band."""
    lake = _two_run_dates(spark, sf)
    fact, calendar, weather = (jobs.read_gold(lake, t) for t in ("fato_desempenho_viagem", "dim_calendario", "dim_clima"))
    joined = fact.join(calendar, "data_id").join(weather, "clima_id")
    return joined.groupBy("desc_categoria_dia", "consorcio_id", "desc_intensidade").agg(
        F.count(F.lit(1)).alias("viagens"), F.sum("tempo_viagem").alias("minutos")
    )


def clustered_month_and_line(spark, sf):
    """Trips and minutes of one month on some lines, from the fact files that can hold them."""
    lake = _two_run_dates(spark, sf)
    fact = clustering.read_fact(lake.gold_store(), MONTH, [f"{n}-{m}" for n in (1, 2, 3) for m in range(12)])
    return fact.groupBy("linha").agg(F.count(F.lit(1)).alias("viagens"), F.sum("tempo_viagem").alias("minutos"))


def streamed_beside_batch(spark, sf):
    """Silver where the last months were streamed after a batch build, with some trips of the batch sent again."""
    root = scratch_path(spark, "lake")
    lake = jobs.Lake.under(spark, root)
    trips = proxy.trips(spark, sf)
    later, again = F.col("data") >= F.lit(LATER_FROM), F.pmod(F.xxhash64("id_viagem"), F.lit(50)) == 0
    for name, df in (("viagens_onibus", trips.filter(~later)), ("clima_pluviometria", proxy.rain(spark, sf))):
        jobs.require_all(jobs.load_datasets(lake, [jobs.Dataset(name, _export(df, f"{root}/entrada/{name}"))], RUN_DATE))
    jobs.build_silver(lake)
    trips.filter(later | again).write.parquet(f"{root}/chegadas")
    stream = spark.readStream.schema(trips.schema).parquet(f"{root}/chegadas")
    hourly = materialise(silver.hourly_rain(proxy.rain(spark, sf)), "hourly")
    trips_stream.write_enriched(stream, lambda: (hourly, hourly.count()), f"{root}/fluxo", f"{root}/checkpoint")
    trips_stream.publish_enriched(lake, f"{root}/fluxo")
    return rounded(jobs.read_silver(lake), "chuva_no_horario")


def _eta_fact(spark, sf) -> DataFrame:
    """The fact written once, with the columns that forecasts read."""
    return materialise(_fact(spark, sf).select(*eta.COLUMNS), "fact")


def _eta_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Trips before and from the split date on: history and model come from the first part only."""
    fact = _eta_fact(spark, sf)
    return fact.filter(F.col("data_id") < F.lit(ETA_SPLIT)), fact.filter(F.col("data_id") >= F.lit(ETA_SPLIT))


def eta_line_history(spark, sf):
    """What the regression knows of each line: mean and deviation before the split date."""
    return rounded(eta.line_history(_eta_parts(spark, sf)[0]), "media_linha", "desvio_linha")


def eta_baseline_errors(spark, sf):
    """Error of the line's mean as a forecast for later trips."""
    before, after = _eta_parts(spark, sf)
    known = eta.eta_features(after, eta.line_history(before)).withColumn("tempo_previsto", F.col("media_linha"))
    return rounded(eta.errors(known), "erro_absoluto_medio", "raiz_erro_quadratico", digits=4)


def eta_errors(spark, sf):
    """Regression fitted before the split date and judged on the trips after it: error in minutes."""
    before, after = _eta_parts(spark, sf)
    history = eta.line_history(before)
    model = eta.fit(eta.eta_features(before, history))
    return rounded(
        eta.errors(eta.predict(model, eta.eta_features(after, history))),
        "erro_absoluto_medio",
        "raiz_erro_quadratico",
        digits=4,
    )


ETA_CUTS = (date(1996, 1, 1), date(1997, 1, 1), date(1998, 1, 1))


def eta_walk_forward_mean(spark, sf):
    """Error per cut date of the line's mean, known before the cut, for the trips until the next cut."""
    forecasts = eta.walk_forward(_eta_fact(spark, sf), ETA_CUTS, ["media"])
    return rounded(eta.errors(forecasts, "corte"), "erro_absoluto_medio", "raiz_erro_quadratico", digits=4)


def eta_walk_forward(spark, sf):
    """Error per cut date of the line's mean, least squares and boosted trees over the same trips."""
    forecasts = eta.walk_forward(_eta_fact(spark, sf), ETA_CUTS)
    return rounded(eta.errors(forecasts, "corte", "modelo"), "erro_absoluto_medio", "raiz_erro_quadratico", digits=4)


def bronze_table(spark, sf):
    """Trips by run date, file and version from the catalog table that the loads keep up to date, after two run dates."""
    root = scratch_path(spark, "lake")
    lake = jobs.Lake.under(spark, root)
    trips = proxy.trips(spark, sf)
    for n, part in enumerate((trips.filter(F.col("data") < F.lit(ETA_SPLIT)), trips.filter(F.col("data") >= F.lit(ETA_SPLIT)))):
        dataset = jobs.Dataset("viagens_onibus", _export(part, f"{root}/entrada/{n}"))
        jobs.require_all(jobs.load_datasets(lake, [dataset], RUN_DATE + timedelta(days=n)))
    return spark.sql(
        "SELECT ano, mes, dia, count(DISTINCT carga) AS versoes, count(*) AS linhas, min(data) AS primeira, max(data) AS ultima"
        " FROM bronze.viagens_onibus_arquivos GROUP BY ano, mes, dia"
    )


REGISTRY: dict[str, Query] = {
    f.__name__: f
    for f in (
        bronze_trips,
        bronze_rain,
        bronze_stations,
        bronze_fleet,
        row_count,
        lenient_rejects,
        rain_hourly,
        silver_trips,
        silver_trips_preclassified,
        rain_band_gap_free,
        rain_unmatched,
        dim_calendar,
        dim_calendar_clash,
        dim_consortium,
        dim_weather,
        fact_trips,
        q1_peak_hours,
        q2_weekend_supply,
        q2_weekend_supply_clash,
        q3_consortium_duration,
        q4_line_unpredictability,
        q5_rain_duration,
        q6_rain_volume,
        top15_lines,
        day_hour_volume,
        hour_change_class,
        hour_change_class_filled,
        hour_regime,
        day_category_share,
        rainy_day_duration,
        consortium_pace,
        rain_by_station,
        fleet_profile,
        trip_dedup,
        duration_range_filter,
        duration_outlier_filter,
        distance_fences,
        distance_outlier_filter,
        profile_from_sketches,
        consortium_normalise,
        scope_filter,
        column_profile,
        category_counts,
        star_integrity,
        star_integrity_planted,
        schema_drift,
        layer_expectations,
        lineage_by_file,
        csv_to_bronze,
        published_star_answer,
        question_order,
        two_deliveries_one_date,
        mixed_headers_to_bronze,
        bronze_lineage,
        silver_view,
        landing_copy,
        isolated_loads,
        star_by_sql,
        rollback_to_first,
        eta_line_history,
        eta_baseline_errors,
        eta_walk_forward_mean,
        eta_walk_forward,
        bronze_table,
        as_of_version,
        stream_enriched_trips,
        stream_hourly_counts,
        stream_late_rain,
        incremental_silver,
        incremental_star,
        clustered_month_and_line,
        streamed_beside_batch,
        eta_errors,
    )
}
REGISTRY["rain_band_contiguous"] = REGISTRY.pop("rain_band_gap_free")
