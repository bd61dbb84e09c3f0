"""Builds that write only the months that changed, and the fact's layout."""

import os
from datetime import date, timedelta

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from test_ingest import RAIN, TRIPS, put

from rainroute.plans import changes, clustering, jobs
from rainroute.sources.versions import Store

RUN = date(2024, 3, 5)


def trip(key, day, hour=6, minutes=30, line="100"):
    return f"{day},Intersul,Dia Útil,E1,V1,{key},{line},S1,I,{day} {hour:02d}:10:00,{day} 07:00:00,{minutes},12.5,99.1,98.0,abc"


def reading(key, day, mm, clock="06:00:00"):
    return f"{key},1,0.2,{mm},1.0,2.0,3.0,{clock},{day}"


@pytest.fixture
def lake(spark, tmp_path):
    return jobs.Lake.under(spark, str(tmp_path / "lake"))


class Loader:
    def __init__(self, lake, tmp_path):
        self.lake, self.folder, self.n = lake, tmp_path, 0

    def __call__(self, dataset, *lines, name=None, run=None):
        self.n += 1
        folder = str(self.folder / f"in{self.n}")
        put(folder, name or f"f{self.n}.csv", TRIPS if dataset == "viagens_onibus" else RAIN, *lines)
        jobs.ingest(self.lake, jobs.Dataset(dataset, folder), run or RUN + timedelta(days=self.n))


@pytest.fixture
def load(lake, tmp_path):
    return Loader(lake, tmp_path)


def months(lake, table="stg_viagens"):
    return {s.rpartition("parte=")[2]: v for s, v in lake.silver_store(table).current().items()}


def same_as_full(lake, options=jobs.SilverOptions()):
    columns = ["data_viagem", "id_viagem", "tempo_viagem", "chuva_no_horario", "condicao_clima"]
    got = rows(jobs.read_silver(lake), *columns)
    jobs.build_silver(lake, options, full=True)
    assert got == rows(jobs.read_silver(lake), *columns)
    return got


def test_a_second_run_date_writes_its_months_only(lake, load):
    load("clima_pluviometria", reading("k1", "2024-01-10", 4.0), reading("k2", "2024-02-10", 8.0))
    load("viagens_onibus", trip("a", "2024-01-10"), trip("b", "2024-02-10"), trip("c", "2024-02-11"))
    first_version = jobs.build_silver(lake)
    jobs.build_gold(lake)
    assert months(lake) == {"m2024-01": first_version, "m2024-02": first_version}
    assert jobs.build_silver(lake) == first_version and lake.silver_store("stg_viagens").history().count() == 2
    gold_before = lake.gold_store().current()
    assert jobs.build_gold(lake) == gold_before[""] and lake.gold_store().current() == gold_before

    load("viagens_onibus", trip("d", "2024-02-10"), trip("e", "2024-03-01"))
    second = jobs.build_silver(lake)
    assert months(lake) == {"m2024-01": first_version, "m2024-02": second, "m2024-03": second}
    jobs.build_gold(lake)
    fact = {s: v for s, v in lake.gold_store().current().items() if s}
    assert fact == {f"fato_desempenho_viagem/origem=lote/parte={m}": v for m, v in months(lake).items()}
    assert jobs.read_gold(lake, jobs.FACT).count() == 5
    assert rows(jobs.read_gold(lake, "dim_clima")) == [("Fraca", "Fraca"), ("Moderada", "Moderada"), ("Sem Chuva", "Sem Chuva")]
    assert len(same_as_full(lake)) == 5


def test_late_rain_builds_its_months_again(lake, load):
    load("clima_pluviometria", reading("k1", "2024-01-10", 4.0))
    load("viagens_onibus", trip("a", "2024-01-10"), trip("b", "2024-02-10"))
    first = jobs.build_silver(lake)
    load("clima_pluviometria", reading("k2", "2024-02-10", 60.0))
    second = jobs.build_silver(lake)
    assert months(lake) == {"m2024-01": first, "m2024-02": second}
    assert rows(jobs.read_silver(lake), "id_viagem", "condicao_clima") == [("a", "Fraca"), ("b", "Muito Forte")]
    same_as_full(lake)


def test_a_replaced_file_takes_its_months_along(lake, load):
    load("clima_pluviometria", reading("k1", "2024-01-10", 4.0))
    load("viagens_onibus", trip("a", "2024-01-10"), trip("b", "2024-02-10"), name="x.csv", run=RUN)
    load("viagens_onibus", trip("z", "2024-05-10"))
    first = jobs.build_silver(lake)
    load("viagens_onibus", trip("a", "2024-01-10", minutes=44), trip("b", "2024-03-10"), name="x.csv", run=RUN)
    second = jobs.build_silver(lake)
    assert months(lake) == {"m2024-01": second, "m2024-03": second, "m2024-05": first}
    jobs.build_gold(lake)
    assert rows(jobs.read_gold(lake, jobs.FACT), "id_viagem", "tempo_viagem") == [("a", 44), ("b", 30), ("z", 30)]
    same_as_full(lake)


def test_copies_in_other_months_are_decided_again(lake, load):
    options = jobs.SilverOptions(deduplicate=True)
    load("clima_pluviometria", reading("k1", "2024-01-10", 4.0))
    load("viagens_onibus", trip("a", "2024-01-10"), trip("b", "2024-01-11"), trip("c", "2024-02-01"))
    first = jobs.build_silver(lake, options)
    load("viagens_onibus", trip("a", "2024-04-10", minutes=50))
    second = jobs.build_silver(lake, options)
    assert months(lake) == {"m2024-01": second, "m2024-02": first, "m2024-04": second}
    got = same_as_full(lake, options)
    assert [(str(r[0]), r[1]) for r in got] == [("2024-01-11", "b"), ("2024-02-01", "c"), ("2024-04-10", "a")]


def test_other_options_build_everything(lake, load):
    load("clima_pluviometria", reading("k1", "2024-01-10", 4.0))
    load("viagens_onibus", trip("a", "2024-01-10"), trip("b", "2024-02-10", minutes=999))
    jobs.build_silver(lake)
    third = jobs.build_silver(lake, jobs.SilverOptions(minutes=(1, 300)))
    assert months(lake) == {"m2024-01": third}


def test_one_publication_binds_old_and_new_months(lake, load):
    load("clima_pluviometria", reading("k1", "2024-01-10", 4.0))
    load("viagens_onibus", trip("a", "2024-01-10"), trip("b", "2024-02-10"))
    jobs.build_silver(lake)
    store = lake.silver_store("stg_viagens")
    first, then = store.last(), store.current()
    load("viagens_onibus", trip("c", "2024-02-10"), trip("d", "2024-03-10"))
    jobs.build_silver(lake)
    jobs.build_gold(lake)
    assert jobs.read_silver(lake).count() == 4 and jobs.read_silver(lake, as_of=first).count() == 2
    store.restore(first)
    assert store.current() == then and rows(jobs.read_silver(lake), "id_viagem") == [("a",), ("b",)]
    jobs.build_gold(lake)
    assert rows(jobs.read_gold(lake, jobs.FACT), "id_viagem") == [("a",), ("b",)]
    jobs.register_views(lake, [])
    assert lake.spark.table("silver.viagens_processadas").count() == lake.spark.table("gold.fato_viagens").count() == 2


def test_a_build_reads_bronze_once(lake, load, monkeypatch):
    load("clima_pluviometria", reading("k1", "2024-01-10", 4.0))
    load("viagens_onibus", trip("a", "2024-01-10"))
    read, real = [], jobs.read_bronze

    def counted(lake, dataset, *args, **options):
        read.append(dataset)
        df = real(lake, dataset, *args, **options)
        monkeypatch.setattr(type(df), "count", lambda self: pytest.fail("trips counted again"), raising=False) if dataset == "viagens_onibus" else None
        return df

    monkeypatch.setattr(jobs, "read_bronze", counted)
    monkeypatch.setattr(jobs, "_hourly_of", lambda lake, months: (lake.spark.createDataFrame([], "data_particao date, hora_medicao int, avg_chuva_1h double"), 0))
    jobs.build_silver(lake)
    monkeypatch.undo()
    assert sorted(read) == ["clima_pluviometria", "viagens_onibus"] and jobs.read_silver(lake).count() == 1


def test_months_as_ranges_of_dates(spark):
    days = [date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 31), date(2024, 2, 29), date(2024, 4, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for parts in (["m2023-12"], ["m2024-01", "m2024-02"], ["m2023-12", "m2024-01", "m2024-04"], [changes.NO_MONTH], []):
        want = {d for d in days if (f"m{d:%Y-%m}" if d else changes.NO_MONTH) in parts}
        assert {r.d for r in df.where(changes.in_months("d", parts)).collect()} == want


# --- The fact's layout -----------------------------------------------------------


def test_bits_come_in_turn(spark):
    df = spark.createDataFrame([(a, b) for a in (0, 1, 5, 31) for b in (0, 1, 40, 63)], "a int, b int")
    got = df.select("a", "b", clustering.interleaved(F.col("a"), F.col("b"), 5, 6).alias("z")).collect()
    for r in got:
        bits = "".join(x for pair in zip(f"{r.a:06b}", f"{r.b:06b}", strict=True) for x in pair)[1:]
        assert r.z == int(bits, 2)
    assert len({r.z for r in got}) == 16


def wide_rows(spark, trips):
    """Trips of one month over 30 days and 200 lines, a third of them on one line."""
    n = F.col("id")
    line = F.when(n % 3 == 0, "L000").otherwise(F.format_string("L%03d", F.pmod(F.xxhash64(n), F.lit(200))))
    return spark.range(trips).select(
        F.date_add(F.lit(date(2024, 6, 1)), F.pmod(F.hash(n), F.lit(30)).cast("int")).alias("data_viagem"), n.cast("string").alias("id_viagem"),
        line.alias("linha"), F.lit("A").alias("consorcio"), F.lit("Dia Útil").alias("tipo_dia"), F.lit(1.0).alias("distancia_planejada"),
        F.lit(30).alias("tempo_viagem"), F.lit(6).alias("hora_partida"), F.lit(False).alias("is_weekend"), F.lit(0.0).alias("chuva_no_horario"),
        F.lit("Sem Chuva").alias("condicao_clima"), F.lit("lote").alias("origem"), F.lit("m2024-06").alias("parte"), F.lit("v1").alias("carga"),
    )


def test_a_question_opens_few_files(spark, tmp_path):
    store = Store(spark, str(tmp_path / "gold"))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wide = wide_rows(spark, 30_000)
        store.write_slots(clustering.clustered_fact(wide), changes.KEYS, clustering.FACT)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    slot = {"origem=lote/parte=m2024-06": "v1"}
    for _ in range(2):  # a repeated write replaces itself
        clustering.write_statistics(store, store.read_slots(slot, clustering.FACT))
    store.publish_set([(f"{clustering.FACT}/{s}", v, None) for s, v in slot.items()])
    everything = clustering.fact_files(store)
    assert len(everything) >= 50 and store.read_slots(slot, clustering.FILES).count() == len(everything)

    week, line = (date(2024, 6, 3), date(2024, 6, 6)), "L120"
    files = clustering.fact_files(store, week, [line])
    assert len(files) <= 0.25 * len(everything)
    got = clustering.read_fact(store, week, [line])
    want = wide.where((F.col("data_viagem").between(*[F.lit(d) for d in week])) & (F.col("linha") == line))
    assert rows(got, "id_viagem") == rows(want, "id_viagem") and got.count()
    assert len(got.inputFiles()) == len(files)
    assert len(clustering.fact_files(store, week)) <= 0.5 * len(everything)
    assert len(clustering.fact_files(store, lines=[line])) <= 0.5 * len(everything)
    assert clustering.read_fact(store, (date(2030, 1, 1), date(2030, 1, 2))).count() == 0
    assert clustering.read_fact(store, lines=[]).count() == 0
    # The line with a third of the trips fills many files, none much larger than the others.
    sizes = sorted(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in everything)
    assert sizes[-1] <= 4 * sizes[len(sizes) // 2]


def test_silver_is_written_in_the_facts_order_and_the_fact_is_not_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(clustering, "FILE_ROWS", 1_000)
    wide = wide_rows(spark, 30_000)
    trips, slots = wide.drop(*changes.KEYS, "carga"), [*changes.KEYS, "carga"]
    bounds = clustering.line_bounds(trips)
    assert bounds == sorted(set(bounds)) and len(bounds) == clustering.LINE_RANGES - 1
    silver_store, store = Store(spark, str(tmp_path / "silver")), Store(spark, str(tmp_path / "gold"))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = clustering.dealt_by_month(trips, trips, bounds)
        silver_store.write_slots(clustering.in_order(dealt.withColumns({c: F.lit(v) for c, v in zip(slots, ("lote", "m2024-06", "v1"), strict=True)}), bounds), changes.KEYS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    slot = {"origem=lote/parte=m2024-06": "v1"}
    fact = clustering.fact_rows(silver_store.read_slots(slot))
    assert "Exchange" not in plan(fact) and "Join" not in plan(clustering.clustered_fact(wide))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")  # a task for each file, as large files have
    try:
        store.write_slots(fact, changes.KEYS, clustering.FACT, as_they_come=True)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    written = store.read_slots(slot, clustering.FACT)
    assert rows(written.select(*fact.columns)) == rows(fact)
    clustering.write_statistics(store, written)
    store.publish_set([(f"{clustering.FACT}/{s}", v, None) for s, v in slot.items()])
    everything = clustering.fact_files(store)
    assert len(everything) >= 15
    assert len(clustering.fact_files(store, (date(2024, 6, 3), date(2024, 6, 6)), ["L120"])) <= 0.35 * len(everything)
    # Inside a file the interleaved number never falls.
    number = clustering.trip_number(F.col("data_id"), F.col("linha"), bounds)
    for file in everything:
        seen = [r[0] for r in spark.read.parquet(file).select(number).collect()]
        assert seen == sorted(seen)


def test_places_of_lines(spark):
    lines = ["a", "b", "c", "d", None, "Z", "e"]
    df = spark.createDataFrame([(x,) for x in lines], "linha string")
    for bounds in ([], ["b"], ["a", "c"], ["Z", "a", "b", "c", "d"]):
        got = df.select("linha", clustering.line_place(F.col("linha"), bounds).alias("n")).collect()
        assert all(r.n == (sum(b < r.linha for b in bounds) if r.linha else 0) for r in got)
