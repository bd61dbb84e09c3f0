from datetime import date, datetime

from conftest import rows
from pyspark.sql import functions as F
from test_ingest import RAIN, TRIPS, put, reading, trip

from rainroute.plans import jobs, silver
from rainroute.sources import proxy
from rainroute.sources.versions import Store
from rainroute.streaming import trips as trips_stream


def hourly_frame(spark, mm):
    return spark.createDataFrame(
        [(date(2024, 3, 25), 6, mm)], "data_particao date, hora_medicao int, avg_chuva_1h double"
    )


def test_csv_trips_are_enriched_and_new_rain_is_used_for_new_files(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / d) for d in ("in", "out", "cp"))
    put(inbox, "a.csv", TRIPS, trip("a", hour=6), trip("b", hour=9))

    def pull(mm):
        stream = trips_stream.csv_stream(spark, inbox, "viagens_onibus")
        trips_stream.write_enriched(stream, lambda: (hourly_frame(spark, mm), 1), out, checkpoint)
        return rows(spark.read.parquet(out), "id_viagem", "chuva_no_horario", "condicao_clima")

    first = [("a", 4.0, "Fraca"), ("b", 0.0, "Sem Chuva")]
    assert pull(4.0) == first
    assert pull(99.0) == first  # nothing new: nothing written again
    put(inbox, "b.csv", TRIPS, trip("c", hour=6))
    assert pull(60.0) == [*first, ("c", 60.0, "Muito Forte")]

    late = silver.reenrich(spark.read.parquet(out), hourly_frame(spark, 30.0), 1)
    assert late.columns == list(silver.SILVER_COLUMNS)
    assert rows(late, "id_viagem", "chuva_no_horario", "condicao_clima") == [
        ("a", 30.0, "Forte"), ("b", 0.0, "Sem Chuva"), ("c", 30.0, "Forte")]


def test_stream_equals_batch(spark, tiny, tmp_path):
    schema = proxy.table(spark, tiny, "lineitem").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(tiny)
    hourly = silver.hourly_rain(proxy.rain(spark, tiny))
    trips_stream.write_enriched(
        proxy.trips(spark, tiny, lineitem=source), lambda: (hourly, 1000), str(tmp_path / "out"), str(tmp_path / "cp")
    )
    batch = silver.silver_trips(proxy.trips(spark, tiny), proxy.rain(spark, tiny))
    got = spark.read.parquet(str(tmp_path / "out")).select(*batch.columns)
    key = ["id_viagem", "tempo_viagem", "condicao_clima", F.round("chuva_no_horario", 6)]
    assert got.select(*key).exceptAll(batch.select(*key)).count() == 0
    assert got.count() == batch.count()


def test_hours_become_final_once_the_watermark_passes(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / d) for d in ("in", "out", "cp"))
    schema = "ts timestamp_ntz, kind string"

    def add(*times):
        spark.createDataFrame([(datetime(2024, 1, 1, h, m), "x") for h, m in times], schema).coalesce(
            1
        ).write.mode("append").parquet(folder)

    def pull():
        stream = spark.readStream.schema(schema).parquet(folder)
        trips_stream.write_available(
            trips_stream.hourly_counts(stream, "ts", "kind", "1 hour"), out, checkpoint
        )
        return rows(spark.read.parquet(out), "inicio", "total")

    add((5, 10), (5, 50), (7, 30))
    assert pull() == [(datetime(2024, 1, 1, 5), 2)]
    add((5, 55), (9, 5))  # 05:55 is later than the watermark allows
    assert pull() == [(datetime(2024, 1, 1, 5), 2), (datetime(2024, 1, 1, 7), 1)]


def test_all_hours_are_published_late_events_included(spark, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    schema = "ts timestamp_ntz, kind string"
    store = Store(spark, str(tmp_path / "out"))

    def add(*times):
        spark.createDataFrame([(t and datetime(2024, 1, *t), "x") for t in times], schema).coalesce(
            1
        ).write.mode("append").parquet(folder)

    def pull():
        stream = spark.readStream.schema(schema).parquet(folder)
        trips_stream.write_touched(stream, store, checkpoint, "ts", "kind")
        return [(r.inicio and (r.inicio.day, r.inicio.hour), r.total) for r in store.read().orderBy("inicio").collect()]

    add((1, 5, 10), (1, 5, 50), (2, 7, 30))
    assert pull() == [((1, 5), 2), ((2, 7), 1)]
    first = store.current()
    add((1, 5, 55), (1, 9, 5), None)
    assert pull() == [(None, 1), ((1, 5), 3), ((1, 9), 1), ((2, 7), 1)]
    now = store.current()
    assert now["dia=d2024-01-02"] == first["dia=d2024-01-02"] and now["dia=d2024-01-01"] != first["dia=d2024-01-01"]
    assert pull() == [(None, 1), ((1, 5), 3), ((1, 9), 1), ((2, 7), 1)]  # nothing new: nothing counted again


def test_a_repeated_batch_counts_once(spark, tmp_path):
    """The last commit is taken back, as if the run had died just before it."""
    folder, checkpoint, store = str(tmp_path / "in"), tmp_path / "cp", Store(spark, str(tmp_path / "out"))
    spark.createDataFrame([(datetime(2024, 1, 1, 5), "x")] * 3, "ts timestamp_ntz, kind string").write.parquet(folder)

    def pull():
        stream = spark.readStream.schema("ts timestamp_ntz, kind string").parquet(folder)
        trips_stream.write_touched(stream, store, str(checkpoint), "ts", "kind")
        return [r.total for r in store.read().collect()]

    assert pull() == [3]
    for done in (checkpoint / "commits").iterdir():
        done.unlink()
    assert pull() == [3] and store.history().count() == 1


def test_a_new_checkpoint_adds_to_what_was_streamed(spark, tmp_path):
    out = str(tmp_path / "out")
    for name in ("a", "b"):
        put(str(tmp_path / name), f"{name}.csv", TRIPS, trip(f"{name}1"), trip(f"{name}2"))
        stream = trips_stream.csv_stream(spark, str(tmp_path / name), "viagens_onibus")
        trips_stream.write_enriched(stream, lambda: (hourly_frame(spark, 4.0), 1), out, str(tmp_path / f"cp-{name}"))
    assert rows(spark.read.parquet(out), "id_viagem") == [("a1",), ("a2",), ("b1",), ("b2",)]
    lake = jobs.Lake.under(spark, str(tmp_path / "lake"))
    trips_stream.publish_enriched(lake, out)
    view = spark.table("silver.viagens_processadas")
    assert tuple(view.columns) == silver.SILVER_COLUMNS and view.count() == 4
    assert trips_stream.publish_enriched(lake, out) is None and jobs.read_silver(lake).count() == 4


def test_streamed_trips_stand_beside_batch(spark, tmp_path):
    lake, out = jobs.Lake.under(spark, str(tmp_path / "lake")), str(tmp_path / "out")
    put(str(tmp_path / "t"), "t.csv", TRIPS, *[trip(f"t{i}") for i in range(6000)])
    put(str(tmp_path / "r"), "r.csv", RAIN, reading("k1", 4.0))
    for name, folder in (("viagens_onibus", "t"), ("clima_pluviometria", "r")):
        jobs.ingest(lake, jobs.Dataset(name, str(tmp_path / folder)), date(2024, 3, 26))
    jobs.build_silver(lake)
    store = lake.silver_store("stg_viagens")
    before = store.last()

    def stream(name, *lines):
        put(str(tmp_path / name), f"{name}.csv", TRIPS, *lines)
        arriving = trips_stream.csv_stream(spark, str(tmp_path / name), "viagens_onibus")
        trips_stream.write_enriched(arriving, lambda: (hourly_frame(spark, 4.0), 1), out, str(tmp_path / f"cp-{name}"))
        return trips_stream.publish_enriched(lake, out)

    stream("a", *[trip(f"s{i}") for i in range(10)], trip("t5"), trip("s1", 44))
    assert jobs.read_silver(lake).count() == spark.table("silver.viagens_processadas").count() == 6010
    stream("b", trip("s3"), trip("t7"))  # all known: the batch is done and shows nothing
    assert jobs.read_silver(lake).count() == 6010 and trips_stream.publish_enriched(lake, out) is None
    jobs.build_gold(lake)
    assert jobs.read_gold(lake, jobs.FACT).count() == 6010

    # A batch load that brings some of them takes them over, in the same publication.
    put(str(tmp_path / "t2"), "t2.csv", TRIPS, trip("s0", 99), trip("s1", 99), trip("new"))
    jobs.ingest(lake, jobs.Dataset("viagens_onibus", str(tmp_path / "t2")), date(2024, 3, 27))
    jobs.build_silver(lake)
    jobs.build_gold(lake)
    got = jobs.read_silver(lake)
    assert got.count() == 6011 and got.select("id_viagem").distinct().count() == 6011
    assert rows(got.filter("id_viagem IN ('s0', 's1')"), "id_viagem", "tempo_viagem") == [("s0", 99), ("s1", 99)]
    assert jobs.read_gold(lake, jobs.FACT).count() == 6011

    store.restore(before)
    assert jobs.read_silver(lake).count() == 6000
    jobs.build_gold(lake)
    assert jobs.read_gold(lake, jobs.FACT).count() == 6000


# --- Rain that comes late ---------------------------------------------------------


def late_streams(spark, root):
    trip_schema = "data date, id_viagem string, servico string, consorcio string, tipo_dia string, distancia_planejada double, tempo_viagem int, datetime_partida timestamp"
    rain_schema = "data_particao date, horario string, acumulado_chuva_1_h double"

    def add(name, *records):
        schema = trip_schema if name == "trips" else rain_schema
        spark.createDataFrame(list(records), schema).coalesce(1).write.mode("append").parquet(f"{root}/{name}")

    def pull():
        trips, rain = (spark.readStream.schema(s).parquet(f"{root}/{n}") for n, s in (("trips", trip_schema), ("rain", rain_schema)))
        query = trips_stream.write_closed(trips_stream.wait_for_rain(trips, rain, "1 hour", "2 hours"), f"{root}/out", f"{root}/cp")
        return query, rows(spark.read.parquet(f"{root}/out"), "id_viagem", "chuva_no_horario", "condicao_clima")

    return add, pull


def departure(key, hour, minute=10, day=25):
    return (date(2024, 3, day), key, "100", "A", "Dia Útil", 1.0, 30, None if hour is None else datetime(2024, 3, day, hour, minute))


def test_trips_wait_until_their_hour_has_closed(spark, tmp_path):
    add, pull = late_streams(spark, str(tmp_path))
    add("trips", departure("a", 6), departure("b", 7), departure("none", None))
    add("rain")
    assert pull()[1] == [("none", 0.0, "Sem Chuva")]  # without departure there is nothing to wait for
    add("rain", (date(2024, 3, 25), "06:15:00", 4.0), (date(2024, 3, 25), "06:45:00", 8.0))
    assert pull()[1] == [("none", 0.0, "Sem Chuva")]  # hour 6 is open: more may come
    add("rain", (date(2024, 3, 25), "06:30:00", 6.0), (date(2024, 3, 25), "09:30:00", 60.0))
    add("trips", departure("c", 9), departure("d", 9, 50))
    closed = [("a", 6.0, "Moderada"), ("none", 0.0, "Sem Chuva")]
    assert pull()[1] == closed  # the watermark is at 07:30
    add("rain", (date(2024, 3, 26), "09:00:00", 1.0))
    add("trips", departure("far", 9, day=26))
    query, got = pull()
    assert got == [closed[0], ("b", 0.0, "Sem Chuva"), ("c", 60.0, "Muito Forte"), ("d", 60.0, "Muito Forte"), closed[1]]
    kept = [o["numRowsTotal"] for o in query.lastProgress["stateOperators"]]
    assert max(kept) <= 1  # of all closed hours nothing is left: one trip and one reading are open


def test_waiting_trips_are_packed_by_hour_and_kept_on_disk(spark, tmp_path):
    add, pull = late_streams(spark, str(tmp_path))
    waiting = [departure(f"t{i:03d}", 6, i % 60) for i in range(400)]
    add("trips", *waiting, waiting[0], (*waiting[1][:3], None, *waiting[1][4:]), departure("none", None))
    add("rain")
    settings = [spark.conf.get(k, None) for k in trips_stream.STATE]
    query, got = pull()
    assert got == [("none", 0.0, "Sem Chuva")]
    kept = query.lastProgress["stateOperators"]
    assert 0 < sum(o["numRowsTotal"] for o in kept) <= trips_stream.PARTS
    assert all(any(m.startswith("rocksdb") for m in o["customMetrics"]) for o in kept)
    assert [spark.conf.get(k, None) for k in trips_stream.STATE] == settings
    add("trips", departure("late", 6, 59), departure("far", 9, day=26))  # a second batch of the same hour
    add("rain", (date(2024, 3, 25), "06:15:00", 4.0), (date(2024, 3, 26), "09:00:00", 1.0))
    found = sorted([w[1] for w in [*waiting, *waiting[:2]]] + ["late"])
    assert sorted(pull()[1], key=str) == sorted([("none", 0.0, "Sem Chuva"), *[(i, 4.0, "Fraca") for i in found]], key=str)


def test_late_rain_equals_the_batch_build(spark, tiny):
    from rainroute.checks.registry import REGISTRY

    got, want = REGISTRY["stream_late_rain"](spark, tiny), REGISTRY["silver_trips"](spark, tiny)
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0


def test_a_bad_cell_does_not_stop_a_lenient_stream(spark, tmp_path):
    put(str(tmp_path / "in"), "a.csv", TRIPS, trip("a1"), trip("a2", minutes="xx"), trip("a3") + ",extra")
    stream = trips_stream.csv_stream(spark, str(tmp_path / "in"), "viagens_onibus", mode="lenient")
    trips_stream.write_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got.filter("_rejeitos IS NULL"), "id_viagem") == [("a1",)]
    assert got.filter("_rejeitos IS NOT NULL").count() == 2
