import glob
import gzip
import os
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rainroute.contracts import CONTRACTS
from rainroute.operators.quality import ExpectationError
from rainroute.plans import jobs, questions, silver
from rainroute.sources import catalog, csv_files
from rainroute.sources.versions import NotPublished, Store, write_files

RUN = date(2024, 3, 5)
TRIPS = (
    "data,consorcio,tipo_dia,id_empresa,id_veiculo,id_viagem,servico,shape_id,sentido,datetime_partida,"
    "datetime_chegada,tempo_viagem,distancia_planejada,perc_conformidade_shape,perc_conformidade_registros,"
    "versao_modelo"
)
RAIN = (
    "primary_key,id_estacao,acumulado_chuva_15_min,acumulado_chuva_1_h,acumulado_chuva_4_h,"
    "acumulado_chuva_24_h,acumulado_chuva_96_h,horario,data_particao"
)


def trip(key, minutes=30, hour=6, consortium="Intersul"):
    return (
        f"2024-03-25,{consortium},Dia Útil,E1,V1,{key},100,S1,I,2024-03-25 {hour:02d}:10:00,"
        f"2024-03-25 07:00:00,{minutes},12.5,99.1,98.0,abc"
    )


def reading(key, mm, clock="06:00:00"):
    return f"{key},1,0.2,{mm},1.0,2.0,3.0,{clock},2024-03-25"


def put(folder, name, header, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
        out.write("\n".join([header, *lines]) + "\n")


@pytest.fixture
def lake(spark, tmp_path):
    return jobs.Lake.under(spark, str(tmp_path / "lake"))


@pytest.fixture
def inbox(tmp_path):
    return str(tmp_path / "inbox")


def load(lake, name, folder, run=RUN, **options):
    return jobs.ingest(lake, jobs.Dataset(name, folder, **options), run)


def test_only_csv_files_in_any_case_each_kept_apart(lake, inbox):
    put(inbox, "A.CSV", TRIPS, trip("a1"), trip("a2"))
    put(inbox, "b.csv", TRIPS, trip("b1"))
    put(inbox, "notes.txt", "not,a,csv")
    result = load(lake, "viagens_onibus", inbox)
    assert (result.status, result.rows) == ("published", 3)
    df = jobs.read_bronze(lake, "viagens_onibus")
    assert rows(df.groupBy("_arquivo", "ano", "mes", "dia").count()) == [("A.CSV", 2024, 3, 5, 2), ("b.csv", 2024, 3, 5, 1)]
    assert df.columns[:16] == CONTRACTS["viagens_onibus"].schema.names
    assert os.path.isdir(f"{lake.bronze}/viagens_onibus/ano=2024/mes=03/dia=05")


def test_landing_keeps_the_lines_of_each_file(spark, lake, inbox):
    put(inbox, "A.CSV", TRIPS, trip("a1"), trip("a2"))
    put(inbox, "b.csv", TRIPS, trip("b1"))
    load(lake, "viagens_onibus", inbox)
    folder = f"{lake.landing}/viagens_onibus/2024/03/05/arquivo=A.CSV"
    assert [r[0] for r in spark.read.text(folder).collect()] == [TRIPS, trip("a1"), trip("a2")]


@pytest.mark.parametrize("make", [False, True])
def test_nothing_to_load_is_skipped(lake, inbox, make):
    if make:
        put(inbox, "readme.txt", "x")
    assert load(lake, "viagens_onibus", inbox).status == "skipped"
    assert load(lake, "viagens_onibus", None).status == "skipped"
    with pytest.raises(NotPublished):
        jobs.read_bronze(lake, "viagens_onibus")


def test_a_file_without_rows_fails_the_audit_and_publishes_nothing(lake, inbox, tmp_path):
    put(inbox, "only.csv", TRIPS)
    with pytest.raises(jobs.AuditError, match="no data rows"):
        load(lake, "viagens_onibus", inbox)
    put(inbox, "full.csv", TRIPS, trip("x"))
    with pytest.raises(jobs.AuditError, match="only.csv"):
        load(lake, "viagens_onibus", inbox)
    with pytest.raises(NotPublished):
        jobs.read_bronze(lake, "viagens_onibus")
    good = str(tmp_path / "good")
    put(good, "g.csv", TRIPS, trip("g"))
    load(lake, "viagens_onibus", good)
    with pytest.raises(jobs.AuditError):
        load(lake, "viagens_onibus", inbox)
    assert rows(jobs.read_bronze(lake, "viagens_onibus"), "id_viagem") == [("g",)]


def test_same_run_date_again_replaces_another_adds(lake, inbox):
    put(inbox, "a.csv", TRIPS, trip("a1"), trip("a2"))
    load(lake, "viagens_onibus", inbox)
    before = rows(jobs.read_bronze(lake, "viagens_onibus").drop("carga"))
    load(lake, "viagens_onibus", inbox)
    assert rows(jobs.read_bronze(lake, "viagens_onibus").drop("carga")) == before
    load(lake, "viagens_onibus", inbox, date(2024, 3, 6))
    assert jobs.read_bronze(lake, "viagens_onibus").count() == 4
    single = jobs.read_bronze(lake, "viagens_onibus", deduplicate=True)
    assert rows(single, "id_viagem", "dia") == [("a1", 6), ("a2", 6)]


def test_bad_cell_strict_and_lenient(lake, inbox):
    put(inbox, "a.csv", TRIPS, trip("a1"), trip("a2", minutes="xx"), trip("a3") + ",extra")
    with pytest.raises(Exception, match="bad cell|[Mm]alformed"):
        load(lake, "viagens_onibus", inbox)
    result = load(lake, "viagens_onibus", inbox, mode="lenient")
    assert (result.rows, result.rejected) == (1, 2)
    assert rows(jobs.read_bronze(lake, "viagens_onibus"), "id_viagem") == [("a1",)]
    kept = {c["coluna"]: c["valor"] for r in jobs.read_rejects(lake, "viagens_onibus").collect() for c in r["_rejeitos"]}
    assert kept["tempo_viagem"] == "xx" and kept["*"].endswith(",extra")


def test_columns_by_name_and_unknown_ones_reported(lake, inbox):
    names = TRIPS.split(",")
    swapped = [names[5], *names[:5], *names[6:], "nova"]
    cells = dict(zip(names, trip("a1").split(",")))
    put(inbox, "a.csv", ",".join(swapped), ",".join([*[cells[n] for n in swapped[:-1]], "1"]))
    result = load(lake, "viagens_onibus", inbox)
    assert result.unknown_columns == ("nova",)
    assert rows(jobs.read_bronze(lake, "viagens_onibus"), "id_viagem", "tempo_viagem") == [("a1", 30)]


def test_files_with_different_headers_are_each_fitted(lake, inbox):
    names = TRIPS.split(",")
    cells = dict(zip(names, trip("b1").split(",")))
    swapped = [names[5], *names[:5], *names[6:], "nova"]
    put(inbox, "a.csv", TRIPS, trip("a1"))
    put(inbox, "b.csv", ",".join(swapped), ",".join([*[cells[n] for n in swapped[:-1]], "1"]))
    put(inbox, "c.csv", TRIPS.replace(",", ";"), trip("c1").replace(",", ";"))
    result = load(lake, "viagens_onibus", inbox)
    assert (result.rows, result.unknown_columns) == (3, ("nova",))
    got = rows(jobs.read_bronze(lake, "viagens_onibus"), "id_viagem", "_arquivo", "tempo_viagem")
    assert got == [("a1", "a.csv", 30), ("b1", "b.csv", 30), ("c1", "c.csv", 30)]


def test_a_missing_column_names_the_file(lake, inbox):
    put(inbox, "a.csv", TRIPS, trip("a1"))
    put(inbox, "b.csv", TRIPS.replace("data,", "", 1), trip("b1").split(",", 1)[1])
    with pytest.raises(ValueError, match="b.csv has no column data"):
        load(lake, "viagens_onibus", inbox)
    with pytest.raises(NotPublished):
        jobs.read_bronze(lake, "viagens_onibus")


def test_a_second_delivery_of_a_date_keeps_the_other_files(spark, lake, tmp_path):
    first, second, third = (str(tmp_path / d) for d in ("one", "two", "three"))
    put(first, "a.csv", TRIPS, trip("a1"), trip("a2"))
    put(first, "it's.csv", TRIPS, trip("q1"))
    put(second, "b.csv", TRIPS, trip("b1"))
    put(third, "a.csv", TRIPS, trip("a3"))
    put(third, "it's.csv", TRIPS, trip("q2"))
    seen = []
    for folder in (first, second, third):
        load(lake, "viagens_onibus", folder)
        seen.append(rows(jobs.read_bronze(lake, "viagens_onibus"), "id_viagem"))
    assert seen == [[("a1",), ("a2",), ("q1",)], [("a1",), ("a2",), ("b1",), ("q1",)], [("a3",), ("b1",), ("q2",)]]
    jobs.register_bronze(lake, "viagens_onibus")
    assert rows(spark.table("bronze.viagens_onibus"), "id_viagem") == seen[-1]
    by_file = spark.table("bronze.viagens_onibus_linhagem").groupBy("_arquivo", "dia").count()
    assert rows(by_file) == [("a.csv", 5, 1), ("b.csv", 5, 1), ("it's.csv", 5, 1)]
    landing = spark.read.text(f"{lake.landing}/viagens_onibus/2024/03/05")
    assert rows(landing.filter(F.col("value") != TRIPS), "arquivo") == [("a.csv",), ("b.csv",), ("it's.csv",)]
    store = lake.bronze_store("viagens_onibus")
    first_load = store.history().orderBy("ordem").first()["ordem"]
    assert rows(jobs.read_bronze(lake, "viagens_onibus", as_of=first_load), "id_viagem") == seen[0]
    store.rollback("ano=2024/mes=03/dia=05/_arquivo=a.csv")
    assert rows(jobs.read_bronze(lake, "viagens_onibus"), "id_viagem") == [("a1",), ("a2",), ("b1",), ("q2",)]


def test_landing_survives_a_failed_audit(spark, lake, inbox, tmp_path):
    put(inbox, "a.csv", TRIPS, trip("a1"))
    load(lake, "viagens_onibus", inbox)
    bad = str(tmp_path / "bad")
    put(bad, "a.csv", TRIPS)
    with pytest.raises(jobs.AuditError):
        load(lake, "viagens_onibus", bad)
    folder = f"{lake.landing}/viagens_onibus/2024/03/05/arquivo=a.csv"
    assert [r[0] for r in spark.read.text(folder).collect()] == [TRIPS, trip("a1")]
    assert rows(jobs.read_bronze(lake, "viagens_onibus"), "id_viagem") == [("a1",)]


def test_missing_column_is_refused(lake, inbox):
    put(inbox, "a.csv", RAIN.replace(",horario", ""), "k,1,0,0,0,0,0,2024-01-01")
    with pytest.raises(ValueError, match="horario"):
        load(lake, "clima_pluviometria", inbox)


def test_separator_quotes_and_line_breaks(spark, lake, inbox):
    line = 'k1;1;0.2;"1.5";1;2;3;7:05;2024-03-25'
    put(inbox, "a.csv", "﻿" + RAIN.replace(",", ";"), line, 'k"" 2;1;;;;;;;')
    load(lake, "clima_pluviometria", inbox)
    got = rows(jobs.read_bronze(lake, "clima_pluviometria"), "acumulado_chuva_1_h", "horario")
    assert got == [(None, None), (1.5, "07:05:00")]
    folder = inbox + "2"
    put(folder, "a.csv", "id_estacao,estacao", '1,"a, ""b""\nc"')
    header = csv_files.read_header(spark, f"{folder}/a.csv")
    df = csv_files.read_csv(spark, folder, header, multiline=True)
    assert rows(df, "estacao") == [('a, "b"\nc',)]


def test_repeated_header_names_are_refused(spark, inbox):
    put(inbox, "a.csv", "a,b,A", "1,2,3")
    with pytest.raises(ValueError, match="repeated"):
        csv_files.read_header(spark, f"{inbox}/a.csv")


def test_inferred_types_without_a_contract(spark, inbox):
    put(inbox, "a.csv", "col1,col2", "1,2024-01-01", "2,2024-01-02")
    assert dict(csv_files.infer_csv(spark, inbox).dtypes) == {"col1": "int", "col2": "date"}


def test_one_bad_dataset_does_not_stop_the_others(lake, tmp_path):
    put(str(tmp_path / "t"), "t.csv", TRIPS, trip("a"))
    put(str(tmp_path / "r"), "r.csv", RAIN, reading("k", "wet"))
    datasets = [
        jobs.Dataset("viagens_onibus", str(tmp_path / "t")),
        jobs.Dataset("clima_pluviometria", str(tmp_path / "r")),
        jobs.Dataset("estacoes_clima", None),
    ]
    results = {r.dataset: r for r in jobs.load_datasets(lake, datasets, RUN)}
    assert {n: r.status for n, r in results.items()} == {
        "viagens_onibus": "published", "clima_pluviometria": "failed", "estacoes_clima": "skipped"}
    with pytest.raises(jobs.JobFailed, match="clima_pluviometria.*wet"):
        jobs.run(lake, datasets, RUN)
    assert jobs.read_bronze(lake, "viagens_onibus").count() == 1


def test_failed_attempt_is_retried_once(lake, tmp_path, monkeypatch):
    put(str(tmp_path / "t"), "t.csv", TRIPS, trip("a"))
    calls, real = [], jobs.ingest

    def flaky(*args):
        calls.append(1)
        if len(calls) == 1:
            raise OSError("lost")
        return real(*args)

    monkeypatch.setattr(jobs, "ingest", flaky)
    (result,) = jobs.load_datasets(lake, [jobs.Dataset("viagens_onibus", str(tmp_path / "t"))], RUN)
    assert (result.status, len(calls)) == ("published", 2)


def test_the_whole_run_ends_in_queryable_views(spark, lake, tmp_path):
    put(str(tmp_path / "t"), "t.csv", TRIPS, trip("a", 30, 6), trip("b", 50, 6, "Internorte"), trip("c", 10, 9))
    put(str(tmp_path / "r"), "r.csv", RAIN, reading("k1", 4.0), reading("k2", 8.0))
    datasets = [
        jobs.Dataset("viagens_onibus", str(tmp_path / "t")),
        jobs.Dataset("clima_pluviometria", str(tmp_path / "r")),
    ]
    for _ in range(2):  # a second run of the same date changes nothing
        jobs.run(lake, datasets, RUN)
        assert spark.table("bronze.viagens_onibus").columns == CONTRACTS["viagens_onibus"].schema.names
        assert spark.table("bronze.viagens_onibus").count() == 3
        assert spark.table("silver.viagens_processadas").count() == 3
        means = spark.sql("SELECT clima_id, avg(tempo_viagem) FROM gold.fato_viagens GROUP BY clima_id")
        assert rows(means) == [("Moderada", 40.0), ("Sem Chuva", 10.0)]
        star = spark.sql(
            "SELECT c.nome_consorcio, w.desc_intensidade, d.desc_categoria_dia, count(*) FROM gold.fato_viagens f "
            "JOIN gold.dim_consorcio c USING (consorcio_id) JOIN gold.dim_clima w USING (clima_id) "
            "JOIN gold.dim_calendario d USING (data_id) GROUP BY ALL"
        )
        assert rows(star) == [
            ("Internorte", "Moderada", "Dia Útil", 1),
            ("Intersul", "Moderada", "Dia Útil", 1),
            ("Intersul", "Sem Chuva", "Dia Útil", 1),
        ]
    fact = jobs.read_gold(lake, "fato_desempenho_viagem")
    assert rows(questions.rain_volume(fact)) == [("Moderada", 2), ("Sem Chuva", 1)]


def test_silver_by_month(lake, tmp_path):
    put(str(tmp_path / "t"), "t.csv", TRIPS, trip("a"), trip("b"))
    put(str(tmp_path / "r"), "r.csv", RAIN, reading("k1", 4.0))
    load(lake, "viagens_onibus", str(tmp_path / "t"))
    load(lake, "clima_pluviometria", str(tmp_path / "r"))
    version = jobs.build_silver(lake)
    store = lake.silver_store("stg_viagens")
    assert os.path.isdir(store.path(version, "origem=lote/parte=m2024-03"))
    assert store.read().count() == 2
    jobs.register_silver(lake)
    assert tuple(lake.spark.table("silver.viagens_processadas").columns) == silver.SILVER_COLUMNS


def test_cleaning_before_silver_is_optional(lake, tmp_path):
    late = trip("late").replace("2024-03-25,", "2024-09-01,", 1)
    lines = [trip("a", consortium="  inter  sul"), trip("long", minutes=999), late]
    put(str(tmp_path / "t"), "t.csv", TRIPS, *lines)
    put(str(tmp_path / "r"), "r.csv", RAIN, reading("k1", 4.0))
    load(lake, "viagens_onibus", str(tmp_path / "t"))
    load(lake, "viagens_onibus", str(tmp_path / "t"), date(2024, 3, 6))
    load(lake, "clima_pluviometria", str(tmp_path / "r"))
    store = lake.silver_store("stg_viagens")
    jobs.build_silver(lake)
    assert store.read().count() == 6
    options = jobs.SilverOptions(
        deduplicate=True, scope=(date(2024, 1, 1), date(2024, 8, 24)), minutes=(1, 300),
        consortium_names={"INTER SUL": "INTERSUL"},
    )
    jobs.build_silver(lake, options)
    assert rows(store.read(), "id_viagem", "consorcio", "chuva_no_horario") == [("a", "INTERSUL", 4.0)]


def test_rules_must_hold_before_silver_is_published(lake, tmp_path):
    put(str(tmp_path / "t"), "t.csv", TRIPS, trip("a"), trip("long", minutes=999))
    put(str(tmp_path / "r"), "r.csv", RAIN, reading("k1", 4.0))
    load(lake, "viagens_onibus", str(tmp_path / "t"))
    load(lake, "clima_pluviometria", str(tmp_path / "r"))
    with pytest.raises(ExpectationError, match="duracao plausivel .1 rows"):
        jobs.build_silver(lake, rules={"duracao plausivel": F.col("tempo_viagem") < 300})
    with pytest.raises(NotPublished):
        lake.silver_store("stg_viagens").read()
    jobs.build_silver(lake, rules={"duracao positiva": F.col("tempo_viagem") > 0})


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    from rainroute import __main__ as cli

    put(str(tmp_path / "t"), "t.csv", TRIPS, trip("a"), trip("b", minutes=999))
    put(str(tmp_path / "r"), "r.csv", RAIN, reading("k1", 4.0))
    cli.main(
        ["--lake", str(tmp_path / "lake"), "--run-date", "2024-03-05", "--minutes", "1", "300",
         "--source", f"viagens_onibus={tmp_path}/t", "--source", f"clima_pluviometria={tmp_path}/r"]
    )
    printed = capsys.readouterr().out
    assert printed.count("published") == 2 and printed.count("skipped") == 1
    assert spark.table("gold.fato_viagens").count() == 1
    with pytest.raises(SystemExit):
        cli.main(["--lake", "x", "--run-date", "2024-03-05", "--source", "nope=x"])


def test_the_submit_script_runs_the_command_line(tmp_path):
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, f"{root}/submit.py", "--help"], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "--run-date" in done.stdout


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_every_contract_can_be_loaded(lake, inbox, name):
    cell = {"string": "a", "date": "2024-01-01", "timestamp": "2024-01-01 10:00:00", "int": "1", "bigint": "2",
            "double": "1.5", "boolean": "true"}
    fields = CONTRACTS[name].schema.fields
    line = ",".join("10:00:00" if f.name == "horario" else cell[f.dataType.simpleString()] for f in fields)
    put(inbox, "a.csv", ",".join(f.name for f in fields), line)
    assert load(lake, name, inbox).rows == 1
    got = jobs.read_bronze(lake, name)
    assert [f.dataType for f in got.schema.fields][: len(fields)] == [f.dataType for f in fields]
    assert None not in got.drop("_arquivo").first()


# --- Versions -----------------------------------------------------------------


def test_publish_as_of_and_rollback(spark, tmp_path):
    store = Store(spark, str(tmp_path / "ds"))
    numbers = []
    for version, n in (("v1", 1), ("v2", 2), ("v3", 3)):
        write_files(spark.range(n), store.path(version))
        numbers.append(store.publish(version, rows=n))
    write_files(spark.range(99), store.path("unpublished"))
    assert store.read().count() == 3
    assert store.read(as_of=numbers[0]).count() == 1
    when = store.history().filter("versao = 'v2'").first()["publicado_em"]
    assert store.read(as_of=when).count() == 2
    assert store.rollback() == "v2"
    assert store.read().count() == 2
    assert store.rollback() == "v1"
    with pytest.raises(NotPublished):
        store.rollback()
    assert store.rollback(to="v3") == "v3" and store.read().count() == 3
    with pytest.raises(NotPublished):
        store.rollback(to="v9")
    assert [r["versao"] for r in store.history().orderBy("ordem").collect()] == ["v1", "v2", "v3", "v2", "v1", "v3"]


def test_old_versions_are_removed_on_request_only(spark, tmp_path):
    from datetime import datetime

    store = Store(spark, str(tmp_path / "ds"))
    for version, slot, n in (("v20240101T000000-a", "dia=1", 1), ("v20240102T000000-b", "dia=1", 2), ("v20240103T000000-c", "dia=2", 3)):
        write_files(spark.range(n), store.path(version, slot))
        store.publish(version, slot)
    for version in ("v20240101T000000-x", "v20990101T000000-y"):
        write_files(spark.range(9), store.path(version, "dia=1"))
    with pytest.raises(ValueError):
        store.remove_old(0, datetime(2025, 1, 1))
    assert store.remove_old(2, datetime(2023, 1, 1)) == []
    gone = store.remove_old(1, datetime(2025, 1, 1))
    assert sorted(p.rpartition("=")[2] for p in gone) == ["v20240101T000000-a", "v20240101T000000-x"]
    assert store.read().count() == 5 and os.path.isdir(store.path("v20990101T000000-y", "dia=1"))


def test_nothing_to_roll_back_to(spark, tmp_path):
    store = Store(spark, str(tmp_path / "ds"))
    write_files(spark.range(1), store.path("v1"))
    store.publish("v1")
    with pytest.raises(NotPublished):
        store.rollback()


def test_slots_are_independent(spark, tmp_path):
    store = Store(spark, str(tmp_path / "ds"))
    for slot, version, n in (("dia=01", "a", 1), ("dia=02", "b", 5), ("dia=02", "c", 2)):
        write_files(spark.range(n), store.path(version, slot))
        store.publish(version, slot)
    assert rows(store.read(slots=True).groupBy("dia", "carga").count()) == [(1, "a", 1), (2, "c", 2)]


# --- Catalog ------------------------------------------------------------------


def test_create_table_fails_if_it_exists_and_ensure_does_not(spark):
    catalog.create_layers(spark)
    df = spark.range(3)
    catalog.create_table_as(df, "silver.numbers")
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        catalog.create_table_as(df, "silver.numbers")
    assert catalog.ensure_table_as(df, "silver.numbers") is False
    assert catalog.ensure_table_as(df, "silver.other") is True
    catalog.replace_view(spark, "silver.v", "SELECT * FROM silver.numbers")
    catalog.replace_view(spark, "silver.v", "SELECT id FROM silver.numbers WHERE id > 0")
    assert spark.table("silver.v").count() == 2


def test_external_table_sees_files_added_later(spark, tmp_path):
    catalog.create_layers(spark)
    path, schema = str(tmp_path / "ext"), spark.range(1).withColumn("dia", F.lit(1)).schema
    spark.range(2).write.parquet(f"{path}/dia=1")
    assert catalog.ensure_external_table(spark, "bronze.ext", path, schema, ("dia",)) is True
    assert spark.table("bronze.ext").count() == 2
    spark.range(3).write.parquet(f"{path}/dia=2")
    assert catalog.ensure_external_table(spark, "bronze.ext", path, schema, ("dia",)) is False
    assert rows(spark.table("bronze.ext").groupBy("dia").count()) == [(1, 2), (2, 3)]
    with pytest.raises(ValueError, match="exists over"):
        catalog.ensure_external_table(spark, "bronze.ext", str(tmp_path / "elsewhere"), schema, ("dia",))


def test_loads_keep_a_partitioned_table(spark, lake, inbox, tmp_path):
    put(inbox, "a.csv", TRIPS, trip("a1"), trip("a2"))
    put(str(tmp_path / "b"), "b.csv", TRIPS, trip("b1"))
    jobs.load_datasets(lake, [jobs.Dataset("viagens_onibus", inbox)], RUN)
    jobs.load_datasets(lake, [jobs.Dataset("viagens_onibus", str(tmp_path / "b"))], date(2024, 3, 6))
    jobs.load_datasets(lake, [jobs.Dataset("viagens_onibus", inbox)], RUN)  # replaces its file
    table = spark.table("bronze.viagens_onibus_arquivos")
    assert rows(table.groupBy("dia").agg(F.countDistinct("carga"), F.count("*"))) == [(5, 2, 4), (6, 1, 1)]
    assert spark.table("bronze.viagens_onibus").count() == 3
    assert spark.table("bronze.viagens_onibus_linhagem").filter("dia = 5").count() == 2
    other = jobs.Lake.under(spark, str(tmp_path / "other"))
    jobs.load_datasets(other, [jobs.Dataset("viagens_onibus", str(tmp_path / "b"))], RUN)
    assert spark.table("bronze.viagens_onibus").count() == 1


def test_row_count_and_preview(spark, tmp_path):
    path = str(tmp_path / "n")
    spark.range(25).write.parquet(path)
    assert catalog.parquet_rows(spark, path) == 25
    assert catalog.preview(spark.read.parquet(path)).count() == 10


@pytest.mark.parametrize("name", ["dados brutos.csv", "viagens [1].csv", "março,2024 {a}.CSV", "100%.csv", "a+b.csv"])
def test_unusual_file_names(lake, inbox, name):
    put(inbox, name, TRIPS, trip("a"))
    assert load(lake, "viagens_onibus", inbox).rows == 1
    assert rows(jobs.read_bronze(lake, "viagens_onibus"), "_arquivo") == [(name,)]


# --- Compressed deliveries -------------------------------------------------------


def test_gzipped_files_are_loaded_under_their_plain_names(spark, lake, inbox):
    put(inbox, "a.csv", TRIPS, trip("a1"))
    with gzip.open(f"{inbox}/b%20.csv.gz", "wt", encoding="utf-8") as out:
        out.write("\n".join([TRIPS, trip("b1"), trip("b2")]) + "\n")
    result = load(lake, "viagens_onibus", inbox)
    assert (result.status, result.rows) == ("published", 3)
    assert rows(jobs.read_bronze(lake, "viagens_onibus").groupBy("_arquivo").count()) == [("a.csv", 1), ("b%20.csv", 2)]
    landing = f"{lake.landing}/viagens_onibus/2024/03/05"
    assert rows(spark.read.text(landing), "arquivo", "value") == sorted(
        [("a.csv", TRIPS), ("a.csv", trip("a1")), ("b%20.csv", TRIPS), ("b%20.csv", trip("b1")), ("b%20.csv", trip("b2"))]
    )
    assert all(f.endswith(".gz") for f in glob.glob(f"{landing}/*/part-*"))
    again = os.path.join(os.path.dirname(inbox), "again")
    put(again, "b%20.csv", TRIPS, trip("b3"))  # the same file, delivered without gzip
    load(lake, "viagens_onibus", again)
    assert rows(jobs.read_bronze(lake, "viagens_onibus"), "id_viagem") == [("a1",), ("b3",)]


def test_a_file_there_twice_fails_its_dataset(lake, inbox):
    put(inbox, "a.csv", TRIPS, trip("a1"))
    with gzip.open(f"{inbox}/a.csv.gz", "wt", encoding="utf-8") as out:
        out.write("\n".join([TRIPS, trip("a1")]) + "\n")
    with pytest.raises(ValueError, match="there twice"):
        load(lake, "viagens_onibus", inbox)
    assert not lake.bronze_store("viagens_onibus").current()


def test_exported_input_is_not_shuffled_and_has_no_empty_file(spark, tmp_path, monkeypatch):
    from rainroute.checks import registry

    monkeypatch.setattr(registry, "EXPORT_ROWS", 100)
    rows_of = spark.range(0, 4000, 1, 8).where("id >= 1250")  # nothing in the first partitions
    folder = registry._export(rows_of, str(tmp_path / "out"))
    files = glob.glob(f"{folder}/part-*.csv.gz")
    lengths = [len(gzip.open(f, "rt").read().splitlines()) - 1 for f in files]
    assert sum(lengths) == 2750 and min(lengths) > 0 and max(lengths) <= 100
    names = csv_files.list_csv(spark, folder)
    assert names.count() == len(files) and names.where("NOT endswith(arquivo, '.csv')").count() == 0
