from datetime import date, datetime

import pytest
from conftest import plan, rows
from pyspark.sql import types as T

from rainroute.contracts import CONTRACTS, DEFAULT_DATASETS, is_clock, schema_from_ddl
from rainroute.operators.casting import REJECTS, accepted, apply_contract, apply_ddl, rejected

DDL = "d DATE, ts TIMESTAMP, n INT, big BIGINT, x DOUBLE, ok BOOLEAN, clock TIME, name VARCHAR"
GOOD = ("2024-03-25", "2024-03-25 06:10:00", "57", "9007199254740993", "1.5", "true", "7:05", "a")


def text_frame(spark, *records):
    names = [f.name for f in schema_from_ddl(DDL).fields]
    return spark.createDataFrame(records, ", ".join(f"{n} string" for n in names))


def test_contracts_have_the_declared_shape(spark):
    sizes = {name: len(c.schema.fields) for name, c in CONTRACTS.items()}
    assert sizes == {
        "viagens_onibus": 16,
        "clima_pluviometria": 9,
        "estacoes_clima": 12,
        "licenciamento_frota": 26,
        "reclamacoes_1746": 26,
    }
    assert set(DEFAULT_DATASETS) < set(CONTRACTS)
    trips = CONTRACTS["viagens_onibus"].schema
    assert trips["tempo_viagem"].dataType == T.IntegerType()
    assert trips["datetime_partida"].dataType == T.TimestampType()
    assert [f.name for f in CONTRACTS["clima_pluviometria"].schema.fields if is_clock(f)] == ["horario"]


@pytest.mark.parametrize("mode", ["strict", "lenient"])
def test_good_text_is_typed(spark, mode):
    typed = apply_contract(text_frame(spark, GOOD), schema_from_ddl(DDL), mode)
    row = typed.first()
    assert tuple(row)[:8] == (
        date(2024, 3, 25), datetime(2024, 3, 25, 6, 10), 57, 9007199254740993, 1.5, True, "07:05:00", "a",
    )
    assert [f.dataType for f in typed.schema.fields][:8] == [f.dataType for f in schema_from_ddl(DDL).fields]


def test_empty_and_null_cells_are_null_not_bad(spark):
    typed = apply_contract(text_frame(spark, ("",) * 8, (None,) * 8), schema_from_ddl(DDL))
    assert rows(typed) == [(None,) * 8] * 2


@pytest.mark.parametrize(
    "position, cell",
    [(0, "25/03/2024x"), (1, "noon"), (2, "xx"), (2, "12.7"), (2, "3000000000"), (4, "1,5"), (5, "maybe"),
     (6, "24:00:00"), (6, "7h05")],
)
def test_a_bad_cell_raises_or_is_set_aside(spark, position, cell):
    bad = list(GOOD)
    bad[position] = cell
    df = text_frame(spark, GOOD, tuple(bad))
    with pytest.raises(Exception, match="bad cell in"):
        apply_contract(df, schema_from_ddl(DDL)).collect()
    lenient = apply_contract(df, schema_from_ddl(DDL), "lenient")
    assert accepted(lenient).count() == 1
    (row,) = rejected(lenient).collect()
    assert [tuple(r) for r in row["_rejeitos"]] == [(schema_from_ddl(DDL).names[position], cell)]
    assert row[position] is None


def test_strict_does_not_depend_on_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="bad cell in n"):
            apply_contract(text_frame(spark, (*GOOD[:2], "xx", *GOOD[3:])), schema_from_ddl(DDL)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_whole_numbers_written_with_a_point(spark):
    df = spark.createDataFrame([("57.0",), ("-3.000",)], "n string")
    assert rows(apply_ddl(df, "n INT")) == [(-3,), (57,)]


def test_columns_are_found_by_name_and_extra_ones_dropped(spark):
    df = spark.createDataFrame([("x", "1")], "extra string, N string")
    assert apply_ddl(df, "n INT").columns == ["n"]
    assert rows(apply_ddl(df, "n INT")) == [(1,)]


def test_missing_column(spark):
    df = spark.createDataFrame([("1",)], "n string")
    with pytest.raises(ValueError, match="columns missing.*m"):
        apply_ddl(df, "n INT, m DOUBLE")
    assert rows(apply_ddl(df, "n INT, m DOUBLE", "lenient"), "n", "m") == [(1, None)]


def test_without_a_schema_text_everything_passes(spark):
    df = spark.createDataFrame([("1", 2)], "a string, b int")
    assert apply_ddl(df, None).schema == df.schema


def test_typed_input_is_cast(spark):
    df = spark.sql("SELECT 12.7D AS n, timestamp_ntz'2024-01-01 05:00:00' AS ts, 7 AS name")
    got = apply_ddl(df, "n INT, ts TIMESTAMP, name VARCHAR")
    assert rows(got) == [(12, datetime(2024, 1, 1, 5), "7")]
    timed = spark.sql("SELECT timestamp'2024-01-01 05:06:07' AS clock")
    assert rows(apply_ddl(timed, "clock TIME")) == [("05:06:07",)]


def test_whole_numbers_are_parsed_as_before(spark):
    texts = ["12", " 12 ", "12.0", "12.000", "12.7", "+5", "-5", "--5", "5-", "1 2", "\t7\n", "\x7f7", "7.0\n", "", "xx", "9" * 30, "٣", "1e3", ".0", "0x1", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in ("int", "bigint"):
        twice = f"coalesce(try_cast(c AS {kind}), try_cast(regexp_replace(c, r'\\.0+$', '') AS {kind}))"
        want = df.selectExpr("t", "nullif(trim(t), '') AS c").selectExpr("t", f"{twice} AS n")
        assert rows(apply_ddl(df, f"t {kind}", "lenient").select("t")) == rows(want.select("n"))


def test_no_error_is_raised_for_a_cell_that_is_no_number(spark):
    """A raised and caught error a cell was most of a lenient load's time: each cast stands behind a look at its text."""
    df = spark.createDataFrame([("17.0", "xx")], "n string, m string")
    text = plan(apply_ddl(df, "n INT, m INT", "lenient"))
    assert "RLIKE" in text and text.count("try_cast(regexp_replace") == 0
    (row,) = rejected(apply_contract(df, schema_from_ddl("n INT, m INT"), "lenient")).collect()
    assert (row.n, row.m, row[REJECTS]) == (17, None, [("m", "xx")])
