from datetime import date, datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rainroute.contracts import schema_from_ddl
from rainroute.operators import dedup, outliers, quality, scope
from rainroute.sources import proxy


def test_latest_row_per_key(spark):
    df = spark.createDataFrame(
        [("a", date(2024, 1, 1), 1), ("a", date(2024, 1, 2), 2), ("a", None, 9), ("b", None, 3), ("b", None, 4),
         (None, date(2024, 1, 1), 5), (None, date(2024, 1, 1), 5)],
        "k string, loaded date, v int",
    )
    got = dedup.latest_per_key(df, ["k"], ["loaded"])
    assert got.columns == df.columns
    assert rows(got, "k", "v") == [(None, 5), (None, 5), ("a", 2), ("b", 4)]


def test_duplicates_fold_before_the_shuffle(spark):
    df = spark.range(100000).select((F.col("id") % 2).alias("k"), "id")
    text = plan(dedup.latest_per_key(df, ["k"], ["id"]))
    assert "Window" not in text and "partial_max" in text


def test_duration_range(spark):
    df = spark.createDataFrame([(1,), (3,), (45,), (46,), (None,)], "m int")
    assert rows(outliers.within_range(df, "m", 3, 45)) == [(None,), (3,), (45,)]


def test_fences_are_exact_quantiles_per_group(spark):
    records = [("a", v) for v in range(1, 102)] + [("b", 7)] * 3 + [("b", None), (None, 1)]
    df = spark.createDataFrame(records, "g string, m int")
    fences = outliers.quantile_fences(df.filter("g = 'a'"), "g", "m", 0.05, 0.95)
    assert rows(fences) == [("a", 6.0, 96.0)]
    kept = outliers.within_fences(df, "g", "m", 0.05, 0.95)
    assert rows(kept.groupBy("g").count()) == [(None, 1), ("a", 91), ("b", 4)]  # what cannot be judged stays
    with pytest.raises(TypeError, match="whole numbers"):
        outliers.quantile_fences(df.withColumn("m", F.col("m").cast("double")), "g", "m", 0.05, 0.95)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_scope_includes_both_days(spark, kind):
    values = ["2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-08-24 23:59:59", "2024-08-25 00:00:00"]
    df = spark.createDataFrame([(v,) for v in values], "s string").select(F.col("s").cast(kind).alias("data"))
    got = scope.within_dates(df, date(2024, 1, 1), date(2024, 8, 24))
    assert got.count() == 2


def test_scope_filter_reaches_the_scan(spark, tiny):
    df = proxy.table(spark, tiny, "lineitem")
    text = plan(scope.within_dates(df, date(1997, 1, 1), date(1997, 2, 1), "l_shipdate"))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    with pytest.raises(TypeError):
        scope.within_dates(df, date(1997, 1, 1), date(1997, 2, 1), "l_orderkey")


def test_profile(spark):
    df = spark.createDataFrame(
        [("a", 1, datetime(2024, 1, 1)), ("b", 10, None), ("a", 9, None), (None, None, None)],
        "c string, n int, t timestamp",
    )
    got = quality.column_profile(df, exact=["c", "n"])
    assert rows(got, "coluna", "tipo", "linhas", "nulos", "distintos", "minimo", "maximo") == [
        ("c", "string", 4, 1, 2, "a", "b"),
        ("n", "int", 4, 1, 3, "1", "10"),
        ("t", "timestamp", 4, 3, None, "2024-01-01 00:00:00", "2024-01-01 00:00:00"),
    ]
    estimated = quality.column_profile(df, approximate=True)
    assert rows(estimated, "coluna", "distintos") == [("c", 2), ("n", 3), ("t", 1)]


def test_category_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 2)], "c string, n int")
    assert rows(quality.category_counts(df, ["c", "n"])) == [
        ("c", None, 1), ("c", "a", 2), ("n", "1", 1), ("n", "2", 2)]


def test_drift_lists_changed_added_and_missing(spark):
    df = spark.createDataFrame(
        [("noon", "1", "x"), ("2024-01-01 10:00:00", "2", "y"), ("later", None, "z")],
        "datetime_partida string, tempo string, extra string",
    )
    contract = schema_from_ddl("datetime_partida TIMESTAMP, tempo INT, versao VARCHAR")
    assert rows(quality.schema_drift(df, contract)) == [
        ("datetime_partida", "changed", 2), ("extra", "added", 0), ("versao", "missing", 0)]
    same = spark.createDataFrame([(1,)], "a int")
    assert quality.schema_drift(same, schema_from_ddl("a INT")).count() == 0
    assert quality.schema_drift(same, schema_from_ddl("b INT")).count() == 2


def test_expectations(spark):
    df = spark.createDataFrame([(1,), (50,), (None,)], "m int")
    report = quality.expectations(df, {"short": F.col("m") < 10, "any": F.lit(True)})
    assert rows(report) == [("any", 3, 0, True), ("short", 3, 2, False)]
    quality.require(report.filter("regra = 'any'"))
    with pytest.raises(quality.ExpectationError, match="short"):
        quality.require(report)


def test_star_integrity_finds_each_kind_of_violation(spark):
    silver = spark.range(5)
    fact = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "fk string")
    dim = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    got = rows(quality.star_integrity(silver, fact, {"dim": (dim, "k")}, {"dim": "fk"}))
    assert got == [
        ("dim: chave nula no fato", 1),
        ("dim: chave repetida", 1),
        ("dim: fato sem dimensao", 1),
        ("fato x silver: diferenca de linhas", 1),
    ]


# --- Sketches ----------------------------------------------------------------------


def test_small_groups_have_exact_sketched_fences(spark):
    df = spark.createDataFrame(
        [("a", float(v)) for v in range(1, 101)] + [("a", None), ("a", float("nan")), ("b", None), (None, 5.0)], "g string, m double"
    )
    fences = outliers.sketched_fences(df, "g", "m", 0.05, 0.95, 400)
    assert rows(fences) == [(None, 5.0, 5.0), ("a", 5.0, 95.0)]
    kept = outliers.within_fences(df, "g", "m", 0.05, 0.95, sketch=400)
    assert kept.filter("m BETWEEN 1 AND 100 AND g = 'a'").count() == 91 and kept.filter("isnan(m)").count() == 1
    assert kept.filter("m IS NULL").count() == 2 and kept.filter("g IS NULL").count() == 1


def test_large_groups_stay_within_the_stated_rank_error(spark):
    df = spark.range(200_000).select(F.lit("x").alias("g"), F.pmod(F.xxhash64("id"), F.lit(10**6)).cast("double").alias("m"))
    _, low, high = outliers.sketched_fences(df, "g", "m", 0.1, 0.9, 200).first()
    ranks = df.agg(F.avg((F.col("m") <= low).cast("int")), F.avg((F.col("m") <= high).cast("int"))).first()
    assert abs(ranks[0] - 0.1) < 2 * outliers.rank_error(200) and abs(ranks[1] - 0.9) < 2 * outliers.rank_error(200)


def test_profiles_of_parts_merge_to_the_profile_of_the_whole(spark):
    df = spark.range(3000).select(
        F.col("id").cast("int").alias("n"), (F.col("id") / 7).alias("x"), F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("id", F.lit(40)).cast("int")).alias("d"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), F.pmod("id", F.lit(9)))).alias("s"), (F.col("id") < 5).alias("b"), F.lit(None).cast("string").alias("none"),
    )
    parts = [quality.sketched_profile(df.filter(f"n % 4 = {i}")) for i in range(4)]
    merged = quality.merged_profile(parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3]))
    exact = quality.column_profile(df, exact=df.columns)
    columns = ["coluna", "tipo", "linhas", "nulos", "minimo", "maximo"]
    assert rows(merged, *columns) == rows(exact, *columns)
    want = {r.coluna: r.distintos for r in exact.collect()}
    for r in merged.collect():
        assert abs(r.distintos - want[r.coluna]) <= 4 * quality.distinct_error() * want[r.coluna] + 1
    empty = quality.sketched_profile(df.limit(0))
    assert {(r.linhas, r.nulos, r.minimo) for r in quality.merged_profile(empty).collect()} == {(0, 0, None)}
    assert rows(quality.merged_profile(parts[0].unionAll(empty)), *columns) == rows(quality.merged_profile(parts[0]), *columns)


def test_loads_keep_their_profile_while_they_are_written(spark, tmp_path):
    from datetime import date

    from test_ingest import TRIPS, put, trip

    from rainroute.plans import jobs

    lake = jobs.Lake.under(spark, str(tmp_path / "lake"))

    def load(name, day, *lines, profile=True):
        put(str(tmp_path / name), f"{name[0]}.csv", TRIPS, *lines)
        jobs.ingest(lake, jobs.Dataset("viagens_onibus", str(tmp_path / name), "lenient", profile=profile), date(2024, 3, day))
        found = jobs.profile_bronze(lake, "viagens_onibus")
        return rows(found.where("coluna IN ('id_viagem', 'tempo_viagem')"), "coluna", "linhas", "nulos", "distintos", "minimo", "maximo")

    assert load("a1", 5, trip("k1", 9), trip("k2", 30), trip("bad", "xx")) == [("id_viagem", 2, 0, 2, "k1", "k2"), ("tempo_viagem", 2, 0, 2, "9", "30")]
    assert load("b1", 6, trip("k2", 100), trip("k3", "")) == [("id_viagem", 4, 0, 3, "k1", "k3"), ("tempo_viagem", 4, 1, 3, "9", "100")]
    # A file delivered again replaces what its load has kept; a load without a profile is read.
    assert load("a2", 5, trip("k9", 50), profile=False) == [("id_viagem", 3, 0, 3, "k2", "k9"), ("tempo_viagem", 3, 1, 2, "50", "100")]
