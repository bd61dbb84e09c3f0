"""Profile, drift, star integrity and declared expectations.

Each check is one aggregate over its input; results have a handful of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainroute.operators.casting import REJECTS, apply_contract


def _unpivot_one_row(df: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """Turn a one-row frame into one row per struct."""
    return df.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def column_profile(
    df: DataFrame, exact: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """Per column: type, rows, nulls, distinct values, smallest and largest value as text.

    Distinct values are exact for the columns in ``exact`` (non-NULL values,
    counted in two steps so that only the values themselves are shuffled), an
    estimate for the others when ``approximate`` is set, and NULL otherwise.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        aggs += [
            F.count(col).alias(f"c{i}"),
            F.min(col).cast("string").alias(f"lo{i}"),
            F.max(col).cast("string").alias(f"hi{i}"),
        ]
        if approximate and c not in exact:
            aggs.append(F.approx_count_distinct(col).alias(f"d{i}"))
    rows = [
        F.struct(
            F.lit(c).alias("coluna"),
            F.lit(df.schema[c].dataType.simpleString()).alias("tipo"),
            F.col("n").alias("linhas"),
            (F.col("n") - F.col(f"c{i}")).alias("nulos"),
            (
                F.col(f"d{i}") if approximate and c not in exact else F.lit(None).cast("bigint")
            ).alias("distintos"),
            F.col(f"lo{i}").alias("minimo"),
            F.col(f"hi{i}").alias("maximo"),
        )
        for i, c in enumerate(df.columns)
    ]
    profile = _unpivot_one_row(df.agg(*aggs), rows)
    if not exact:
        return profile
    pairs = F.array(
        *[F.struct(F.lit(c).alias("coluna"), F.col(f"`{c}`").cast("string").alias("valor")) for c in exact]
    )
    counted = (
        df.select(F.explode(pairs).alias("p"))
        .select("p.coluna", "p.valor")
        .distinct()
        .groupBy("coluna")
        .agg(F.count("valor").alias("exatos"))
    )
    return (
        profile.join(F.broadcast(counted), "coluna", "left")  # one row per listed column
        .withColumn("distintos", F.coalesce("exatos", "distintos"))
        .drop("exatos")
    )


SKETCH = "coluna string, tipo string, linhas bigint, nulos bigint, menor struct<n:double,t:string>, maior struct<n:double,t:string>, esboco binary"
SKETCH_BITS = 12  # of the distinct-count sketch: 2**12 registers


def distinct_error(bits: int = SKETCH_BITS) -> float:
    """Relative standard error of a sketched number of distinct values (a fixed value of the sketch: 1.04 / sqrt of its size)."""
    return 1.04 / 2 ** (bits / 2)


def _ordered(field: T.StructField, value: Column) -> Column:
    """A value as (number, text), so that extremes of several parts can be compared without the column's type."""
    kind = field.dataType
    if isinstance(kind, T.BooleanType):
        number = value.cast("int").cast("double")
    elif isinstance(kind, T.NumericType):
        number = value.cast("double")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(value).cast("double")
    elif isinstance(kind, T.TimestampType):
        number = F.unix_micros(value).cast("double")
    else:
        number = F.lit(None).cast("double")
    return F.when(value.isNotNull(), F.struct(number.alias("n"), value.cast("string").alias("t")))


def sketch_columns(schema: T.StructType, only: Column | None = None) -> list[Column]:
    """Aggregates behind ``sketch_rows``, for ``agg`` or, while rows are being written, ``observe``; ``only``: rows that count."""
    only = F.lit(True) if only is None else only
    out = [F.count_if(only).alias("n")]
    for i, field in enumerate(schema.fields):
        value = F.when(only, F.col(f"`{field.name}`"))
        out += [
            F.count(value).alias(f"c{i}"), F.min(_ordered(field, value)).alias(f"lo{i}"), F.max(_ordered(field, value)).alias(f"hi{i}"),
            F.hll_sketch_agg(value.cast("string"), SKETCH_BITS).alias(f"s{i}"),
        ]
    return out


def sketch_rows(schema: T.StructType, found: Mapping) -> list[tuple]:
    """Rows of ``SKETCH`` from the values of ``sketch_columns``."""
    pair = lambda v: None if v is None else (v["n"], v["t"])
    n = found["n"]
    return [
        (f.name, f.dataType.simpleString(), n, n - found[f"c{i}"], pair(found[f"lo{i}"]), pair(found[f"hi{i}"]), found[f"s{i}"])
        for i, f in enumerate(schema.fields)
    ]


def sketched_profile(df: DataFrame) -> DataFrame:
    """A row of ``SKETCH`` per column, in one scan and without exploding rows; parts of a table can be merged."""
    row = df.agg(*sketch_columns(df.schema)).first()
    return df.sparkSession.createDataFrame(sketch_rows(df.schema, row.asDict()), SKETCH)


def merged_profile(sketches: DataFrame) -> DataFrame:
    """Profile of all rows behind some sketches: no row is read again; ``distintos`` is an estimate."""
    return sketches.groupBy("coluna").agg(
        F.max("tipo").alias("tipo"), F.sum("linhas").alias("linhas"), F.sum("nulos").alias("nulos"),
        F.hll_sketch_estimate(F.hll_union_agg("esboco")).alias("distintos"),
        F.min("menor").getField("t").alias("minimo"), F.max("maior").getField("t").alias("maximo"),
    )


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each listed column (NULL included), in one scan."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("coluna"), F.col(f"`{c}`").cast("string").alias("valor")) for c in columns]
    )
    return (
        df.select(F.explode(pairs).alias("p"))
        .groupBy("p.coluna", "p.valor")
        .agg(F.count(F.lit(1)).alias("linhas"))
        .select("coluna", "valor", "linhas")
    )


def schema_drift(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Columns that are ``missing``, ``added`` or ``changed`` against the contract.

    A column has changed when cells that are present do not fit the contract's
    type; ``celulas`` counts them over the whole input.
    """
    spark = df.sparkSession
    expected = {f.name.lower() for f in contract.fields}
    given = {c.lower() for c in df.columns}
    static = [(f.name, "missing", 0) for f in contract.fields if f.name.lower() not in given]
    static += [(c, "added", 0) for c in df.columns if c.lower() not in expected]
    shape = "coluna string, situacao string, celulas bigint"
    report = spark.createDataFrame(static, shape)
    shared = [f for f in contract.fields if f.name.lower() in given]
    if not shared:
        return report
    fitted = apply_contract(df, T.StructType(shared), "lenient")
    bad_columns = F.col(f"{REJECTS}.coluna")  # array of the row's bad column names
    aggs = [
        F.count_if(F.array_contains(bad_columns, f.name)).alias(f"b{i}") for i, f in enumerate(shared)
    ]
    rows = [
        F.struct(
            F.lit(f.name).alias("coluna"), F.lit("changed").alias("situacao"), F.col(f"b{i}").alias("celulas")
        )
        for i, f in enumerate(shared)
    ]
    changed = _unpivot_one_row(fitted.agg(*aggs), rows).filter(F.col("celulas") > 0)
    return report.unionByName(changed)


def expectations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Evaluate row rules in one pass: rows tested and rows failing, per rule.

    A rule is a boolean column; NULL counts as a failure.
    """
    names = list(rules)
    aggs = [F.count(F.lit(1)).alias("n")] + [
        F.count_if(~F.coalesce(rules[name], F.lit(False))).alias(f"f{i}") for i, name in enumerate(names)
    ]
    rows = [
        F.struct(
            F.lit(name).alias("regra"),
            F.col("n").alias("linhas"),
            F.col(f"f{i}").alias("falhas"),
            (F.col(f"f{i}") == 0).alias("aprovada"),
        )
        for i, name in enumerate(names)
    ]
    return _unpivot_one_row(df.agg(*aggs), rows)


class ExpectationError(ValueError):
    """A declared expectation does not hold."""


def require(report: DataFrame) -> None:
    """Raise if any rule of an ``expectations`` report failed."""
    failed = [f"{r['regra']} ({r['falhas']} rows)" for r in report.filter(~F.col("aprovada")).collect()]
    if failed:
        raise ExpectationError("; ".join(failed))


def star_integrity(
    silver: DataFrame,
    fact: DataFrame,
    dimensions: Mapping[str, tuple[DataFrame, str]],
    keys: Mapping[str, str],
) -> DataFrame:
    """Violations per check: duplicate dimension keys, orphan and NULL fact keys, row loss.

    ``dimensions``: name -> (frame, key column); ``keys``: name -> fact column.
    Fact keys are counted before they meet a dimension, so only distinct keys move.
    """

    def named(name: str, violations: Column) -> Column:
        return F.struct(
            F.lit(name).alias("verificacao"), F.coalesce(violations, F.lit(0)).cast("bigint").alias("violacoes")
        )

    reports = []
    for name, (dim, key) in dimensions.items():
        known = dim.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        used = fact.groupBy(F.col(keys[name]).alias("k")).agg(F.count(F.lit(1)).alias("linhas"))
        both = known.join(used, "k", "full_outer")  # distinct keys on both sides
        absent = F.col("k").isNull()
        found = both.agg(
            F.count_if(F.col("n") > 1).alias("repeated"),
            F.sum(F.when(~absent & F.col("n").isNull(), F.col("linhas"))).alias("orphans"),
            F.sum(F.when(absent, F.col("linhas"))).alias("nulls"),
        )
        reports.append(
            _unpivot_one_row(
                found,
                [
                    named(f"{name}: chave repetida", F.col("repeated")),
                    named(f"{name}: fato sem dimensao", F.col("orphans")),
                    named(f"{name}: chave nula no fato", F.col("nulls")),
                ],
            )
        )
    sides = silver.select(F.lit(1).alias("d")).unionAll(fact.select(F.lit(-1).alias("d")))
    difference = sides.agg(F.abs(F.sum("d")).alias("d"))
    reports.append(
        _unpivot_one_row(difference, [named("fato x silver: diferenca de linhas", F.col("d"))])
    )
    return reduce(DataFrame.unionByName, reports)
