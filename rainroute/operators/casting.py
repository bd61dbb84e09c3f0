"""Typed projection: fit a DataFrame to a contract.

Text cells are parsed with ``try_cast`` and judged afterwards, so the outcome
does not depend on the session's ANSI setting: ``strict`` raises on the first
bad cell, ``lenient`` makes it NULL and keeps the raw text in a reject column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainroute.contracts import is_clock, schema_from_ddl

REJECTS = "_rejeitos"
REJECTS_TYPE = "array<struct<coluna:string,valor:string>>"

# HH:mm with optional seconds and fraction.
CLOCK = r"^([01]?[0-9]|2[0-3]):([0-5][0-9])(:([0-5][0-9])(\.[0-9]{1,9})?)?$"

# Digits behind a sign, with the blanks and control characters around them that casting drops.
DIGITS = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*\z"


def _clock(text: Column) -> Column:
    part = lambda i: F.regexp_extract(text, CLOCK, i)
    seconds = F.coalesce(F.nullif(part(4), F.lit("")), F.lit("00"))
    return F.when(
        text.rlike(CLOCK), F.concat_ws(":", F.lpad(part(1), 2, "0"), part(2), seconds)
    )


def _whole_number(text: Column, dtype: T.DataType) -> Column:
    """``12`` and ``12.0`` are whole numbers, ``12.7`` is a bad cell.

    Spark raises and catches an error for each text that it cannot parse, so only what looks like a number gets there.
    """
    whole = F.when(text.contains("."), F.regexp_replace(text, r"\.0+$", "")).otherwise(text)
    return F.when(whole.rlike(DIGITS), whole.try_cast(dtype))


def _cell(source: T.DataType, raw: Column, field: T.StructField) -> Column:
    """The cell as it is judged: empty text counts as NULL, blanks around values are dropped."""
    if not isinstance(source, T.StringType):
        return raw
    is_text = isinstance(field.dataType, T.StringType) and not is_clock(field)
    return F.nullif(raw if is_text else F.trim(raw), F.lit(""))


def _parsed(source: T.DataType, cell: Column, field: T.StructField) -> Column:
    """The typed value, NULL where the cell does not fit."""
    if isinstance(source, T.StringType):
        if is_clock(field):
            return _clock(cell)
        if isinstance(field.dataType, (T.IntegerType, T.LongType)):
            return _whole_number(cell, field.dataType)
    elif is_clock(field):
        return F.date_format(cell, "HH:mm:ss")
    return cell.try_cast(field.dataType)


def _always_fits(source: T.DataType, field: T.StructField) -> bool:
    """Same type, or anything rendered as text."""
    return not is_clock(field) and (source == field.dataType or isinstance(field.dataType, T.StringType))


def _or_raise(field: T.StructField, cell: Column, value: Column) -> Column:
    expected = f"bad cell in {field.name}: expected {field.dataType.simpleString()}, got "
    error = F.raise_error(F.concat(F.lit(expected), cell.cast("string")))
    return F.coalesce(value, F.when(cell.isNotNull(), error)).cast(field.dataType)


def _or_listed(field: T.StructField, cell: Column, value: Column) -> Column:
    entry = F.struct(F.lit(field.name).alias("coluna"), cell.cast("string").alias("valor"))
    return F.when(cell.isNotNull() & value.isNull(), entry)


def apply_contract(
    df: DataFrame, schema: T.StructType, mode: str = "strict", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Select the contract's columns by name, typed; ``keep`` passes extra columns on.

    ``strict``: a bad cell or a missing column raises. ``lenient``: both become
    NULL and ``_rejeitos`` lists the bad cells of the row (NULL for a clean row).

    Cells, values and verdicts are three projections. Written as one, the
    generated method for a wide contract grows past what the JVM compiles.
    """
    if mode not in ("strict", "lenient"):
        raise ValueError(f"unknown mode {mode!r}")
    present = {f.name.lower(): f for f in df.schema.fields}
    found = {f.name: present[f.name.lower()] for f in schema.fields if f.name.lower() in present}
    missing = [f.name for f in schema.fields if f.name not in found]
    if missing and mode == "strict":
        raise ValueError(f"columns missing from the input: {', '.join(missing)}")

    given = [f for f in schema.fields if f.name in found]
    judged = [f for f in given if not _always_fits(found[f.name].dataType, f)]
    sources = {f.name: found[f.name].dataType for f in given}
    cell = lambda f: F.col(f"`{f.name}`")
    value = lambda f: F.col(f"`__typed_{f.name}`")

    cells = [_cell(sources[f.name], F.col(f"`{found[f.name].name}`"), f).alias(f.name) for f in given]
    values = [_parsed(sources[f.name], cell(f), f).alias(f"__typed_{f.name}") for f in judged]
    parsed = df.select(*cells, *keep).select("*", *values)

    def verdict(f: T.StructField) -> Column:
        if f.name not in found:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if f not in judged:
            return cell(f).cast(f.dataType).alias(f.name)
        return (_or_raise(f, cell(f), value(f)) if mode == "strict" else value(f)).alias(f.name)

    columns = [verdict(f) for f in schema.fields] + [F.col(name) for name in keep]
    if mode == "strict":
        return parsed.select(*columns)
    if not judged:
        return parsed.select(*columns, F.lit(None).cast(REJECTS_TYPE).alias(REJECTS))
    # The list is interpreted row by row, so only rows with a bad cell get to it.
    unfit = reduce(lambda a, b: a | b, [cell(f).isNotNull() & value(f).isNull() for f in judged])
    listed = F.array_compact(F.array(*[_or_listed(f, cell(f), value(f)) for f in judged]))
    return parsed.select(*columns, F.when(unfit, listed).cast(REJECTS_TYPE).alias(REJECTS))


def apply_ddl(df: DataFrame, ddl: str | None, mode: str = "strict") -> DataFrame:
    """Schema text to typed projection; without a text, every column passes as it is."""
    return df.select("*") if not ddl else apply_contract(df, schema_from_ddl(ddl), mode)


def accepted(df: DataFrame) -> DataFrame:
    """Clean rows of a lenient projection."""
    return df.filter(F.col(REJECTS).isNull()).drop(REJECTS)


def rejected(df: DataFrame) -> DataFrame:
    """Rows with at least one bad cell, with the raw cells."""
    return df.filter(F.col(REJECTS).isNotNull())
