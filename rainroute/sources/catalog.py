"""Catalog objects: tables, refresh, contract views, counts and previews."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold")


def create_layers(spark: SparkSession) -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def create_table_as(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """CTAS: fails if the table exists."""
    df.write.format(fmt).mode("errorifexists").saveAsTable(name)


def ensure_table_as(df: DataFrame, name: str, fmt: str = "parquet") -> bool:
    """CTAS unless the table is there, in which case it is refreshed; True if created."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)
        return False
    create_table_as(df, name, fmt)
    return True


def ensure_external_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partitions: tuple[str, ...] = (), recover: bool = True
) -> bool:
    """Register files as a table if it is missing, else pick up files that were added.

    Without ``recover`` no folder is listed; ``ensure_partition`` adds them.

    A table of that name over another folder is an error, not something to repair.
    """
    created = not spark.catalog.tableExists(name)
    if not created and _folder_of(spark, name) != _bare(path):
        raise ValueError(f"{name} exists over {_folder_of(spark, name)}")
    if created:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        clause = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {clause} LOCATION '{path}'")
    if partitions and recover:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return created


def ensure_partition(spark: SparkSession, name: str, values: Mapping[str, object], path: str) -> None:
    """Make one partition folder known to a table and forget what was cached of it; other folders are not listed."""
    spec = ", ".join(f"{k} = '{v}'" if isinstance(v, str) else f"{k} = {v}" for k, v in values.items())
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def _bare(path: str) -> str:
    """A path without scheme and surplus slashes, for comparing."""
    return "/" + path.split(":", 1)[-1].strip("/")


def _folder_of(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    return _bare(described["data_type"])


def is_over(spark: SparkSession, name: str, path: str) -> bool:
    return _folder_of(spark, name) == _bare(path)


def replace_view(spark: SparkSession, name: str, query: str) -> None:
    """Stable name over a physical table; replacing the view is how a version goes live."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def parquet_rows(spark: SparkSession, path: str) -> int:
    """Row count from the Parquet footers."""
    return spark.read.parquet(path).count()


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """Some rows, in no particular order; for looking at data only."""
    return df.limit(rows)
