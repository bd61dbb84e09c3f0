"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC keeps hours and dates the same on every executor; AQE sizes shuffle
# partitions, splits hot join partitions and evens out written files.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Above 8000 bytes the JVM leaves a generated method uncompiled; Spark's
    # split projections are several times faster than that.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "rainroute", **extra: str) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own through spark-submit."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_fallback: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="rainroute-", dir="/tmp")
    return _fallback[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df, name: str):
    """Write once to the shared folder and read back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
