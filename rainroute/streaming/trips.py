"""Structured Streaming: trips enriched in flight, and watermarked hourly counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainroute.contracts import CONTRACTS
from rainroute.functions import rain_band
from rainroute.operators.casting import REJECTS, apply_contract
from rainroute.operators.dedup import latest_per_key
from rainroute.plans.changes import KEYS
from rainroute.plans.jobs import AuditError, Lake, register_silver
from rainroute.plans.silver import SILVER_COLUMNS, enrich, trip_attributes
from rainroute.sources.csv_files import CSV_ONLY, MALFORMED
from rainroute.sources.versions import Store, new_version

QUERY, BATCH = "consulta", "lote"
PARTS = 16  # rows of state an hour's trips are packed into
STATE = {  # on disk, in native memory of a fixed size: what waits may be larger than the heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def csv_stream(
    spark: SparkSession,
    folder: str,
    dataset: str,
    separator: str = ",",
    files_per_batch: int = 1000,
    mode: str = "strict",
) -> DataFrame:
    """New CSV files of a folder, typed by their contract; headers must list its columns in order.

    ``strict``: a bad cell stops the stream. ``lenient``: the cell becomes NULL and is
    kept in the rejects column, as in a batch load; a record with a wrong number of cells is kept whole there.
    """
    schema = CONTRACTS[dataset].schema
    lenient = mode == "lenient"
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    if lenient:
        text = text.add(MALFORMED, T.StringType())
    lines = (
        spark.readStream.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", CSV_ONLY)
        .option("sep", separator)
        .option("escape", '"')
        .option("mode", "PERMISSIVE" if lenient else "FAILFAST")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    if not lenient:
        return apply_contract(lines, schema)
    typed = apply_contract(lines, schema, "lenient", keep=(MALFORMED,))
    whole = F.array(F.struct(F.lit("*").alias("coluna"), F.col(MALFORMED).alias("valor")))
    return typed.withColumn(REJECTS, F.when(F.col(MALFORMED).isNotNull(), whole).otherwise(F.col(REJECTS))).drop(MALFORMED)


def enrich_stream(trips: DataFrame, hourly: DataFrame, hourly_rows: int | None) -> DataFrame:
    """Silver rows from a stream of bronze trips and a fixed table of hourly rain.

    The join keeps no state. Rain that arrives after its trips is not waited
    for: the next batch build of silver reads those trips again, ``silver.reenrich`` looks
    it up for rows already written, and ``wait_for_rain`` holds trips back until it has come.
    """
    return enrich(trip_attributes(trips), hourly, hourly_rows)


def write_enriched(
    trips: DataFrame,
    hourly: Callable[[], tuple[DataFrame, int | None]],
    target: str,
    checkpoint: str,
) -> None:
    """Enrich everything available, then stop.

    ``hourly`` is asked again for every micro-batch, so a newly published rain
    table is used from the next batch on. A batch writes to a folder of its own, named by the
    query and the batch: it replaces itself when it is repeated after a failure, and a
    query with a new checkpoint adds to what others have written.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rain, rows = hourly()
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        enrich_stream(batch, rain, rows).write.mode("overwrite").parquet(f"{target}/{QUERY}={query_id}/{BATCH}={batch_id}")

    query = (
        trips.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def publish_enriched(lake: Lake, target: str) -> str | None:
    """Publish the batches streamed since the last time as silver, beside what is there, and refresh the view.

    Each batch is a slot of its own (query and batch id). A trip that silver has already, from a batch build or an
    earlier batch, is not published again; of copies among the new rows the last batch's stays, and rows
    without id are all kept. Batches are copied, so readers never see a half-written one. Returns
    the version, None if there was nothing new.
    """
    store, version = lake.silver_store("stg_viagens"), new_version()
    folders = store.folders(f"{target}/{QUERY}=*/{BATCH}=*")
    slots = {_stream_slot(f): f for f in folders}
    handled = {r.slot for r in store.history().select("slot").distinct().collect()}  # a row per slot
    new = {s: f for s, f in slots.items() if s not in handled}
    if not slots:
        raise AuditError(f"nothing streamed to {target}")
    if not new:
        return None
    read = lake.spark.read.option("basePath", target).parquet(*sorted(new.values()))
    slot = {"origem": F.col(QUERY).cast("string"), "parte": F.concat(F.lit("b"), F.col(BATCH).cast("string"))}
    rows = latest_per_key(read.withColumns(slot), ["id_viagem"], [BATCH, QUERY]).select(*SILVER_COLUMNS, *KEYS)
    if store.current():
        known = store.read().select("id_viagem").where("id_viagem IS NOT NULL")
        rows = rows.join(known, "id_viagem", "left_anti").select(*rows.columns)
    store.write_slots(rows.withColumn("carga", F.lit(version)).hint("rebalance", *KEYS), KEYS)
    written = store.written_slots(version, KEYS)
    # A batch whose trips are all there already is withdrawn at once, which marks it as done.
    store.publish_set([(s, version if s in written else None, written.get(s, 0)) for s in sorted(new)])
    register_silver(lake)
    return version


def _stream_slot(folder: str) -> str:
    query, batch = (part.split("=", 1)[1] for part in folder.rstrip("/").split("/")[-2:])
    return f"origem={query}/parte=b{batch}"


# --- Rain that comes after its trips ---------------------------------------------


def closed_hours(readings: DataFrame, late_by: str) -> DataFrame:
    """Mean rain of each clock hour from a stream of readings, given out once the watermark has closed the hour."""
    clock = F.to_timestamp(F.concat_ws(" ", F.col("data_particao").cast("string"), F.col("horario")))
    return (
        readings.withColumn("__t", clock).withWatermark("__t", late_by)
        .groupBy(F.window("__t", "1 hour").alias("__hour"))
        .agg(F.avg("acumulado_chuva_1_h").alias("__mm"))
    )


def wait_for_rain(trips: DataFrame, readings: DataFrame, trips_late_by: str, rain_late_by: str, band=rain_band) -> DataFrame:
    """Silver rows from two streams: each trip comes out once, when the rain of its hour can no longer change.

    A left outer join of two streams on the clock hour. State holds the trips and readings of hours that neither
    watermark has passed; then an hour is given out, dry if it had no reading, and dropped. The trips of an hour are packed into
    ``PARTS`` rows by a hash, so state has rows by the hour, not by the trip; a row holds at most 2 GB. Trips without departure have
    no hour to wait for and come out at once. Trips whose date is not the day of the departure take the rain of their
    date at the hour of departure, as in the batch build. Events later than their watermark allows are lost to
    the stream; the batch build still has them.
    """
    base = trip_attributes(trips)
    hour = F.make_timestamp(
        F.year("data_viagem"), F.month("data_viagem"), F.dayofmonth("data_viagem"), F.col("hora_partida"), F.lit(0), F.lit(0)
    )
    placed = base.withColumn("__t", hour)
    dated = placed.where("__t IS NOT NULL").withWatermark("__t", trips_late_by)
    part = F.pmod(F.xxhash64(*base.columns), F.lit(PARTS)).alias("__part")
    packed = dated.groupBy(F.window("__t", "1 hour").alias("__hour"), part).agg(F.collect_list(F.struct(*base.columns)).alias("__trips"))
    joined = packed.join(closed_hours(readings, rain_late_by), "__hour", "left_outer").select(F.inline("__trips"), "__mm")
    undated = placed.where("__t IS NULL").withColumn("__mm", F.lit(None).cast("double"))
    both = joined.unionByName(undated.select(*base.columns, "__mm"))
    rain = [F.coalesce("__mm", F.lit(0.0)).alias("chuva_no_horario"), band("__mm").alias("condicao_clima")]
    return both.select(*base.columns, *rain).select(*SILVER_COLUMNS)


def write_closed(silver_rows: DataFrame, target: str, checkpoint: str):
    """Write the rows of hours that have closed, a folder per query and batch as ``write_enriched`` does, then stop.

    ``publish_enriched`` takes them from there. Returns the ended query, whose progress tells the rows kept in state.
    State is kept in RocksDB (``STATE``); a checkpoint that was begun with another provider goes on with its own.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.write.mode("overwrite").parquet(f"{target}/{QUERY}={query_id}/{BATCH}={batch_id}")

    conf = silver_rows.sparkSession.conf
    before = {k: conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        conf.set(k, v)
    try:
        query = (
            silver_rows.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    return query


# --- Hourly counts ---------------------------------------------------------------


def hourly_counts(events: DataFrame, time: str, kind: str, late_by: str) -> DataFrame:
    """Events per kind and clock hour; an hour is final once the watermark has passed it.

    With ``write_available`` state holds open hours only, the hours not passed yet are not
    given out, and events later than ``late_by`` are lost to the counts; ``write_touched`` gives
    every hour and loses none. A timestamp without zone is taken as session
    time, since watermarks need one with a zone.
    """
    return (
        events.withColumn("__t", F.col(time).cast("timestamp"))
        .withWatermark("__t", late_by)
        .groupBy(F.window("__t", "1 hour").alias("w"), kind)
        .agg(F.count(F.lit(1)).alias("total"))
        .select(F.col("w.start").alias("inicio"), F.col("w.end").alias("fim"), kind, "total")
    )


def write_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append the hours that are final to Parquet files, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def write_touched(events: DataFrame, store: Store, checkpoint: str, time: str, kind: str) -> None:
    """Count everything available by clock hour and kind, open hours and late events included, then stop.

    Nothing is kept in state, however long the stream runs. A micro-batch is counted by itself, and its counts are
    added to those of the days it touches; these days are written anew and published together, other days are not
    read. The version is named by query and batch: a repeated batch that was published is left out, and one that
    was not replaces its files, so each event counts once.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        if store.history().where(F.col("versao") == version).limit(1).count():
            return
        start = F.date_trunc("hour", F.col(time).cast("timestamp"))
        counted = batch.groupBy(start.alias("inicio"), F.col(kind)).agg(F.count(F.lit(1)).alias("total"))
        counted = counted.withColumn("dia", F.coalesce(F.date_format("inicio", "'d'yyyy-MM-dd"), F.lit("dsem-data")))
        fresh = counted.select("inicio", (F.col("inicio") + F.expr("INTERVAL 1 HOUR")).alias("fim"), kind, "total", "dia").persist()
        try:
            days = {f"dia={r.dia}" for r in fresh.select("dia").distinct().collect()}  # a row per day of the batch
            if not days:
                return
            have = {s: v for s, v in store.current().items() if s in days}
            rows = fresh.unionByName(store.read_slots(have).select(*fresh.columns)) if have else fresh
            summed = rows.groupBy("inicio", "fim", kind, "dia").agg(F.sum("total").alias("total"))
            store.write_slots(summed.withColumn("carga", F.lit(version)).hint("rebalance", "dia"), ("dia",))
        finally:
            fresh.unpersist()
        store.publish_set([(s, version, n) for s, n in sorted(store.written_slots(version, ("dia",)).items())])

    query = (
        events.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
