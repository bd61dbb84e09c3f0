"""The batch jobs: load CSV datasets into bronze, build silver and gold, expose views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainroute.contracts import CONTRACTS
from rainroute.functions import mapped_name
from rainroute.operators import quality
from rainroute.operators.casting import REJECTS, REJECTS_TYPE, apply_contract
from rainroute.operators.dedup import latest_per_key
from rainroute.operators.lookup import fits
from rainroute.operators.outliers import within_range
from rainroute.operators.scope import within_dates
from rainroute.plans import changes, clustering, gold, silver
from rainroute.sources import catalog, csv_files
from rainroute.sources.csv_files import MALFORMED, SOURCE_FILE
from rainroute.sources.versions import NotPublished, Store, new_version, sql_text, write_files

TRIP_COLUMNS = (
    "data", "id_viagem", "servico", "consorcio", "tipo_dia", "distancia_planejada", "tempo_viagem",
    "datetime_partida",
)
RAIN_COLUMNS = ("data_particao", "horario", "acumulado_chuva_1_h")
INPUTS = ("viagens_onibus", "clima_pluviometria")
GOLD_TABLES = ("dim_calendario", "dim_consorcio", "dim_clima", "fato_desempenho_viagem")


class AuditError(ValueError):
    """Written data did not pass its audit and was not published."""


class JobFailed(RuntimeError):
    """At least one dataset of a run failed; the others were published."""


@dataclass(frozen=True)
class Lake:
    """Root folders of the four layers."""

    spark: SparkSession
    landing: str
    bronze: str
    silver: str
    gold: str

    @classmethod
    def under(cls, spark: SparkSession, root: str) -> Lake:
        return cls(spark, *[f"{root}/{layer}" for layer in ("landing", "bronze", "silver", "gold")])

    def bronze_store(self, dataset: str) -> Store:
        return Store(self.spark, f"{self.bronze}/{dataset}")

    def silver_store(self, table: str) -> Store:
        return Store(self.spark, f"{self.silver}/{table}")

    def gold_store(self) -> Store:
        return Store(self.spark, self.gold)


@dataclass(frozen=True)
class Dataset:
    """One input: a contract name and the folder its CSV files are in."""

    name: str
    source: str | None
    mode: str = "strict"
    separator: str | None = None
    multiline: bool = False
    profile: bool = False  # keep a mergeable profile of every load, collected while it is written


@dataclass(frozen=True)
class LoadResult:
    dataset: str
    status: str  # published, skipped or failed
    version: str | None = None
    rows: int = 0
    rejected: int = 0
    unknown_columns: tuple[str, ...] = ()
    error: str | None = None


# --- Bronze -------------------------------------------------------------------


def run_slot(run_date: date) -> str:
    return f"ano={run_date:%Y}/mes={run_date:%m}/dia={run_date:%d}"


def bronze_file_schema(dataset: str) -> T.StructType:
    """Columns in the bronze files: the contract, the source file, the bad cells."""
    extra = T.StructType.fromDDL(f"{SOURCE_FILE} string, {REJECTS} {REJECTS_TYPE}")
    plain = [T.StructField(f.name, f.dataType) for f in CONTRACTS[dataset].schema.fields]
    return T.StructType(plain + extra.fields)


def _bronze_table_schema(dataset: str) -> T.StructType:
    run = T.StructType.fromDDL("ano int, mes int, dia int, carga string")
    return T.StructType(bronze_file_schema(dataset).fields + run.fields)


def _fitted(raw: DataFrame, dataset: Dataset) -> DataFrame:
    schema = CONTRACTS[dataset.name].schema
    if dataset.mode == "strict":
        typed = apply_contract(raw, schema, keep=(SOURCE_FILE,))
        return typed.withColumn(REJECTS, F.lit(None).cast(REJECTS_TYPE))
    typed = apply_contract(raw, schema, "lenient", keep=(SOURCE_FILE, MALFORMED))
    malformed = F.array(
        F.struct(F.lit("*").alias("coluna"), F.col(MALFORMED).alias("valor"))
    )
    return typed.withColumn(
        REJECTS, F.when(F.col(MALFORMED).isNotNull(), malformed).otherwise(F.col(REJECTS))
    ).drop(MALFORMED)


def _audit_files(written: DataFrame, names: Sequence[str]) -> dict[str, tuple[int, int]]:
    """Clean and rejected rows of each file as written; every listed file must have a clean row."""
    per_file = written.groupBy(SOURCE_FILE).agg(
        F.count_if(F.col(REJECTS).isNull()).alias("limpas"),
        F.count_if(F.col(REJECTS).isNotNull()).alias("rejeitadas"),
    )
    found = {r[SOURCE_FILE]: (r["limpas"], r["rejeitadas"]) for r in per_file.collect()}  # a row per file
    empty = sorted(n for n in names if not found.get(n, (0, 0))[0])
    if empty:
        raise AuditError(f"no data rows in {len(empty)} file(s), such as {empty[0]}")
    return found


def _require_columns(dataset: Dataset, header: csv_files.Header, names: Sequence[str]) -> None:
    have = {c.lower() for c in header.columns}
    missing = [f.name for f in CONTRACTS[dataset.name].schema.fields if f.name.lower() not in have]
    if missing:
        raise ValueError(f"{names[0]} has no column {', '.join(missing)}")


def ingest(lake: Lake, dataset: Dataset, run_date: date) -> LoadResult:
    """Landing copy and bronze load of one dataset for one run date.

    The folder is listed once; files with different headers are fitted to the contract each
    with its own. Rows go to a new version and are audited; then the landing copy is written and
    the files are published. A file delivered again for the date replaces itself, other files stay.
    """
    spark = lake.spark
    files = csv_files.list_csv(spark, dataset.source) if dataset.source else None
    listed = {r["path"]: r["arquivo"] for r in files.collect()} if files is not None else {}  # a row per file
    if not listed:
        return LoadResult(dataset.name, "skipped")
    if len(set(listed.values())) < len(listed):
        raise ValueError(f"a file of {dataset.source} is there twice, plain and with gzip")

    contract = {f.name.lower() for f in CONTRACTS[dataset.name].schema.fields}
    unknown: list[str] = []
    parts = []
    for header, paths in csv_files.by_header(spark, sorted(listed), dataset.separator).items():
        if dataset.mode == "strict":
            _require_columns(dataset, header, [listed[p] for p in paths])
        unknown += [c for c in header.columns if c.lower() not in contract]
        raw = csv_files.read_csv(spark, paths, header, dataset.mode, dataset.multiline)
        parts.append(_fitted(raw, dataset))

    store, version, slot = lake.bronze_store(dataset.name), new_version(), run_slot(run_date)
    rows, seen = reduce(DataFrame.unionByName, parts), Observation()
    if dataset.profile:  # the figures come with the write; the rows are not read again for them
        rows = rows.observe(seen, *quality.sketch_columns(CONTRACTS[dataset.name].schema, F.col(REJECTS).isNull()))
    write_files(rows, store.path(version, slot))
    written = spark.read.schema(bronze_file_schema(dataset.name)).parquet(store.path(version, slot))
    found = _audit_files(written, list(listed.values()))
    csv_files.land(spark, sorted(listed), f"{lake.landing}/{dataset.name}/{run_date:%Y/%m/%d}")
    if dataset.profile:
        _keep_profile(lake, dataset.name, version, quality.sketch_rows(CONTRACTS[dataset.name].schema, seen.get))
    store.publish_all(version, {f"{slot}/{SOURCE_FILE}={name}": clean for name, (clean, _) in found.items()})
    clean, bad = (sum(n[i] for n in found.values()) for i in (0, 1))
    return LoadResult(dataset.name, "published", version, clean, bad, tuple(dict.fromkeys(unknown)))


def _keep_profile(lake: Lake, dataset: str, version: str, rows: Sequence[tuple]) -> None:
    sketches = lake.spark.createDataFrame(list(rows), quality.SKETCH).withColumn("versao", F.lit(version))
    sketches.coalesce(1).write.mode("append").parquet(f"{lake.bronze_store(dataset).root}/_perfis")


def profile_bronze(lake: Lake, dataset: str) -> DataFrame:
    """Profile of all published clean rows of a dataset, merged from what its loads have kept.

    Only the live rows of a version of which some file was replaced, or that kept no profile, are read. Distinct
    values are an estimate within ``quality.distinct_error``; ``quality.column_profile`` counts them exactly.
    """
    store, schema = lake.bronze_store(dataset), CONTRACTS[dataset].schema
    now, replaced, path = store.current(), store.replaced(), f"{store.root}/_perfis"
    if not now:
        raise NotPublished(f"nothing published in {store.root}")
    empty = lake.spark.createDataFrame([], f"{quality.SKETCH}, versao string")
    kept = lake.spark.read.schema(empty.schema).parquet(path) if store.folders(path) else empty
    whole = sorted(set(now.values()) - set(replaced))
    known = {r.versao for r in kept.where(F.col("versao").isin(whole)).select("versao").distinct().collect()}
    sketches = kept.where(F.col("versao").isin(sorted(known))).drop("versao")
    rest = {s: v for s, v in now.items() if v not in known}
    if rest:
        rows = store.read_some_files(_bronze_table_schema(dataset), SOURCE_FILE, rest).filter(F.col(REJECTS).isNull())
        sketches = sketches.unionByName(quality.sketched_profile(rows.select(*schema.names)))
    return quality.merged_profile(sketches)


def load_datasets(
    lake: Lake, datasets: Sequence[Dataset], run_date: date, retries: int = 1, parallel: int = 4
) -> list[LoadResult]:
    """Load independent datasets side by side; a failing one does not stop the others.

    Each attempt writes a version of its own, so retrying is safe.
    """

    def attempt(dataset: Dataset) -> LoadResult:
        for left in range(retries, -1, -1):
            try:
                return ingest(lake, dataset, run_date)
            except Exception as error:  # reported per dataset, raised by require_all
                if left == 0:
                    return LoadResult(dataset.name, "failed", error=f"{type(error).__name__}: {error}")
        raise AssertionError("unreachable")

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        results = list(pool.map(attempt, datasets))
    for result in results:
        if result.status == "published":
            register_bronze(lake, result.dataset)
    return results


def require_all(results: Sequence[LoadResult]) -> None:
    failed = [f"{r.dataset}: {r.error}" for r in results if r.status == "failed"]
    if failed:
        raise JobFailed("; ".join(failed))


def read_bronze(
    lake: Lake,
    dataset: str,
    as_of: int | datetime | None = None,
    deduplicate: bool = False,
    columns: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """Clean published rows with their lineage columns (file, run date, version).

    ``deduplicate`` keeps, per contract key, the row of the latest run date.
    ``columns`` narrows the rows before that, so that less is shuffled. ``where`` picks rows; with ``deduplicate``
    a row is kept only if no row of its key, picked or not, is later.
    """
    df = lake.bronze_store(dataset).read_files(_bronze_table_schema(dataset), SOURCE_FILE, as_of)
    clean = df.filter(F.col(REJECTS).isNull()).drop(REJECTS)
    key, run = CONTRACTS[dataset].key, ["ano", "mes", "dia", "carga"]
    if columns:
        clean = clean.select(*dict.fromkeys([*columns, *key, *run]))
    if not (deduplicate and key):
        return clean if where is None else clean.filter(where)
    if where is None:
        return latest_per_key(clean, key, run)
    picked = clean.filter(where)
    unkeyed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    related = clean.join(picked.select(*key).distinct(), list(key), "left_semi").select(*clean.columns)
    return latest_per_key(related, key, run).filter(where).unionByName(picked.filter(unkeyed))


def read_rejects(lake: Lake, dataset: str, as_of: int | datetime | None = None) -> DataFrame:
    """Published rows with bad cells, which no view shows."""
    df = lake.bronze_store(dataset).read_files(_bronze_table_schema(dataset), SOURCE_FILE, as_of)
    return df.filter(F.col(REJECTS).isNotNull())


# --- Silver and gold ----------------------------------------------------------


@dataclass(frozen=True)
class SilverOptions:
    """Optional cleaning before silver; everything is off unless asked for."""

    deduplicate: bool = False  # one row per contract key over all run dates
    scope: tuple[date, date] | None = None  # first and last day kept
    minutes: tuple[int, int] | None = None  # shortest and longest plausible trip
    consortium_names: Mapping[str, str] | None = None  # tidy names; {} without aliases


def _clean_trips(trips: DataFrame, options: SilverOptions) -> DataFrame:
    if options.scope:
        trips = within_dates(trips, *options.scope, column="data")
    if options.minutes:
        trips = within_range(trips, "tempo_viagem", *options.minutes)
    if options.consortium_names is not None:
        trips = trips.withColumn("consorcio", mapped_name("consorcio", options.consortium_names))
    return trips


def _touched(lake: Lake, dataset: str, day: str, since: int | None, until: int | None, deduplicate: bool) -> set[str]:
    """Months whose rows differ between two publications of a bronze dataset.

    Only files of slots that differ are read. When rows are deduplicated, a changed row can also decide which of its
    copies stands in another month, so the months of all copies count.
    """
    store, key = lake.bronze_store(dataset), CONTRACTS[dataset].key
    schema = _bronze_table_schema(dataset)
    parts = [store.read_some_files(schema, SOURCE_FILE, slots) for slots in store.changes(since, until) if slots]
    if not parts:
        return set()
    rows = reduce(DataFrame.unionByName, [p.filter(F.col(REJECTS).isNull()).select(day, *key) for p in parts])
    months = changes.months_of(rows, day)
    if deduplicate and key:
        copies = read_bronze(lake, dataset, until, columns=(day,)).join(rows.select(*key).distinct(), list(key), "left_semi")
        months |= changes.months_of(copies, day)
    return months


def _build_hourly_rain(lake: Lake, version: str, options: SilverOptions, until: int | None, months: set[str] | None) -> None:
    """Write and publish the hourly rain of ``months``, of all if None."""
    if months is not None and not months:
        return
    where = None if months is None else changes.in_months("data_particao", sorted(months))
    rain = read_bronze(lake, "clima_pluviometria", until, options.deduplicate, RAIN_COLUMNS, where)
    if options.scope:
        rain = within_dates(rain, *options.scope, column="data_particao")
    store = lake.silver_store("chuva_horaria")
    _publish_months(store, _by_month(silver.hourly_rain(rain), "data_particao", version), version, months)


def _by_month(df: DataFrame, day: str, version: str) -> DataFrame:
    """Rows with the columns of their slot, one month's together; AQE splits large months and merges small ones."""
    return _in_slots(df, day, version).hint("rebalance", "parte")


def _in_slots(df: DataFrame, day: str, version: str) -> DataFrame:
    return df.withColumns({"origem": F.lit(changes.BATCH), "parte": changes.month_part(day), "carga": F.lit(version)})


def _publish_months(store: Store, df: DataFrame, version: str, months: set[str] | None) -> None:
    store.write_slots(df, changes.KEYS)
    store.publish_set(_entries(store, version, store.written_slots(version, changes.KEYS), months))


def _entries(store: Store, version: str, written: Mapping[str, int], months: set[str] | None) -> list[tuple]:
    """Publication of the written months; those that were due and have no rows any more are withdrawn."""
    before = [s for s in store.current() if changes.is_batch(s) or not s]
    due = before if months is None else [s for s in before if s in {changes.batch_slot(m) for m in months}]
    return [(s, version, n) for s, n in sorted(written.items())] + [(s, None, 0) for s in sorted(set(due) - set(written))]


def _hourly_of(lake: Lake, months: set[str] | None) -> tuple[DataFrame, int]:
    """Published hourly rain of some months and its exact row number."""
    store = lake.silver_store("chuva_horaria")
    slots = {s: v for s, v in store.current().items() if months is None or s in {changes.batch_slot(m) for m in months}}
    if not slots:
        return lake.spark.createDataFrame([], "data_particao date, hora_medicao int, avg_chuva_1h double"), 0
    hourly = store.read_slots(slots).drop(*changes.KEYS, "carga")
    return hourly, hourly.count()  # from the footers; one row per hour, as it is an aggregate by that key


def _superseded_streams(store: Store, version: str, months: Mapping[str, int]) -> list[tuple]:
    """Publication of streamed slots without the trips that the batch months now have; most need none."""
    streams = {s: v for s, v in store.current().items() if s and not changes.is_batch(s)}
    if not streams or not months:
        return []
    known = store.read_slots(dict.fromkeys(months, version)).select("id_viagem").where("id_viagem IS NOT NULL")
    streamed = store.read_slots(streams).drop("carga")
    hit = streamed.join(known, "id_viagem", "left_semi").select(*changes.KEYS).distinct().collect()  # a row per slot
    slots = {f"origem={r.origem}/parte={r.parte}" for r in hit}
    if not slots:
        return []
    rest = store.read_slots({s: streams[s] for s in slots}).drop("carga").join(known, "id_viagem", "left_anti")
    store.write_slots(rest.select(*silver.SILVER_COLUMNS, *changes.KEYS, F.lit(version).alias("carga")), changes.KEYS)
    left = {s: n for s, n in store.written_slots(version, changes.KEYS).items() if s in slots}
    return [(s, version if s in left else None, left.get(s, 0)) for s in sorted(slots)]


def build_silver(
    lake: Lake,
    options: SilverOptions = SilverOptions(),
    rules: Mapping[str, Column] | None = None,
    full: bool = False,
) -> str:
    """Hourly rain, then the wide trip table, by month; both published. Returns the trips' version.

    Only months that differ since the last build are written, all if there was none, if the options are others or
    if ``full``; without any, nothing is published and the last build's version is returned. The
    hourly rain comes first, so its exact row number decides between a broadcast and a shuffle join. Before
    publication the trips as written are compared with the trips counted while they were read, and ``rules`` must
    hold on every row written. All months go live in one publication, and with them the streamed slots, cut
    by the trips that batch has now.

    A month that was rolled back stays so until its input changes or a full build.
    """
    version, store = new_version(), lake.silver_store("stg_viagens")
    bases, trips_at, rain_at = changes.Bases(store), *(lake.bronze_store(d).last() for d in INPUTS)
    base = None if full else bases.last()
    months = rain_months = None
    if base is not None and base.options == repr(options):
        try:
            rain_months = _touched(lake, "clima_pluviometria", "data_particao", base.rain, rain_at, options.deduplicate)
            months = rain_months | _touched(lake, "viagens_onibus", "data", base.trips, trips_at, options.deduplicate)
        except AnalysisException as error:  # files that were replaced since have been removed
            if not csv_files.path_missing(error):
                raise
            months = rain_months = None
        if months is not None and not months:
            return base.versao
    _build_hourly_rain(lake, version, options, rain_at, rain_months)

    where = None if months is None else changes.in_months("data", sorted(months))
    trips = read_bronze(lake, "viagens_onibus", trips_at, options.deduplicate, TRIP_COLUMNS, where)
    attributes = silver.trip_attributes(_clean_trips(trips, options))
    copies = attributes  # for the layout, where a trip that is there twice does no harm
    if options.deduplicate:
        copies = silver.trip_attributes(_clean_trips(read_bronze(lake, "viagens_onibus", trips_at, False, TRIP_COLUMNS, where), options))
    bounds = clustering.line_bounds(copies)
    seen = Observation()
    counted, (hourly, hours) = attributes.observe(seen, F.count(F.lit(1)).alias("linhas")), _hourly_of(lake, months)
    if fits(hourly, hours):  # rain that is broadcast meets the trips after their shuffle, which is narrower for it
        wide = silver.enrich(clustering.dealt_by_month(counted, copies, bounds), hourly, hours)
    else:
        wide = clustering.dealt_by_month(silver.enrich(counted, hourly, hours), copies, bounds)
    store.write_slots(clustering.in_order(_in_slots(wide, "data_viagem", version), bounds), changes.KEYS)

    written = store.written_slots(version, changes.KEYS)
    rows_in, rows_out = seen.get.get("linhas", 0), sum(written.values())
    if rows_in != rows_out:  # a repeated task counts twice; the trips themselves decide
        rows_in = attributes.count()
    if rows_in != rows_out:
        raise AuditError(f"silver has {rows_out} rows for {rows_in} trips")
    if rules and written:
        quality.require(quality.expectations(store.read_slots(dict.fromkeys(written, version)), rules))
    entries = _entries(store, version, written, months) + _superseded_streams(store, version, written)
    bases.add(version, trips_at, rain_at, repr(options))
    store.publish_set(entries or [("", None, 0)])
    return version


def read_silver(lake: Lake, as_of: int | datetime | None = None) -> DataFrame:
    """The wide trip table: batch months and streamed batches, every trip once between the two."""
    return lake.silver_store("stg_viagens").read(as_of=as_of)


FACT, MEMBERS = "fato_desempenho_viagem", "membros"
MEMBER_COLUMNS = ("data_viagem", "is_weekend", "tipo_dia", "consorcio", "condicao_clima")


def build_gold(lake: Lake, audit: bool = True) -> str:
    """Three dimensions and the fact from published silver, audited and published together.

    The fact has silver's slots: only slots whose silver version has no fact yet are written, clustered by date and
    line as silver's batch months are, with the members of the dimensions they use beside them; the dimensions are the distinct members of all
    slots. Nothing is published if silver has not changed. A date listed with several day types is reported by
    ``gold_report`` but does not block: the calendar is distinct over both by definition.
    """
    store, source = lake.gold_store(), lake.silver_store("stg_viagens")
    now, have = source.current(), store.current()
    if not now:
        raise NotPublished(f"nothing published in {source.root}")
    facts = {s.removeprefix(f"{FACT}/"): v for s, v in have.items() if s}
    if facts == now and "" in have:
        return have[""]
    known = {(r.slot.removeprefix(f"{FACT}/"), r.versao): r.linhas for r in store.history().where(f"slot LIKE '{FACT}/%'").collect()}
    due = {s: v for s, v in now.items() if (s, v) not in known}
    rows = {s: known.get((s, v)) for s, v in now.items()}
    if due:
        wide = source.read_slots(due)
        members = wide.select(*MEMBER_COLUMNS, *changes.KEYS, "carga").distinct()
        with ThreadPoolExecutor(max_workers=2) as pool:
            side = pool.submit(store.write_slots, members.hint("rebalance", "parte"), changes.KEYS, MEMBERS)
            batch = {s: v for s, v in due.items() if changes.is_batch(s)}
            streamed = {s: v for s, v in due.items() if s not in batch}
            if batch:
                store.write_slots(clustering.fact_rows(source.read_slots(batch)), changes.KEYS, FACT, as_they_come=True)
            if streamed:
                store.write_slots(clustering.clustered_fact(source.read_slots(streamed)), changes.KEYS, FACT)
            side.result()
        written = store.read_slots(due, FACT)
        clustering.write_statistics(store, written)
        rows |= {f"origem={r.origem}/parte={r.parte}": r.n for r in written.groupBy(*changes.KEYS).agg(F.count(F.lit(1)).alias("n")).collect()}
    version = new_version()
    members = store.read_slots(now, MEMBERS)
    tables = {"dim_calendario": gold.dim_calendar(members), "dim_consorcio": gold.dim_consortium(members), "dim_clima": gold.dim_weather(members)}
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        writes = [pool.submit(write_files, df, store.path(version, table=t)) for t, df in tables.items()]
        for write in writes:
            write.result()
    if audit and due:
        read = {t: lake.spark.read.parquet(store.path(version, table=t)) for t in tables}
        blocking = gold_report(wide, {**read, FACT: store.read_slots(due, FACT)}).filter(
            (F.col("violacoes") > 0)
            & ~F.col("verificacao").isin("dim_calendario: chave repetida")
            & ~F.col("verificacao").endswith("chave nula no fato")
        )
        found = [f"{r['verificacao']} ({r['violacoes']})" for r in blocking.collect()]
        if found:
            raise AuditError("gold: " + "; ".join(found))
    entries = [(f"{FACT}/{s}", v, rows[s]) for s, v in sorted(now.items()) if facts.get(s) != v]
    entries += [(f"{FACT}/{s}", None, 0) for s in sorted(set(facts) - set(now))]
    store.publish_set([("", version, None), *entries])
    return version


def gold_report(wide: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Star integrity of a set of gold tables."""
    keys = {"dim_calendario": "data_id", "dim_consorcio": "consorcio_id", "dim_clima": "clima_id"}
    dimensions = {name: (tables[name], key) for name, key in keys.items()}
    return quality.star_integrity(wide, tables["fato_desempenho_viagem"], dimensions, keys)


def remove_old_versions(lake: Lake, datasets: Sequence[str], keep: int, unpublished_before: datetime) -> list[str]:
    """Delete what no reader needs: all but the last ``keep`` versions of each slot, and old unpublished ones.

    Nothing calls this by itself. Readers that look at versions now deleted (``as_of``) will fail.
    """
    stores = [lake.bronze_store(d) for d in datasets]
    stores += [lake.silver_store(t) for t in ("chuva_horaria", "stg_viagens")] + [lake.gold_store()]
    return [path for store in stores for path in store.remove_old(keep, unpublished_before)]


def read_gold(lake: Lake, table: str, as_of: int | datetime | None = None) -> DataFrame:
    """A published table of the star; ``clustering.read_fact`` opens only the fact files a question needs."""
    store = lake.gold_store()
    now = store.current(as_of)
    if table != FACT:
        if "" not in now:
            raise NotPublished(f"nothing published in {store.root}")
        return lake.spark.read.parquet(store.path(now[""], table=table))
    slots = {s.removeprefix(f"{FACT}/"): v for s, v in now.items() if s}
    return store.read_slots(slots, FACT).drop(*changes.KEYS, "carga")


# --- Views --------------------------------------------------------------------


def register_bronze(lake: Lake, dataset: str) -> None:
    """``bronze.<dataset>``: clean rows of the published files, under the contract's names.

    ``bronze.<dataset>_linhagem`` has file, run date and version beside them. ``carga`` is a partition
    folder, so files of other versions are not opened.
    """
    store = lake.bronze_store(dataset)
    now = store.current()
    versions = sorted(set(now.values()))
    if not versions:
        return
    catalog.create_layers(lake.spark)
    table = _bronze_table(lake, dataset, now)
    published = ", ".join(f"'{v}'" for v in versions)
    old = store.stale_rows(SOURCE_FILE)
    live = f"carga IN ({published}) AND {REJECTS} IS NULL" + (f" AND NOT ({old})" if old else "")
    columns = ", ".join(f"`{f.name}`" for f in CONTRACTS[dataset].schema.fields)
    catalog.replace_view(lake.spark, f"bronze.{dataset}", f"SELECT {columns} FROM {table} WHERE {live}")
    lineage = f"{columns}, {SOURCE_FILE}, ano, mes, dia, carga"
    catalog.replace_view(
        lake.spark, f"bronze.{dataset}_linhagem", f"SELECT {lineage} FROM {table} WHERE {live}"
    )


def _bronze_table(lake: Lake, dataset: str, now: Mapping[str, str]) -> str:
    """``bronze.<dataset>_arquivos``: the files of every published load, by run date and version.

    The table is made once per catalog, and folders that are published now are added; no folder is listed. Folders of
    versions that are current no more stay in the table, where the views leave them out.
    """
    store, schema = lake.bronze_store(dataset), _bronze_table_schema(dataset)
    name, keys = f"bronze.{dataset}_arquivos", ("ano", "mes", "dia", "carga")
    if lake.spark.catalog.tableExists(name) and not catalog.is_over(lake.spark, name, store.root):
        lake.spark.sql(f"DROP TABLE {name}")  # an external table of another lake: its files stay
    catalog.ensure_external_table(lake.spark, name, store.root, schema, keys, recover=False)
    for folder, version in sorted({(slot.rpartition("/")[0], v) for slot, v in now.items()}):
        run = {k: int(v) for k, v in (part.split("=", 1) for part in folder.split("/"))}
        catalog.ensure_partition(lake.spark, name, {**run, "carga": version}, store.path(version, folder))
    return name


def _slots_view(lake: Lake, name: str, folder: str, slots: Mapping[str, str], columns: Sequence[str]) -> None:
    """A view over the published folders of a table in slots; others are not opened, as the keys are partitions."""
    by_version: dict[str, list[str]] = {}
    for slot, version in slots.items():
        by_version.setdefault(version, []).append("/".join(p.split("=", 1)[1] for p in slot.split("/")))
    live = [
        f"(carga = {sql_text(v)} AND concat_ws('/', {', '.join(changes.KEYS)}) IN ({', '.join(map(sql_text, sorted(names)))}))"
        for v, names in sorted(by_version.items())
    ]
    query = f"SELECT {', '.join(columns)} FROM parquet.`{folder}` WHERE {' OR '.join(live)}"
    catalog.replace_view(lake.spark, name, query)


def register_silver(lake: Lake) -> None:
    catalog.create_layers(lake.spark)
    store = lake.silver_store("stg_viagens")
    slots = store.current()
    if slots:
        _slots_view(lake, "silver.viagens_processadas", store.root, slots, silver.SILVER_COLUMNS)


def register_gold(lake: Lake) -> None:
    """The four gold views, of one publication. Replacing them is atomic per view."""
    catalog.create_layers(lake.spark)
    store = lake.gold_store()
    now = store.current()
    if "" not in now:
        return
    for table in GOLD_TABLES[:3]:
        catalog.replace_view(lake.spark, f"gold.{table}", f"SELECT * FROM parquet.`{store.path(now[''], table=table)}`")
    slots = {s.removeprefix(f"{FACT}/"): v for s, v in now.items() if s}
    _slots_view(lake, "gold.fato_viagens", f"{store.root}/{FACT}", slots, tuple(gold.FACT_COLUMNS))


def register_views(lake: Lake, datasets: Sequence[str]) -> None:
    for dataset in datasets:
        register_bronze(lake, dataset)
    register_silver(lake)
    register_gold(lake)


def run(
    lake: Lake, datasets: Sequence[Dataset], run_date: date, options: SilverOptions = SilverOptions()
) -> list[LoadResult]:
    """Load, build and expose everything for one run date; raises if a dataset failed.

    Silver and gold are built whenever trips and rain are both published, even
    if another dataset failed.
    """
    results = load_datasets(lake, datasets, run_date)
    ready = all(lake.bronze_store(d).current() for d in INPUTS)
    if ready:
        build_silver(lake, options)
        build_gold(lake)
    register_views(lake, [d.name for d in datasets])
    require_all(results)
    return results
