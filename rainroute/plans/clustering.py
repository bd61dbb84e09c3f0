"""The fact laid out so that a question opens few files: clustered by date and line, with statistics per file.

Inside a slot rows are ordered by a number whose bits come in turn from the day and from the place of the line among all
lines (cut into ``LINE_RANGES`` ranges of equal size), so each file holds a few days of a few lines. Batch slots get this
order when silver is written, in the one shuffle of the trips, and the fact keeps it; streamed slots are ordered for
the fact. What every file holds is kept beside the publications; ``read_fact`` picks files by it before Spark lists any folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainroute.plans import gold
from rainroute.plans.changes import KEYS
from rainroute.sources.versions import NotPublished, Store, sql_text

FACT = "fato_desempenho_viagem"
LINE_RANGES = 64
DAY_BITS, LINE_BITS = 5, 6
FILES = "_arquivos"
FILE_ROWS = 1_000_000  # a month of more trips is written as several ranges of the interleaved number


def interleaved(first: Column, second: Column, first_bits: int, second_bits: int) -> Column:
    """The bits of two numbers in turn, highest first, beginning with the first number's."""
    out, place = F.lit(0).cast("int"), 0
    for i in range(max(first_bits, second_bits)):  # from the lowest bits up
        for number, bits in ((second, second_bits), (first, first_bits)):
            if i < bits:
                out = out.bitwiseOR(F.shiftleft(F.shiftright(number, i).bitwiseAND(F.lit(1)), place))
                place += 1
    return out


def line_bounds(lines: DataFrame) -> list[str]:
    """The last line of each of ``LINE_RANGES`` ranges of the distinct lines in sorted order, but for the last range."""
    ranged = lines.select("linha").where("linha IS NOT NULL").distinct().repartitionByRange(LINE_RANGES, "linha")
    last = ranged.groupBy(F.spark_partition_id().alias("faixa")).agg(F.max("linha").alias("ultima"))
    return sorted(r.ultima for r in last.collect())[:-1]  # a row per range


def line_place(line: Column, bounds: Sequence[str]) -> Column:
    """Which range a line is in, 0 without a line: a search by halves, which needs no join however many lines there are."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(line <= F.lit(bounds[middle]), between(low, middle)).otherwise(between(middle + 1, high))

    return F.when(line.isNull(), F.lit(0)).otherwise(between(0, len(bounds)))


def trip_number(day: Column, line: Column, bounds: Sequence[str]) -> Column:
    return interleaved(F.coalesce(F.dayofmonth(day), F.lit(0)), line_place(line, bounds), DAY_BITS, LINE_BITS)


def clustered_fact(wide: DataFrame) -> DataFrame:
    """Fact rows of silver slots with the slots' columns, ranged and sorted by slot and by the interleaved number.

    Rows of one day and line range are told apart by a hash of the trip, so a line with a third of all rows fills
    several files.
    """
    rows = fact_rows(wide)
    number = trip_number(F.col("data_id"), F.col("linha"), line_bounds(rows))
    keyed = rows.withColumns({"__z": number, "__tie": F.xxhash64("linha", "id_viagem")})
    order = [*KEYS, "carga", "__z", "__tie"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(*rows.columns)


def fact_rows(wide: DataFrame) -> DataFrame:
    """Fact rows of silver slots with the slots' columns, in silver's order."""
    return wide.select(*[F.col(source).alias(name) for name, source in gold.FACT_COLUMNS.items()], *KEYS, "carga")


def dealt_by_month(trips: DataFrame, rows_of: DataFrame, bounds: Sequence[str]) -> DataFrame:
    """Trips shuffled once, one month's together; of a month with more than ``FILE_ROWS``, one range of the number's.

    ``rows_of`` has the months' trips, for the sizes only. AQE merges small months and splits what one range has too much.
    """
    month = F.year("data_viagem") * 12 + F.month("data_viagem")
    large = rows_of.groupBy(month.alias("m")).count().where(F.col("count") > FILE_ROWS).collect()  # a row per month
    piece = F.lit(0)
    if large:
        counts = F.create_map(*[F.lit(x) for r in large for x in (r["m"], -(-r["count"] // FILE_ROWS))])
        number = trip_number(F.col("data_viagem"), F.col("linha"), bounds)
        piece = F.floor(number * F.coalesce(F.element_at(counts, month), F.lit(1)) / (1 << (DAY_BITS + LINE_BITS))).cast("int")
    return trips.withColumns({"__month": month, "__piece": piece}).hint("rebalance", "__month", "__piece").drop("__month", "__piece")


def in_order(wide: DataFrame, bounds: Sequence[str]) -> DataFrame:
    """Silver rows with their slot's columns, each task's sorted by slot and by the interleaved number."""
    number = trip_number(F.col("data_viagem"), F.col("linha"), bounds)
    order = [*KEYS, "carga", "__z", "data_viagem", "linha"]
    return wide.withColumn("__z", number).sortWithinPartitions(*order).drop("__z")


def write_statistics(store: Store, written: DataFrame) -> None:
    """One row per file of the written fact: the range of dates and lines it holds; a repeated write replaces itself."""
    found = written.groupBy(*KEYS, "carga", F.col("_metadata.file_path").alias("arquivo")).agg(
        F.count(F.lit(1)).alias("linhas"), F.min("data_id").alias("primeira_data"), F.max("data_id").alias("ultima_data"),
        F.min("linha").alias("primeira_linha"), F.max("linha").alias("ultima_linha"),
    )
    store.write_slots(found.hint("rebalance", "parte"), KEYS, FILES)


def fact_files(store: Store, dates: tuple[date, date] | None = None, lines: Sequence[str] | None = None, as_of=None) -> list[str]:
    """Published fact files that can hold rows of these dates (first and last) and lines."""
    slots = {s.removeprefix(f"{FACT}/"): v for s, v in store.current(as_of).items() if s}
    if not slots:
        raise NotPublished(f"no fact in {store.root}")
    files = store.read_slots(slots, FILES)
    if dates:
        files = files.where((F.col("ultima_data") >= F.lit(dates[0])) & (F.col("primeira_data") <= F.lit(dates[1])))
    if lines is not None:
        inside = [f"({sql_text(x)} BETWEEN primeira_linha AND ultima_linha)" for x in lines] or ["false"]
        files = files.where(" OR ".join(inside))
    return sorted({r.arquivo for r in files.select("arquivo").distinct().collect()})  # a row per file that is opened


def read_fact(store: Store, dates: tuple[date, date] | None = None, lines: Sequence[str] | None = None, as_of=None) -> DataFrame:
    """Fact rows of some dates and lines, from the files that can hold them."""
    files = fact_files(store, dates, lines, as_of)
    base = f"{store.root}/{FACT}"
    if not files:
        slots = {s.removeprefix(f"{FACT}/"): v for s, v in store.current(as_of).items() if s}
        return store.read_slots(slots, FACT).drop(*KEYS, "carga").limit(0)
    rows = store.spark.read.option("basePath", base).parquet(*files).drop(*KEYS, "carga")
    if dates:
        rows = rows.where(F.col("data_id").between(F.lit(dates[0]), F.lit(dates[1])))
    return rows if lines is None else rows.where(F.col("linha").isin(list(lines)))
