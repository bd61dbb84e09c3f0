"""CSV input: listing, header, contract-first reading and the landing copy."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_ONLY = "*.[cC][sS][vV]{,.gz}"
SOURCE_FILE = "_arquivo"
MALFORMED = "_linha_malformada"
SEPARATORS = (",", ";", "\t", "|")
#: Text is written once and read seldom, so it is compressed, at the level that costs least time.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _file_name() -> Column:
    """Name of the file a row comes from; the metadata column has it URL-encoded.

    A file delivered with gzip goes by its plain name: ``a.csv.gz`` is ``a.csv``.
    """
    name = F.col("_metadata.file_name")
    name = F.when(name.endswith(".gz"), name.substr(F.lit(1), F.length(name) - 3)).otherwise(name)
    plain = F.url_decode(F.regexp_replace(name, r"\+", "%2B"))
    return F.when(name.contains("%"), plain).otherwise(name)


def _literal(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def list_csv(spark: SparkSession, folder: str) -> DataFrame | None:
    """Name, path and size of the CSV files directly in ``folder``; None if there is no folder.

    Only metadata is read: the content column of the binary source is not selected.
    """
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", CSV_ONLY).load(folder)
    except AnalysisException as error:
        if path_missing(error):
            return None
        raise
    return found.select(_file_name().alias("arquivo"), "path", "length")


@dataclass(frozen=True)
class Header:
    columns: tuple[str, ...]
    separator: str


def read_header(spark: SparkSession, path: str, separator: str | None = None) -> Header:
    """First line of one file; the separator giving most columns wins if none is set."""
    first = spark.read.text(_literal(path)).first()
    if first is None:
        raise ValueError(f"no header line in {path}")
    line = first["value"].lstrip("\ufeff")

    def split(sep: str) -> list[str]:
        return next(csv.reader([line], delimiter=sep))

    sep = separator or max(SEPARATORS, key=lambda s: len(split(s)))
    names = [n.strip() or f"column{i}" for i, n in enumerate(split(sep))]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"repeated column names in the header of {path}")
    return Header(tuple(names), sep)


def by_header(spark: SparkSession, paths: Sequence[str], separator: str | None = None) -> dict[Header, list[str]]:
    """Files with the same header and separator together; one small job per file reads its first line."""
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(lambda path: read_header(spark, path, separator), paths))
    groups: dict[Header, list[str]] = {}
    for header, path in zip(headers, paths, strict=True):
        groups.setdefault(header, []).append(path)
    return groups


def read_csv(
    spark: SparkSession,
    source: str | Sequence[str],
    header: Header,
    mode: str = "strict",
    multiline: bool = False,
) -> DataFrame:
    """CSV files, listed or all of a folder, as text columns plus the source file name.

    Every file's own header is checked where it is read, so a file that has other
    columns by then fails the job instead of shifting values. Records
    with a wrong number of cells fail (``strict``) or are kept whole in
    ``_linha_malformada`` (``lenient``).
    """
    fields = [T.StructField(c, T.StringType()) for c in header.columns]
    lenient = mode == "lenient"
    if lenient:
        fields.append(T.StructField(MALFORMED, T.StringType()))
    reader = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", CSV_ONLY)
        .option("sep", header.separator)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE" if lenient else "FAILFAST")
    )
    if lenient:
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    return reader.csv(_source(source)).withColumn(SOURCE_FILE, _file_name())


def _source(source: str | Sequence[str]) -> str | list[str]:
    return source if isinstance(source, str) else [_literal(path) for path in source]


def infer_csv(spark: SparkSession, folder: str, separator: str = ",") -> DataFrame:
    """Types guessed from the data, for files without a contract. Costs an extra pass."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("preferDate", True)
        .option("pathGlobFilter", CSV_ONLY)
        .option("sep", separator)
        .option("escape", '"')
        .csv(folder)
    )


def land(spark: SparkSession, paths: Sequence[str], target: str) -> None:
    """Copy the files' lines, header included, to one directory per source file, with gzip.

    A file's directory is replaced when its new lines are written; other files of the target stay.
    """
    lines = spark.read.text(_source(paths)).select("value", _file_name().alias("arquivo"))
    writer = lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("arquivo").options(**GZIP).text(target)
