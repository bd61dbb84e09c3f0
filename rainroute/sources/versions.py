"""Write, audit, publish: versioned folders and a small publication table.

Data is written to a folder of its own (``carga=<id>``) that no reader looks
at. After the audit one row in the publication table makes it the version of
its slot: a source file of a run date in bronze, a month or a stream's batch in silver and in the
fact table. Slots published together are one write of that table, so readers see all of them or none. A row
without a version withdraws its slot. Older versions stay readable, and rolling back is one more row.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CODEC = "zstd"  # ids and distances, most of a file, come out a third smaller than with Spark's default
WRITERS, OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters", 16
PUBLICATIONS = "slot string, versao string, linhas bigint, ordem bigint, publicado_em timestamp, volta boolean"


class NotPublished(LookupError):
    """The dataset has no published version."""


def new_version() -> str:
    return f"v{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def write_files(df: DataFrame, path: str, cluster_by: tuple[str, ...] = ()) -> None:
    """Write Parquet to a new folder.

    Without ``cluster_by`` this is map-only: output files follow the input
    splits. With it, rows are shuffled to one folder per value; AQE's rebalance
    splits large values over several files and merges small ones.
    """
    if cluster_by:
        df.hint("rebalance", *cluster_by).write.partitionBy(*cluster_by).parquet(path, compression=CODEC)
    else:
        df.write.parquet(path, compression=CODEC)


def sql_text(value: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Store:
    """One dataset, or a group of tables published together, under ``root``."""

    spark: SparkSession
    root: str

    def path(self, version: str, slot: str = "", table: str = "") -> str:
        return "/".join(p for p in (self.root, slot, f"carga={version}", table) if p)

    @property
    def _log_path(self) -> str:
        return f"{self.root}/_publicacoes"

    def history(self) -> DataFrame:
        """All publications, oldest first by ``ordem``."""
        if not self.folders(self._log_path):
            return self.spark.createDataFrame([], PUBLICATIONS)
        return self.spark.read.schema(PUBLICATIONS).parquet(self._log_path)

    def publish(self, version: str, slot: str = "", rows: int | None = None) -> int:
        """Make ``version`` current for its slot; returns the publication number (a time in ns)."""
        return self.publish_all(version, {slot: rows})

    def publish_all(self, version: str, slots: Mapping[str, int | None], undo: bool = False) -> int:
        """Make ``version`` current for several slots at once."""
        return self.publish_set([(slot, version, rows) for slot, rows in slots.items()], undo)

    def publish_set(self, entries: Sequence[tuple[str, str | None, int | None]], undo: bool = False) -> int:
        """Publish (slot, version, rows) entries at once; a version of None withdraws the slot."""
        order, now = time.time_ns(), datetime.now(timezone.utc)
        entries = [(slot, version, rows, order, now, undo) for slot, version, rows in entries]
        self.spark.createDataFrame(entries, PUBLICATIONS).coalesce(1).write.mode("append").parquet(self._log_path)
        return order

    def rollback(self, slot: str = "", to: str | None = None) -> str:
        """Publish version ``to`` of the slot again, by default the one published before its present one."""
        entries = self.history().filter(F.col("slot") == slot).orderBy("ordem").collect()
        first = [e for e in entries if not e["volta"] and e["versao"] is not None]
        if to is None and entries:
            withdrawn = entries[-1]["versao"] is None
            at = max((i for i, e in enumerate(first) if e["versao"] == entries[-1]["versao"]), default=len(first) * withdrawn)
            first = [e for e in first[:at] if e["versao"] != entries[-1]["versao"]]
        elif to is not None:
            first = [e for e in first if e["versao"] == to]
        if not first:
            raise NotPublished(f"nothing to roll back to in {self.root}/{slot}")
        self.publish_all(first[-1]["versao"], {slot: first[-1]["linhas"]}, undo=True)
        return first[-1]["versao"]

    def restore(self, as_of: int | datetime) -> int:
        """Publish every slot as it was; slots that did not exist then are withdrawn."""
        then, now = self.current(as_of), self.current()
        changed = [(slot, then.get(slot), None) for slot in sorted({*then, *now}) if then.get(slot) != now.get(slot)]
        return self.publish_set(changed, undo=True) if changed else self.last() or 0

    def last(self) -> int | None:
        """Number of the latest publication."""
        return self.history().coalesce(1).agg(F.max("ordem")).first()[0]

    def _until(self, as_of: int | datetime | None) -> DataFrame:
        log = self.history()
        if isinstance(as_of, datetime):
            return log.filter(F.col("publicado_em") <= F.lit(as_of))
        return log if as_of is None else log.filter(F.col("ordem") <= as_of)

    def current(self, as_of: int | datetime | None = None) -> dict[str, str]:
        """Slot -> version, now or as of a publication number or time.

        One entry per slot, so at most one per file and run date reaches the driver.
        """
        # The publication table is small: one task, without a shuffle.
        latest = self._until(as_of).coalesce(1).groupBy("slot").agg(F.max_by("versao", "ordem").alias("versao"))
        return {r["slot"]: r["versao"] for r in latest.filter(F.col("versao").isNotNull()).collect()}

    def replaced(self, as_of: int | datetime | None = None) -> dict[str, list[str]]:
        """Version -> its slots that another version is current for, of versions still current somewhere."""
        now = self.current(as_of)
        kept = set(now.values())
        pairs = self._until(as_of).where(F.col("versao").isNotNull()).select("slot", "versao").distinct().collect()
        out: dict[str, list[str]] = {}
        for slot, version in sorted(pairs):
            if version in kept and now.get(slot) != version:
                out.setdefault(version, []).append(slot)
        return out

    def remove_old(self, keep: int, unpublished_before: datetime) -> list[str]:
        """Delete version folders that are not among the last ``keep`` publications of any slot.

        Folders that were never published go if they were begun before ``unpublished_before`` (UTC), so that
        a load that is still writing is left alone. Returns the deleted paths.
        """
        if keep < 1:
            raise ValueError("the current version is always kept")
        entries = self.history().where(F.col("versao").isNotNull()).select("slot", "versao", "ordem").collect()  # a row per publication
        latest: dict[str, dict[str, int]] = {}
        for slot, version, order in entries:
            known = latest.setdefault(slot, {})
            known[version] = max(order, known.get(version, 0))
        kept = {v for known in latest.values() for v in sorted(known, key=known.get)[-keep:]}
        published = {version for _, version, _ in entries}
        begun = f"v{unpublished_before:%Y%m%dT%H%M%S}"
        gone = []
        for path in self._version_folders():
            version = path.rpartition("carga=")[2]
            if version not in kept and (version in published or version < begun):
                self._files().delete(self._hadoop_path(path), True)
                gone.append(path)
        return gone

    def _hadoop_path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._hadoop_path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def folders(self, pattern: str) -> list[str]:
        """Paths that match a glob pattern, in any file system Spark reads."""
        path = self._hadoop_path(pattern)
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return sorted(str(status.getPath().toString()) for status in found)

    def _version_folders(self) -> list[str]:
        patterns = (f"{self.root}/carga=*", f"{self.root}/*=*/*=*/*=*/carga=*", f"{self.root}/*=*/carga=*", f"{self.root}/*=*/*=*/carga=*", f"{self.root}/*/*=*/*=*/carga=*")
        return sorted({path for p in patterns for path in self.folders(p)})

    def read_files(self, schema: T.StructType, file: str, as_of: int | datetime | None = None) -> DataFrame:
        """Published rows of slots ``<folder>/<file column>=<name>``, with the partition columns of the folders.

        A version's rows of a file that was replaced later are left out; the condition
        is pushed to the files' statistics.
        """
        now = self.current(as_of)
        if not now:
            raise NotPublished(f"nothing published in {self.root}")
        df = self._folders(schema, now)
        old = self.stale_rows(file, as_of)
        return df.filter(f"NOT ({old})") if old else df

    def _folders(self, schema: T.StructType, slots: Mapping[str, str]) -> DataFrame:
        paths = sorted({self.path(version, slot.rpartition("/")[0]) for slot, version in slots.items()})
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths)

    def read_some_files(self, schema: T.StructType, file: str, slots: Mapping[str, str]) -> DataFrame:
        """Rows of these slots ``<folder>/<file column>=<name>`` in these versions, current or not."""
        by_version: dict[str, list[str]] = {}
        for slot, version in slots.items():
            by_version.setdefault(version, []).append(sql_text(slot.rpartition("/")[2].split("=", 1)[1]))
        wanted = [f"(carga = '{v}' AND {file} IN ({', '.join(names)}))" for v, names in sorted(by_version.items())]
        return self._folders(schema, slots).filter(" OR ".join(wanted))

    def changes(self, since: int | None, until: int | None = None) -> tuple[dict[str, str], dict[str, str]]:
        """Slots that differ between two publications: as they were, and as they are."""
        then = self.current(since) if since is not None else {}
        now = self.current(until)
        differ = {s for s in {*then, *now} if then.get(s) != now.get(s)}
        return {s: v for s, v in then.items() if s in differ}, {s: v for s, v in now.items() if s in differ}

    def write_slots(self, df: DataFrame, keys: tuple[str, ...], under: str = "", as_they_come: bool = False) -> None:
        """Write rows to the slot folders that their ``keys`` and ``carga`` name; other folders are left alone.

        A repeated write of the same version replaces itself. ``as_they_come``: a task's rows are not sorted by
        folder before, but keep their order; it has a file open for each folder, up to ``OPEN_FILES``.
        """
        conf, before = self.spark.conf, self.spark.conf.get(WRITERS)
        if as_they_come:
            conf.set(WRITERS, OPEN_FILES)
        try:
            (
                df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(*keys, "carga").parquet("/".join(p for p in (self.root, under) if p), compression=CODEC)
            )
        finally:
            if as_they_come:
                conf.set(WRITERS, before)

    def written_slots(self, version: str, keys: tuple[str, ...], under: str = "") -> dict[str, int]:
        """Slot -> rows of the folders of a version, from listing and footers."""
        pattern = "/".join([p for p in (self.root, under) if p] + [f"{k}=*" for k in keys] + [f"carga={version}"])
        found = self.folders(pattern)
        if not found:
            return {}
        base = "/".join(p for p in (self.root, under) if p)
        counted = self.spark.read.option("basePath", base).parquet(*found).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        return {"/".join(f"{k}={r[k]}" for k in keys): r["n"] for r in counted.collect()}  # a row per slot

    def read_slots(self, slots: Mapping[str, str], under: str = "") -> DataFrame:
        """Rows of these slots in these versions, with the slot's keys and ``carga`` as columns."""
        if not slots:
            raise NotPublished(f"no slots of {self.root}")
        base = "/".join(p for p in (self.root, under) if p)
        paths = [f"{base}/{slot}/carga={version}" for slot, version in sorted(slots.items())]
        return self.spark.read.option("basePath", base).parquet(*paths)

    def stale_rows(self, file: str, as_of: int | datetime | None = None) -> str:
        """SQL condition that holds for rows of replaced files; empty if there are none."""
        found = []
        for version, slots in self.replaced(as_of).items():
            names = ", ".join(sql_text(slot.rpartition("/")[2].split("=", 1)[1]) for slot in slots)
            found.append(f"(carga = '{version}' AND {file} IN ({names}))")
        return " OR ".join(found)

    def read(
        self,
        table: str = "",
        schema: T.StructType | None = None,
        as_of: int | datetime | None = None,
        slots: bool = False,
    ) -> DataFrame:
        """Published data; only folders of published versions are listed.

        ``slots`` adds the partition columns found in the slot paths.
        """
        versions = self.current(as_of)
        if not versions:
            raise NotPublished(f"nothing published in {self.root}")
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        if slots:
            reader = reader.option("basePath", self.root)
        return reader.parquet(*[self.path(v, s, table) for s, v in sorted(versions.items())])
