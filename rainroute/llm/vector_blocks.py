"""Vectors in blocks by cell of an index, queries in packs, and their meeting.

A block holds at most ``BLOCK`` rows of one cell, a pack at most ``PACK`` queries. Consecutive cells with few rows make a
tile, a cell with many rows has several, so a tile holds ``SALT`` rows or few more and a cell with a third of all rows is
many keys. A visit sends those of a pack that want any cell of a tile to it, once, with the cells each of them wants. Visits
and blocks are dealt by tile; a task holds the blocks of one tile and meets its visits one after another. One matrix
product scores a visit against a block, and leaves per query a few rows. What a task has found for a query bounds what its
later rows have to reach. Blocks are cut from rows ranged by (cell, label, id), so no group is ever gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .tasks import arrow_map

BLOCK = 1024
PACK = 512
SALT = 131_072
TILES = 64  # as many at least, where there are blocks for it, so that tasks share the work
ROWS_OUT = 50_000  # found rows that a task collects before it gives them out


def matrix(column: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """Rows of a list column, filled up with zeros to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.asarray(column.offsets)
    sizes = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]] if len(sizes) else np.empty(0)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width).astype(kind)
    out = np.zeros((len(sizes), width), dtype=kind)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def finite(column: str):
    """Neither null nor with a null or non-finite component."""
    fine = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    return F.coalesce(F.forall(F.col(column).cast("array<double>"), fine), F.lit(False))


class Tiles:
    """The tiles of cells with so many rows: cells in order, each one's first tile, how many it has, and its place there."""

    def __init__(self, counts: dict[int, int]):
        most = min(SALT, max(BLOCK, sum(counts.values()) // TILES))
        self.cells = sorted(counts)
        self.first, self.several, self.place = {}, {}, {}
        tile, held, place = 0, 0, 0
        for cell in self.cells:
            n = -(-counts[cell] // most)
            if held and held + counts[cell] > most:
                tile, held, place = tile + 1, 0, 0
            self.first[cell], self.several[cell], self.place[cell] = tile, n, place
            held, place = held + counts[cell], place + 1
            if n > 1:
                tile, held, place = tile + n, 0, 0

    def spans(self) -> list[tuple[int, int, int, int]]:
        """(first tile, number of them, first cell, last cell + 1): cells by their position in ``cells``."""
        starts = [i for i, cell in enumerate(self.cells) if self.place[cell] == 0]
        return [
            (self.first[self.cells[i]], self.several[self.cells[i]], i, j)
            for i, j in zip(starts, [*starts[1:], len(self.cells)], strict=True)
        ]


def tables(batches: Iterator[pa.RecordBatch], rows: int, same: str | None = None) -> Iterator[pa.Table]:
    """Consecutive rows, at most ``rows`` at a time and, with ``same``, all alike in that column."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        values = np.asarray(batch.column(same)) if same else None
        start = 0
        while start < batch.num_rows:
            stop = min(batch.num_rows, start + rows - size)
            if same:
                if size and values[start] != last:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
                    continue
                last = values[start]
                changes = np.flatnonzero(values[start:stop] != last)
                stop = start + int(changes[0]) if len(changes) else stop
            held.append(batch.slice(start, stop - start))
            size += stop - start
            start = stop
            if size == rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def blocks_of(rows: DataFrame, width: int, counts: dict[int, int], kind: str) -> DataFrame:
    """Written blocks (tile, place, ids, labels, vectors) of rows (id, label, vector, cell); ``kind``: numpy type kept."""
    tiles = Tiles(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables(batches, BLOCK, "cell"):
            cell, ids = t.column("cell")[0].as_py(), np.asarray(t.column("id"))
            tile = tiles.first[cell] + (int(ids[0]) * 0x9E3779B97F4A7C15 >> 32 & 0xFFFFFFFF) % tiles.several[cell]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tile], pa.int32()), pa.array([tiles.place[cell]], pa.int32()), pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                    pa.array([np.asarray(t.column("label")).astype("<i8").tobytes()], pa.binary()),
                    pa.array([matrix(t.column("vector"), width).astype(kind).tobytes()], pa.binary()),
                ],
                ["tile", "place", "ids", "labels", "vectors"],
            )

    ranged = rows.select("cell", "label", "id", "vector").repartitionByRange("cell", "label", "id").sortWithinPartitions("cell", "label", "id")
    return materialise(arrow_map(ranged, run, "tile int, place int, ids binary, labels binary, vectors binary"), "vector-blocks")


def visits_of(queries: DataFrame, order: list[str], wanted: Callable[[pa.Table], np.ndarray], counts: dict[int, int],
              payload: Callable[[pa.Table, np.ndarray], dict[str, bytes]], names: list[str]) -> DataFrame:
    """(tile, pack, who, cells, payload): packs of queries sorted by ``order``, those of a pack that want a cell of a tile.

    ``wanted``: a pack's table of queries by cells (in order), true where a query goes there; ``who``: places in the pack;
    ``cells``: each one's row of bits over the cells of the tile.
    """
    spans = Tiles(counts).spans()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for pack in tables(batches, PACK):
            asked = wanted(pack)
            for tile, n, i, j in spans:
                who = np.flatnonzero(asked[:, i:j].any(axis=1))
                if not len(who):
                    continue
                sent = payload(pack, who)
                sent["who"], sent["cells"] = who.astype("<i4").tobytes(), np.packbits(asked[who, i:j], axis=1).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(tile, tile + n), pa.int32()), pa.array([number] * n, pa.int64()),
                        *(pa.array([sent[c]] * n, pa.binary()) for c in ("who", "cells", *names)),
                    ],
                    ["tile", "pack", "who", "cells", *names],
                )
            number += 1

    # A number of partitions that is given stays: the rows are few, the work on them is not.
    ranged = queries.repartitionByRange(partitions(queries), *order).sortWithinPartitions(*order)
    return arrow_map(ranged, run, "tile int, pack long, " + ", ".join(f"{c} binary" for c in ("who", "cells", *names)))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class Scores:
    """Scores of queries and vectors in memory that is used again; a new matrix each time costs more than its product."""

    def __init__(self):
        self.held: dict[np.dtype, np.ndarray] = {}

    def _matrix(self, shape: tuple[int, int], kind: np.dtype) -> np.ndarray:
        size = shape[0] * shape[1]
        if len(self.held.get(kind, ())) < size:
            self.held[kind] = np.empty(max(size, PACK * BLOCK), kind)
        return self.held[kind][:size].reshape(shape)

    def product(self, queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        return np.matmul(queries, vectors.T, out=self._matrix((len(queries), len(vectors)), np.dtype(queries.dtype)))

    def reaching(self, scores: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of the scores that are at least their query's."""
        least = least.astype(scores.dtype)[:, None]
        flat = np.flatnonzero(np.greater_equal(scores, least, out=self._matrix(scores.shape, np.dtype(bool))))
        return np.divmod(flat, max(scores.shape[1], 1))


class Block:
    """Rows of one cell: ids, labels and what the scorer makes of their vectors."""

    def __init__(self, place: int, ids: bytes, labels: bytes, vectors):
        self.place, self.vectors = place, vectors
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")


def met(visits: DataFrame, blocks: DataFrame, prepare: Callable[[bytes, int], object], meeting: Callable[[], Callable], names: list[str], schema: str) -> DataFrame:
    """What the visits find in the blocks of their tiles: columns of ``schema``.

    ``prepare`` turns a block's vectors (bytes, number of rows) into what is scored, once per block. ``meeting`` makes a task's
    function of a visit (its pack, places in the pack, table of bits by cell, payload) and a list of blocks.
    """
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meet, tile, held = meeting(), None, []
        found, size = [], 0
        for batch in batches:
            for row, (at, asks) in enumerate(zip(batch.column("tile").to_pylist(), batch.column("asks").to_pylist(), strict=True)):
                get = lambda c, row=row, batch=batch: batch.column(c)[row].as_py()
                if at != tile:
                    tile, held = at, []
                if not asks:
                    ids = get("ids")
                    held.append(Block(get("place"), ids, get("labels"), prepare(get("vectors"), len(ids) // 8)))
                    continue
                who = np.frombuffer(get("who"), "<i4")
                cells = np.frombuffer(get("cells"), np.uint8).reshape(len(who), -1)
                new = meet(get("pack"), who, np.unpackbits(cells, axis=1).astype(bool), {c: get(c) for c in names}, held)
                if len(new[0]):
                    found.append(new)
                    size += len(new[0])
                if size >= ROWS_OUT:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], columns)
                    found, size = [], 0
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], columns)

    both = blocks.withColumn("asks", F.lit(False)).unionByName(visits.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    dealt = both.repartition(partitions(both), "tile").sortWithinPartitions("tile", "asks")
    return arrow_map(dealt, run, schema)


def first_rows(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Per key the ``most`` rows of highest score, ties to the smaller id; Spark cuts before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def best_per_query(scores: np.ndarray, ids: np.ndarray, fits: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of each query's ``most`` best rows that fit, by score and then smaller id; ids ascend."""
    if scores.shape[1] > most:
        masked = np.where(fits, scores, np.iinfo(np.int64).min if scores.dtype.kind == "i" else -np.inf)
        cut = np.partition(masked, -most, axis=1)[:, -most]  # ties with the last one stay for now
        query, row = np.nonzero(fits & (masked >= cut[:, None]))
    else:
        query, row = np.nonzero(fits)
    order = np.lexsort((ids[row], -scores[query, row], query))
    query, row = query[order], row[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < most
    return query[keep], row[keep]


def leading(query: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of each query's ``most`` best of a list of pairs, by query, score and then smaller id, and their ranks from 0."""
    order = np.lexsort((ids, -score, query))
    rank = np.arange(len(order)) - np.searchsorted(query[order], query[order])
    return order[rank < most], rank[rank < most]
