"""Hard negatives by an inverted multi-index: rows of another label that score almost as high as a positive.

Vectors are cut into two halves, each with a codebook fitted on at most ``SAMPLE`` rows; a pair of codes is a cell.
Every row is in its cell, and a code's radius is the largest distance of any row's half to it. So a half's score is at
most q·c + |q|·radius, and the sum of both halves bounds the score of every row of a cell. Per query a heap visits the
cells by that sum, highest first (the multi-sequence order), and stops where the bound falls below what could still
change its window: for positives the score of the last one, for negatives the last one of each positive's window
(or the window's lower end while it is not full). What is left then cannot be in the result, so results are exact.

Queries visit in waves (``FIRST`` rows, ``STEP`` times as many, the rest); each wave starts from what the one before has
certified, and within a task every block from what the blocks before it have. The number of codes grows with the rows
(up to ``CODES`` a half), so that a cell has about ``PER_CELL`` rows.

Defined cases: rows without id, label or vector or with a null, non-finite or huge (|256 x| of 2**27 or more)
component take no part; shorter vectors count as filled up with zeros; rows alike in id, label and vector count once;
rows of the query's own id are never its results; a query without positives, or whose windows are empty, has no rows;
an empty table gives no rows; columns beside id, label and vector are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from . import vector_blocks as vb
from .tasks import arrow_map, small_batches

SAMPLE = 8192  # rows the codebooks are fitted on: those of the smallest hashes of the id
CODES = 256
PER_CELL = 512
FIRST = 2048  # rows a query meets in its first wave
STEP = 64  # times as many in its second; then whatever is left
TOGETHER = 1 << 21  # (query, cell) bounds that are compared at once
HUGE = float(1 << 27)


def fitted(points: np.ndarray, codes: int, rounds: int = 8) -> np.ndarray:
    """Centres by k-means; codes that lose all points go to the points farthest from their centre."""
    codes = max(1, min(codes, len(np.unique(points, axis=0)) if len(points) else 1))
    if not len(points):
        return np.zeros((1, points.shape[1]))
    centres = points[np.linspace(0, len(points) - 1, codes).astype(int)].astype(np.float64)
    for _ in range(rounds):
        code, far = nearest(points, centres)
        size = np.bincount(code, minlength=codes)
        sums = np.zeros_like(centres)
        np.add.at(sums, code, points)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        empty = np.flatnonzero(size == 0)
        centres[empty] = points[np.argsort(-far, kind="stable")[: len(empty)]]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's nearest centre and the distance to it."""
    score = points @ centres.T - 0.5 * (centres**2).sum(axis=1)
    code = score.argmax(axis=1)
    return code, np.sqrt(((points - centres[code]) ** 2).sum(axis=1))


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) of all pairs by falling sum of the two lists' values; -inf ends a list."""
    one, two = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    one, two = one[np.isfinite(first[one])].tolist(), two[np.isfinite(second[two])].tolist()
    if not one or not two:
        return
    heap = [(-(first[one[0]] + second[two[0]]), 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, one[i], two[j]
        if j + 1 < len(two):
            heapq.heappush(heap, (-(first[one[i]] + second[two[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(one):
            heapq.heappush(heap, (-(first[one[i + 1]] + second[two[0]]), i + 1, 0))


class Index:
    """Codebooks, radii and cell sizes of a table (at most ``CODES`` codes a half), and its written blocks."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        n, width, low, high = rows.agg(
            F.count("*"), F.max(F.size("vector")), F.min(F.array_min("vector")), F.max(F.array_max("vector"))
        ).first()
        self.n, self.width, self.half = n, width or 0, (width or 0) // 2
        self.kind = "<i2" if max(-(low or 0), high or 0) < 1 << 15 else "<i4"
        codes = min(CODES, max(1, round((n / PER_CELL) ** 0.5)))
        sample = rows.orderBy(F.xxhash64("id"), "id", "label", "vector").limit(SAMPLE).select("vector").toArrow()
        points = vb.matrix(sample.column("vector"), self.width)
        del sample
        self.books = [fitted(points[:, : self.half], codes), fitted(points[:, self.half :], codes)]
        self.stride = len(self.books[1])
        books, half, width = self.books, self.half, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = vb.matrix(batch.column("vector"), width)
                (c1, d1), (c2, d2) = nearest(points[:, :half], books[0]), nearest(points[:, half:], books[1])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array((c1 * len(books[1]) + c2).astype(np.int32)), pa.array(d1), pa.array(d2)],
                    [*batch.schema.names, "cell", "d1", "d2"],
                )

        self.placed = materialise(arrow_map(rows, run, "id long, label long, vector array<int>, cell int, d1 double, d2 double"), "cells")
        cells = self.placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).collect()
        self.counts = {r.cell: r.n for r in cells}
        self.radii = [np.full(len(b), -np.inf) for b in self.books]
        for r in cells:
            for k, d in ((0, r.d1), (1, r.d2)):
                code = (r.cell // self.stride, r.cell % self.stride)[k]
                self.radii[k][code] = max(self.radii[k][code], d)
        self.blocks = vb.blocks_of(self.placed, self.width, self.counts, self.kind)

    def waves(self) -> Iterator[tuple[int, int]]:
        """(low, high) numbers of rows met; the last one takes all that is left."""
        low, high = 0, FIRST
        while high < self.n and low < FIRST * STEP:
            yield low, high
            low, high = high, high * STEP
        yield low, max(high, self.n)

    def visitor(self, low: int, high: int):
        """Cells of a pack that are due after ``low`` and before ``high`` rows, while their bound reaches ``least``.

        Where ``high`` takes in all rows, cells after the first ``low`` rows are due in whatever order.
        """
        books, radii, half, width, stride, rest = self.books, self.radii, self.half, self.width, self.stride, high >= self.n
        cells = np.array(sorted(self.counts), dtype=np.int64)
        place = np.full(len(books[0]) * stride, -1, dtype=np.int64)
        place[cells] = np.arange(len(cells))
        rows = [self.counts[c] for c in cells.tolist()]

        def wanted(pack: pa.Table) -> np.ndarray:
            q = vb.matrix(pack.column("vector"), width)
            least = np.asarray(pack.column("least"), dtype=np.float64)
            bounds, size = [], np.zeros(len(q))
            for side, book, radius in ((q[:, :half], books[0], radii[0]), (q[:, half:], books[1], radii[1])):
                length = np.sqrt((side**2).sum(axis=1))[:, None]
                reach = length * np.where(np.isfinite(radius), radius, 0)[None, :]
                size = size + (reach + length * np.sqrt((book**2).sum(axis=1))[None, :]).max(axis=1)
                bounds.append(np.where(np.isfinite(radius)[None, :], side @ book.T + reach, -np.inf))
            slack = 1 + 1e-9 * size  # for rounding; scores are whole numbers
            due = np.zeros((len(q), len(cells)), dtype=bool)
            if rest:
                several = max(1, TOGETHER // max(1, len(cells)))
                for i in range(0, len(q), several):
                    sums = bounds[0][i : i + several, cells // stride] + bounds[1][i : i + several, cells % stride]
                    due[i : i + several] = sums + slack[i : i + several, None] >= least[i : i + several, None]
            for i in range(len(q) if low or not rest else 0):
                met = 0
                for bound, a, b in multi_sequence(bounds[0][i], bounds[1][i]):
                    if met >= (low if rest else high) or not rest and bound + slack[i] < least[i]:
                        break
                    at = place[a * stride + b]
                    if at >= 0:
                        due[i, at] = not rest and met >= low
                        met += rows[at]
            return due

        return wanted


def fitting(queries: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers as floating point that gives their inner products exactly, or as integers."""
    most = float(np.abs(queries.astype(np.int64)).max(initial=0)) * float(np.abs(vectors.astype(np.int64)).max(initial=0)) * max(queries.shape[1], 1)
    kind = np.float32 if most < 2.0**24 else np.float64 if most < 2.0**53 else np.int64
    return queries.astype(kind), vectors.astype(kind)


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers."""
    q, v = fitting(queries, vectors)
    return (q @ v.T).astype(np.int64)


def _payload(width: int, extra: list[str], kind: str = "<i4"):
    def payload(pack: pa.Table, who: np.ndarray) -> dict[str, bytes]:
        chosen = pack.take(pa.array(who))
        out = {c: np.asarray(chosen.column(c)).astype("<i8").tobytes() for c in ("key", "own", "group")}
        out["q"] = vb.matrix(chosen.column("vector"), width).astype(kind).tobytes()
        for c in extra:
            out[c] = np.asarray(chosen.column(c), dtype="<f8").tobytes() if c == "least" else vb.matrix(chosen.column(c), WINDOWS, np.int64).astype("<i8").tobytes()
        return out

    return payload


WINDOWS = 5  # positives of a query
NAMES = ["key", "own", "group", "q"]
LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _prepared(width: int, kind: str):
    return lambda vectors, rows: np.frombuffer(vectors, kind).reshape(rows, width)


def _meeting(width: int, kind: str, most: int, slots: int):
    """The scorer of a task: best rows of the query's label (one slot), or of other labels in its windows.

    Per query and slot it keeps the score that ``most`` rows have reached; rows below it cannot be in the result.
    """
    same, places = slots == 1, vb.PACK

    def meeting():
        reached: dict[int, np.ndarray] = {}
        scorer = vb.Scores()

        def meet(pack: int, who: np.ndarray, cells: np.ndarray, value: dict, blocks: list) -> list[np.ndarray]:
            key, own, group = (np.frombuffer(value[c], "<i8") for c in ("key", "own", "group"))
            q = np.frombuffer(value["q"], kind).reshape(len(key), width)
            if same:
                least = np.frombuffer(value["least"], "<f8")
                low = np.array([int(x) if x > -np.inf else LOW for x in least.tolist()], dtype=np.int64)[:, None]
                high = np.full((len(key), 1), HIGH)
            else:
                low, high = (np.frombuffer(value[c], "<i8").reshape(-1, slots) for c in ("low", "high"))
            known = reached.setdefault(pack, np.full((places, slots), LOW))
            low = np.maximum(known[who], low)
            parts: list[list] = [[] for _ in range(slots)]
            for block in blocks:
                asked, labels = np.flatnonzero(cells[:, block.place]), block.labels
                rows = np.flatnonzero(np.isin(labels, group[asked])) if same else np.arange(len(labels))
                if not len(asked) or not len(rows):
                    continue
                scores = scorer.product(*fitting(q[asked], block.vectors[rows]))
                least = np.where(low <= high, low, HIGH).min(axis=1)[asked]
                query, row = scorer.reaching(scores, least)
                score = scores[query, row].astype(np.int64)
                query, row = asked[query], rows[row]
                ids = block.ids[row]
                fits = ((labels[row] == group[query]) == same) & (ids != own[query])
                query, score, ids = query[fits], score[fits], ids[fits]
                for slot in range(slots):
                    inside = (score >= low[query, slot]) & (score <= high[query, slot])
                    at, s, i = query[inside], score[inside], ids[inside]
                    best, rank = vb.leading(at, s, i, most)
                    parts[slot].append((at[best], s[best], i[best]))
                    last = best[rank == most - 1]
                    low[at[last], slot] = s[last]
            known[who] = low
            out = []
            for slot, part in enumerate(parts):
                if part:
                    at, s, i = (np.concatenate(x) for x in zip(*part, strict=True))
                    best, _ = vb.leading(at, s, i, most)
                    out.append((key[at[best]], np.full(len(best), slot, np.int32), i[best], s[best]))
            found = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 4
            return [found[0], *found[2:]] if same else found

        return meet

    return meeting


def positives(index: Index, queries: DataFrame, most: int = WINDOWS) -> DataFrame:
    """(key, rank, id, score): the ``most`` best rows of the query's label, certified."""
    width, kind, names = index.width, index.kind, [*NAMES, "least"]
    found = None
    for low, high in index.waves():
        known = queries.withColumn("least", F.lit(float("-inf")))
        if found is not None:
            last = found.groupBy("key").agg(F.count("*").alias("n"), F.min("score").alias("low")).where(F.col("n") == most)
            known = queries.join(last, "key", "left").withColumn("least", F.coalesce(F.col("low").cast("double"), F.lit(float("-inf")))).drop("n", "low")
        visits = vb.visits_of(known, ["group", "cell", "key"], index.visitor(low, high), index.counts, _payload(width, ["least"], kind), names)
        new = vb.met(visits, index.blocks, _prepared(width, kind), _meeting(width, kind, most, 1), names, "key long, id long, score long")
        both = new if found is None else new.unionByName(found.select("key", "id", "score"))
        found = materialise(vb.first_rows(both, ["key"], most), "positives")
    return found


def negatives(index: Index, queries: DataFrame, most: int = 3) -> DataFrame:
    """(key, slot, rank, id, score): per window of a query its best rows of other labels, certified.

    ``queries`` has arrays ``low`` and ``high``, the ends of its windows; a window with low > high takes nothing.
    """
    width, kind, names = index.width, index.kind, [*NAMES, "low", "high"]
    found = None
    for low, high in index.waves():
        if found is not None:  # a full window is only changed from its last row's score on
            full = found.groupBy("key", "slot").agg(F.count("*").alias("n"), F.min("score").alias("last")).where(F.col("n") == most)
            full = full.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("slot", "last"))).alias("lasts"))
            known = queries.join(full, "key", "left")
            raised = F.transform("low", lambda x, i: F.coalesce(F.try_element_at("lasts", i.cast("int")), x))
            known = known.withColumn("low", raised).drop("lasts")
        else:
            known = queries
        open_ends = F.filter(F.arrays_zip("low", "high"), lambda w: w["low"] <= w["high"])
        known = known.withColumn("least", F.array_min(F.transform(open_ends, lambda w: w["low"].cast("double")))).where(F.col("least").isNotNull())
        visits = vb.visits_of(known, ["group", "cell", "key"], index.visitor(low, high), index.counts, _payload(width, ["low", "high"], kind), names)
        new = vb.met(visits, index.blocks, _prepared(width, kind), _meeting(width, kind, most, WINDOWS), names, "key long, slot int, id long, score long")
        both = new if found is None else new.unionByName(found.select("key", "slot", "id", "score"))
        found = materialise(vb.first_rows(both, ["key", "slot"], most), "negatives")
    return found


def hard_negatives(rows: DataFrame, anchors, most: int = 3) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: id long, label long, vector array<int>; ``anchors``: a condition on them. A negative scores from half to
    95 hundredths of the positive's score.
    """
    spark = rows.sparkSession
    small_batches(spark)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    index = Index(materialise(rows.distinct(), "vectors"))
    if not index.n:
        return spark.createDataFrame([], out)
    queries = index.placed.where(anchors).select(F.col("id").alias("own"), F.col("label").alias("group"), "vector", "cell")
    queries = materialise(queries.withColumn("key", F.monotonically_increasing_id()), "anchors")
    best = positives(index, queries)
    # 50 p <= 100 n <= 95 p in whole numbers. An unused slot is an empty window.
    low, high = F.expr("-((-score - pmod(-score, 2L)) div 2L)"), F.expr("(95L * score - pmod(95L * score, 100L)) div 100L")
    ends = F.struct((F.col("rank") - 1).alias("slot"), low.alias("low"), high.alias("high"))
    windows = best.groupBy("key").agg(F.sort_array(F.collect_list(ends)).alias("w"))
    fill = lambda c, none: F.expr(f"transform(sequence(0, {WINDOWS - 1}), i -> coalesce(get(w, i).{c}, {none}L))")
    known = queries.join(windows, "key").select("key", "own", "group", "vector", "cell", fill("low", 1).alias("low"), fill("high", 0).alias("high"))
    worst = negatives(index, materialise(known, "windows"), most)
    return (
        worst.alias("n").join(best.alias("p"), (F.col("n.key") == F.col("p.key")) & (F.col("n.slot") == F.col("p.rank") - 1))
        .join(queries.select("key", "own").alias("a"), F.col("a.key") == F.col("n.key"))
        .select(
            F.col("a.own").alias("anchor_id"), F.col("p.id").alias("positive_id"), F.col("n.rank").alias("rank"),
            F.col("n.id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score"),
        )
    )


def whole_numbers(rows: DataFrame) -> DataFrame:
    """(id, label, vector): components as floor(256 x), labels of every seventh id moved on by one."""
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vb.finite("embedding")
    small = F.forall(F.col("embedding").cast("array<double>"), lambda x: F.abs(x) < HUGE / 256)
    label = F.col("label").cast("long")
    return (
        rows.where(usable).where(small)
        .select(
            F.col("vec_id").cast("long").alias("id"),
            F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
            F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("int")).alias("vector"),
        )
    )


def op11_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth row of ``embeddings`` against all rows."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    return hard_negatives(whole_numbers(rows), F.col("id") % 50 == 0)
