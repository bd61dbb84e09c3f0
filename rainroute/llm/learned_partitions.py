"""Approximate nearest neighbours by learned partitions.

A sample of at most ``SAMPLE`` rows (those of the smallest hashes of the id) is fitted: its graph of nearest neighbours
is cut into partitions of equal size with few edges between them, and a softmax classifier learns in which
partitions a vector's neighbours lie. Every row of the table then goes to its most probable partition, and a query goes
to its most probable ones, whose rows are all scored exactly.

How many partitions a query visits is measured, not set: on sample rows held out from the fit, the fewest whose
rows hold ``TARGET`` of the true neighbours within the sample. Neighbours in a sample are farther apart than in the whole
table, which makes this a cautious number; ``recall`` measures what a search finds against all rows.

Defined cases: rows without id or vector, or with a zero vector or a null or non-finite component, take no part;
shorter vectors count as filled up with zeros; rows alike in id and vector count once; rows of the query's own id are never its
results; a query goes on to further partitions until those visited hold ``LEAST`` rows, so small tables give all
candidates; an empty table gives no rows; columns beside id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from . import vector_blocks as vb
from .tasks import arrow_map, release, small_batches

SAMPLE = 8192
ROWS = 1024  # rows of a partition, from which their number follows
PARTITIONS = 256  # at most
NEIGHBOURS = 10  # edges of a row in the graph
TARGET = 0.95
LEAST = 64
AT_ONCE = 128  # sample rows scored against all others at a time; the driver holds these scores
PICKED = 200_000  # pairs that wait for their cosine at most, or one block's
PAIRS = 8192  # cosines that are computed at once
HELD_OUT = 4  # every fourth sample row is kept from the fit


def unit(points: np.ndarray) -> np.ndarray:
    """Rows of length 1; a power of two first takes out the size, so no square over- or underflows."""
    most = np.abs(points).max(axis=1, initial=0)
    points = np.ldexp(points, -np.frexp(most)[1][:, None])
    length = np.sqrt((points**2).sum(axis=1))
    return points / np.where(length > 0, length, 1)[:, None]


def nearest_rows(queries: np.ndarray, points: np.ndarray, most: int, own: np.ndarray | None = None) -> np.ndarray:
    """(queries, most) places of the nearest points by inner product; ``own``: each query's place, left out."""
    out = np.empty((len(queries), most), dtype=np.int64)
    for i in range(0, len(queries), AT_ONCE):
        scores = queries[i : i + AT_ONCE] @ points.T
        if own is not None:
            scores[np.arange(len(scores)), own[i : i + AT_ONCE]] = -np.inf
        out[i : i + AT_ONCE] = np.argpartition(np.negative(scores, out=scores), most - 1, axis=1)[:, :most]
    return out


def balanced_cut(points: np.ndarray, edges: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Partition of each row: equal sizes (up to one), rows moved to where most of their neighbours are.

    It starts from halving along the direction of largest spread, again and again. In each round rows ask for the
    partition that holds most of their neighbours, those who gain most first, and get the first with room.
    """
    n = len(points)
    part = np.zeros(n, dtype=np.int64)
    pieces = [(np.arange(n), 0, parts)]
    rng = np.random.default_rng(7)
    while pieces:
        rows, first, count = pieces.pop()
        if count == 1:
            part[rows] = first
            continue
        centred = points[rows] - points[rows].mean(axis=0) if len(rows) else points[rows]
        direction = rng.normal(size=points.shape[1])
        for _ in range(5):
            direction = centred.T @ (centred @ direction)
            direction /= max(np.linalg.norm(direction), 1e-300)
        order = rows[np.argsort(centred @ direction, kind="stable")]
        left = count // 2
        cut = len(rows) * left // count
        pieces += [(order[:cut], first, left), (order[cut:], first + left, count - left)]
    room = -(-n // parts)
    both = np.concatenate([np.stack([np.repeat(np.arange(n), edges.shape[1]), edges.ravel()]), np.stack([edges.ravel(), np.repeat(np.arange(n), edges.shape[1])])], axis=1)
    for _ in range(rounds):
        affinity = np.zeros((n, parts))
        np.add.at(affinity, (both[0], part[both[1]]), 1.0)
        affinity[np.arange(n), part] += 0.5  # a row stays where it is as well off
        choice = np.argsort(-affinity, axis=1, kind="stable")[:, : min(parts, 8)]
        ranked = np.take_along_axis(affinity, choice, axis=1)
        gain = ranked[:, 0] - (ranked[:, 1] if ranked.shape[1] > 1 else 0)
        new, held = np.full(n, -1), np.zeros(parts, dtype=np.int64)
        waiting = np.argsort(-gain, kind="stable")
        for k in range(choice.shape[1]):
            if not len(waiting):
                break
            asked = choice[waiting, k]
            order = np.argsort(asked, kind="stable")
            place = np.empty(len(waiting), dtype=np.int64)
            place[order] = np.arange(len(waiting)) - np.searchsorted(asked[order], asked[order])
            gets = place < (room - held)[asked]
            new[waiting[gets]] = asked[gets]
            held += np.bincount(asked[gets], minlength=parts)
            waiting = waiting[~gets]
        if len(waiting):
            new[waiting] = np.repeat(np.arange(parts), np.maximum(room - held, 0))[: len(waiting)]
        if (new == part).all():
            break
        part = new
    return part


class Classifier:
    """Softmax over linear scores of a unit vector."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def scores(self, points: np.ndarray) -> np.ndarray:
        return points @ self.weights[:-1] + self.weights[-1]

    @staticmethod
    def fit(points: np.ndarray, target: np.ndarray, steps: int = 200, rate: float = 0.5, penalty: float = 1e-4) -> Classifier:
        """Cross-entropy against the share of each row's neighbours in every partition, by Adam over all rows."""
        x = np.hstack([points, np.ones((len(points), 1))])
        w = np.zeros((x.shape[1], target.shape[1]))
        m, v = np.zeros_like(w), np.zeros_like(w)
        for step in range(1, steps + 1):
            p = x @ w
            p -= p.max(axis=1, keepdims=True)
            np.exp(p, out=p)
            p /= p.sum(axis=1, keepdims=True)
            p -= target
            g = x.T @ p / len(x) + penalty * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return Classifier(w)


def learned(sample: np.ndarray, parts: int, most: int) -> tuple[Classifier, int]:
    """A classifier fitted on unit vectors, and how many partitions hold ``TARGET`` of held-out rows' neighbours."""
    n = len(sample)
    if n <= max(parts, HELD_OUT * 2) or parts == 1:
        return Classifier(np.zeros((sample.shape[1] + 1, 1))), 1
    k = min(NEIGHBOURS, n - 1)
    held_out = np.arange(n) % HELD_OUT == HELD_OUT - 1
    fit = np.flatnonzero(~held_out)
    inside = nearest_rows(sample[fit], sample[fit], min(k, len(fit) - 1), np.arange(len(fit)))
    part = balanced_cut(sample[fit], inside, parts)
    target = np.zeros((len(fit), parts))
    np.add.at(target, (np.repeat(np.arange(len(fit)), inside.shape[1]), part[inside].ravel()), 1.0)
    target[np.arange(len(fit)), part] += 1.0
    target /= target.sum(axis=1, keepdims=True)
    model = Classifier.fit(sample[fit], target)
    home = model.scores(sample).argmax(axis=1)
    asked = np.flatnonzero(held_out)
    rank = np.empty((len(asked), parts), dtype=np.int64)
    np.put_along_axis(rank, np.argsort(-model.scores(sample[asked]), axis=1, kind="stable"), np.arange(parts)[None, :], axis=1)
    true = nearest_rows(sample[asked], sample, min(most, n - 1), asked)
    needed = np.take_along_axis(rank, home[true], axis=1).ravel()
    return model, int(np.quantile(needed, TARGET, method="higher")) + 1


class Index:
    """The classifier, the partitions' sizes (at most ``PARTITIONS``) and the written blocks of (id, vector) rows."""

    def __init__(self, rows: DataFrame, most: int):
        longer = F.exists("vector", lambda x: x.cast("float").cast("double") != x)  # than 32 bits hold
        n, width, longer = rows.agg(F.count("*"), F.max(F.size("vector")), F.max(longer)).first()
        self.n, self.width, self.kind = n, width or 0, "<f8" if longer else "<f4"
        self.parts = max(1, min(PARTITIONS, round(n / ROWS)))
        sample = rows.orderBy(F.xxhash64("id"), "id", "vector").limit(SAMPLE).select("vector").toArrow()
        points = unit(vb.matrix(sample.column("vector"), self.width))
        del sample
        self.model, self.visits = learned(points, self.parts, most)
        del points
        release()  # the driver keeps running for long after the fit
        weights, width = self.model.weights, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = Classifier(weights)
            for batch in batches:
                home = model.scores(unit(vb.matrix(batch.column("vector"), width))).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int32))], [*batch.schema.names, "cell"])

        self.placed = materialise(arrow_map(rows, run, "id long, vector array<double>, cell int"), "partitions")
        self.counts = {r.cell: r["count"] for r in self.placed.groupBy("cell").count().collect()}
        self.blocks = vb.blocks_of(self.placed.withColumn("label", F.lit(0).cast("long")), self.width, self.counts, self.kind)


def cosines(queries: np.ndarray, vectors: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Cosine of each pair (query, row), row by row, so that equal vectors get equal values wherever they stand."""
    def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])  # exact, and no square overflows
        return x, np.sqrt((x * x).sum(axis=1))

    (q, a), (v, b) = scaled(queries), scaled(vectors)
    return (q[pairs[0]] * v[pairs[1]]).sum(axis=1) / (a[pairs[0]] * b[pairs[1]])


class Nearest:
    """The best rows of some queries among blocks: products of 32 bits pick, the cosine of each pair decides.

    ``reached``: per query a product that ``most`` of its rows have; it rises from block to block and is kept by the caller.
    """

    def __init__(self, queries: np.ndarray, own: np.ndarray, reached: np.ndarray, most: int, scorer: vb.Scores):
        self.queries, self.own, self.reached, self.most, self.scorer = queries, own, reached, most, scorer
        self.units = unit(queries.astype(np.float64)).astype(np.float32)
        # Twice more than the rounding of a product of unit vectors: rows below by this cannot come out ahead.
        self.off = 2.0**-21 * (queries.shape[1] + 4)
        self.picked: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0
        self.best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))

    def meet(self, asked: np.ndarray, points: np.ndarray, units: np.ndarray, ids: np.ndarray) -> None:
        rough = self.scorer.product(self.units[asked], units)
        fresh = np.flatnonzero(np.isneginf(self.reached[asked]))
        if len(fresh) and len(ids) > self.most:
            others = np.where(ids[None, :] != self.own[asked[fresh], None], rough[fresh], -np.inf)
            self.reached[asked[fresh]] = np.partition(others, -self.most, axis=1)[:, -self.most]
        who, row = self.scorer.reaching(rough, self.reached[asked] - self.off)
        score, who = rough[who, row], asked[who]
        fits = ids[row] != self.own[who]
        who, row, score = who[fits], row[fits], score[fits]
        best, rank = vb.leading(who, score, ids[row], self.most)
        last = best[rank == self.most - 1]
        self.reached[who[last]] = np.maximum(self.reached[who[last]], score[last])
        self.picked.append((who, ids[row], score, row, points))
        self.size += len(who)
        if self.size > PICKED:
            self.decide()

    def decide(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, cosine) of each query's best so far."""
        parts = [self.best]
        for who, ids, score, row, points in self.picked:
            still = score >= self.reached[who] - self.off
            who, ids, row = who[still], ids[still], row[still]
            for i in range(0, len(who), PAIRS):
                q, v = self.queries[who[i : i + PAIRS]].astype(np.float64), points[row[i : i + PAIRS]].astype(np.float64)
                pairs = np.arange(len(q))
                parts.append((who[i : i + PAIRS], ids[i : i + PAIRS], cosines(q, v, (pairs, pairs))))
        who, ids, cosine = (np.concatenate(x) for x in zip(*parts, strict=True))
        best, _ = vb.leading(who, cosine, ids, self.most)
        self.best = who[best], ids[best], cosine[best]
        self.picked, self.size = [], 0
        return self.best


NAMES = ["key", "own", "q"]


def search(index: Index, queries: DataFrame, most: int, visits: int | None = None) -> DataFrame:
    """(key, rank, id, score) of the ``most`` nearest rows in the ``visits`` most probable partitions (all, if so many)."""
    weights, width, counts, kind, places = index.model.weights, index.width, index.counts, index.kind, vb.PACK
    wanted_parts = index.visits if visits is None else visits
    place = {cell: i for i, cell in enumerate(sorted(counts))}

    def wanted(pack: pa.Table) -> np.ndarray:
        scores = Classifier(weights).scores(unit(vb.matrix(pack.column("vector"), width)))
        going = np.zeros((len(scores), len(place)), dtype=bool)
        for i, cells in enumerate(np.argsort(-scores, axis=1, kind="stable").tolist()):
            rows = 0
            for k, cell in enumerate(cells):
                if k >= wanted_parts and rows >= LEAST:
                    break
                if cell in counts:
                    going[i, place[cell]] = True
                    rows += counts[cell]
        return going

    def payload(pack: pa.Table, who: np.ndarray) -> dict[str, bytes]:
        chosen = pack.take(pa.array(who))
        out = {c: np.asarray(chosen.column(c)).astype("<i8").tobytes() for c in ("key", "own")}
        return {**out, "q": vb.matrix(chosen.column("vector"), width).astype(kind).tobytes()}

    def prepare(vectors: bytes, rows: int) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer(vectors, kind).reshape(rows, width)
        return points, unit(points.astype(np.float64)).astype(np.float32)

    def meeting():
        reached: dict[int, np.ndarray] = {}  # by pack, over all tiles of the task
        scorer = vb.Scores()

        def meet(pack: int, who: np.ndarray, cells: np.ndarray, value: dict, blocks: list) -> list[np.ndarray]:
            key, own = (np.frombuffer(value[c], "<i8") for c in ("key", "own"))
            q = np.frombuffer(value["q"], kind).reshape(len(key), width)
            known = reached.setdefault(pack, np.full(places, -np.inf))
            nearest = Nearest(q, own, known[who], most, scorer)
            for block in blocks:
                asked = np.flatnonzero(cells[:, block.place])
                if len(asked):
                    nearest.meet(asked, *block.vectors, block.ids)
            known[who] = nearest.reached
            at, ids, cosine = nearest.decide()
            return [key[at], ids, cosine]

        return meet

    visits = vb.visits_of(queries, ["cell", "key"], wanted, counts, payload, NAMES)
    return vb.first_rows(vb.met(visits, index.blocks, prepare, meeting, NAMES, "key long, id long, score double"), ["key"], most)


def usable(rows: DataFrame) -> DataFrame:
    """(id, vector): each usable row of (vec_id, embedding) once."""
    some = F.exists("vector", lambda x: x != 0)
    return (
        rows.where(F.col("vec_id").isNotNull() & vb.finite("embedding"))
        .select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
        .where(some).distinct()
    )


def nearest_neighbours(rows: DataFrame, queries, most: int = 5, visits: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the rows found nearest to those of (id, vector) ``rows`` that ``queries`` picks."""
    small_batches(rows.sparkSession)
    index = Index(materialise(rows, "vectors"), most)
    if not index.n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = index.placed.where(queries).select(F.col("id").alias("own"), "vector", "cell")
    asked = materialise(asked.withColumn("key", F.monotonically_increasing_id()), "queries")
    found = search(index, asked, most, visits)
    return found.join(asked.select("key", "own"), "key").select(
        F.col("own").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"
    )


def recall(rows: DataFrame, queries, most: int = 5, visits: int | None = None) -> float:
    """Share of the true neighbours of the picked rows that the search finds; the truth visits every partition."""
    keys = ["query_id", "vec_id"]
    found = nearest_neighbours(rows, queries, most, visits).select(*keys)
    true = nearest_neighbours(rows, queries, most, PARTITIONS).select(*keys)
    total = true.count()
    return true.join(found, keys, "left_semi").count() / total if total else 1.0


def op12_approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows found for every fiftieth row of ``embeddings``, searched among all rows."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest_neighbours(usable(rows), F.col("id") % 50 == 0)
