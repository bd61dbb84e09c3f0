"""Quality classifier: attention-based multiple-instance learning over passages.

A text is a bag of passages of ``PASSAGE`` bytes. A passage is encoded from the shares
of character kinds and word shapes in it; gated attention weighs the encodings, and the
weighted sum is scored. Only documents have labels; which passages matter is learnt.
The network (two dense layers, a few hundred weights) is trained on a bounded sample of
labelled rows; scoring reads every passage of every text.

Defined cases: a null or empty text is one empty passage; without labels of both kinds
every score is the share of label 1 (0 without labels); repeated rows get equal scores;
further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text
from .labelled import fold, training_rows
from .tasks import arrow_map

TRAINING_ROWS = 12_000
PASSAGE = 512  # bytes
THRESHOLD = 0.5

_KINDS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b" ",
    b"\n",
    b"|",
    b"!",
    b"?",
    b".",
    b",",
    b"&%#$*@~^+=",
    b"<>/\\{}[]",
    b"()'\"-:;_`",
    bytes(range(0x80, 0xC0)),
    bytes(range(0xC0, 0x100)),
)
_KIND = np.full(256, len(_KINDS), dtype=np.uint8)
for _number, _members in enumerate(_KINDS):
    _KIND[list(_members)] = _number
FEATURES = len(_KINDS) + 1 + 6


def passages(data: np.ndarray, offsets: np.ndarray, width: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and how many each row has (one at least)."""
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-sizes // width))
    row = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[row] - offsets[0] + number * width
    stop = np.minimum(start + width, offsets[row + 1] - offsets[0])
    out = np.zeros((len(row), FEATURES))
    n = np.maximum(1, stop - start)
    body = data[offsets[0] : offsets[-1]]
    if len(body):
        owner = np.repeat(np.arange(len(row)), stop - start)
        kinds = len(_KINDS) + 1
        shares = np.bincount(owner * kinds + _KIND[body], minlength=len(row) * kinds).reshape(len(row), kinds)
        out[:, :kinds] = np.sqrt(shares / n[:, None])
        at, end = text.word_bounds(body, offsets - offsets[0], text.SPACE)
        if len(at):
            passage = owner[at]
            words = np.maximum(1, np.bincount(passage, minlength=len(row)))
            hashes = text.word_hashes(text.LOWER[body], at, end)
            again = np.zeros(len(at))
            again[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
            order = np.lexsort((hashes, passage))
            same = np.zeros(len(at))
            same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (passage[order][1:] == passage[order][:-1])
            length = (end - at).astype(float)
            upper = (_KIND[body[at]] == 0).astype(float)
            for column, values in enumerate((again, length / 8, upper, np.minimum(length, 40) ** 2 / 64)):
                out[:, kinds + column] = np.bincount(passage, weights=values, minlength=len(row)) / words
            out[:, kinds + 4] = np.bincount(passage[order], weights=same, minlength=len(row)) / words
    out[:, -1] = np.log1p(sizes)[row] / 8
    return out, counts


class Network:
    """tanh encoder, gated attention, one logit; arrays by name."""

    def __init__(self, features: int = FEATURES, hidden: int = 16, gate: int = 8, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(features), np.ones(features)
        self.w = {
            "encode": rng.normal(0, 0.3, (features, hidden)),
            "encode0": np.zeros(hidden),
            "v": rng.normal(0, 0.3, (hidden, gate)),
            "u": rng.normal(0, 0.3, (hidden, gate)),
            "attend": rng.normal(0, 0.3, gate),
            "out": rng.normal(0, 0.3, hidden),
            "out0": np.zeros(1),
        }

    def forward(self, x: np.ndarray, counts: np.ndarray):
        """Logit per bag, and what the gradient needs."""
        w = self.w
        first = np.cumsum(counts) - counts
        h = np.tanh((x - self.mean) / self.scale @ w["encode"] + w["encode0"])
        t, g = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        e = (t * g) @ w["attend"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), counts))
        a = e / np.repeat(np.add.reduceat(e, first), counts)
        z = np.add.reduceat(a[:, None] * h, first)
        return z @ w["out"] + w["out0"][0], (h, t, g, a, z, first)

    def gradient(self, x, counts, y):
        logit, (h, t, g, a, z, first) = self.forward(x, counts)
        w = self.w
        d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)
        dz = d[:, None] * w["out"]
        wide = np.repeat(dz, counts, axis=0)
        da = (wide * h).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, first), counts))
        dt, dg = de[:, None] * w["attend"] * g * (1 - t * t), de[:, None] * w["attend"] * t * g * (1 - g)
        dh = (a[:, None] * wide + dt @ w["v"].T + dg @ w["u"].T) * (1 - h * h)
        xs = (x - self.mean) / self.scale
        return {
            "encode": xs.T @ dh,
            "encode0": dh.sum(0),
            "v": h.T @ dt,
            "u": h.T @ dg,
            "attend": (t * g).T @ de,
            "out": z.T @ d,
            "out0": np.array([d.sum()]),
        }

    def fit(self, x, counts, y, rounds: int = 12, bags: int = 256, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> None:
        """Adam over shuffled batches of bags."""
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        rng = np.random.default_rng(seed)
        first = np.cumsum(counts) - counts
        m, v, step = {k: 0.0 for k in self.w}, {k: 0.0 for k in self.w}, 0
        for turn in range(rounds):
            order = rng.permutation(len(counts))
            for at in range(0, len(order), bags):
                mine = order[at : at + bags]
                n = counts[mine]
                rows = np.arange(n.sum()) + np.repeat(first[mine] - (np.cumsum(n) - n), n)
                step += 1
                for k, d in self.gradient(x[rows], n, y[mine]).items():
                    d = d + decay * self.w[k]
                    m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.999 * v[k] + 0.001 * d * d
                    pace = rate * 0.5 * (1 + np.cos(np.pi * turn / rounds))
                    self.w[k] = self.w[k] - pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)


def bags_of(rows: DataFrame):
    """Passage features, passage counts and labels of the bounded training rows."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text.buffers(batch.column("text"))
            for a, b in text.runs(offsets):
                x, counts = passages(data, offsets[a : b + 1])
                ends = np.cumsum(counts) * x.shape[1] * 4
                raw = x.astype("<f4").tobytes()
                parts = [raw[i:j] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary()), batch.column("label").slice(a, b - a)], ["x", "label"])

    found = arrow_map(rows, encode, "x binary, label int").collect()
    x = np.concatenate([np.frombuffer(r.x, "<f4").reshape(-1, FEATURES) for r in found]).astype(np.float64)
    return x, np.array([len(r.x) // (4 * FEATURES) for r in found]), np.array([r.label for r in found], dtype=np.float64)


def train(rows: DataFrame) -> Network | float:
    """A network, or the constant score if there are not two kinds of labels."""
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return 1.0 if sizes.get(1) else 0.0
    network = Network()
    network.fit(*bags_of(rows))
    return network


def score(docs: DataFrame, model: Network | float, column: str = "text") -> DataFrame:
    """Every column of ``docs`` as struct ``doc``, and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            data, offsets = text.buffers(batch.column("body"))
            for a, b in text.runs(offsets):
                if isinstance(known, float):
                    out = np.full(b - a, known)
                else:
                    logit, _ = known.forward(*passages(data, offsets[a : b + 1]))
                    out = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(a, b - a), pa.array(out)], ["doc", "score"])

    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(column).alias("body"))
    return arrow_map(rows, run, f"doc {rows.schema['doc'].dataType.simpleString()}, score double")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text of ``documents``; labels of the held-out fold are never read."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = train(training_rows(docs, labels, "quality", 3, 1, TRAINING_ROWS))
    return score(docs.select("doc_id", "text"), model).select(
        F.col("doc.doc_id").alias("doc_id"),
        (fold(F.col("doc.doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
