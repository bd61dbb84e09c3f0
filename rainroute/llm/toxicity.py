"""Toxicity: a logistic classifier over words and stems, regularised by counterfactual texts.

Words that tell the labels apart are chosen from their document counts per class, over a
bounded sample of labelled rows. In every sampled text that mentions an identity
term, each such term is swapped for the next of its group; the squared change of the
logit enters the loss, so the model does not learn to raise the score for a neutral mention. The
loss is solved by Newton steps. Scoring looks at whole texts.

Defined cases: null and empty texts get the score of a text without any known word;
without labels of both kinds every score is the share of label 1 (0 without labels);
repeated rows get equal scores; further columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import words_of
from .labelled import fold, training_rows
from .tasks import arrow_map

TRAINING_ROWS = 20_000
WORDS = 512
STEMS = (5, 6, 8)  # bytes: a stem may take many endings
CLEAR = 4.0  # standard errors between the classes from which a word counts as telling
THRESHOLD = 0.3

#: Groups of identity terms that can stand for each other in a sentence (fixed values).
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("americans", "mexicans", "africans", "europeans", "chinese"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden", "atheisten"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs", "athées"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos", "ateos"),
)


def swaps(groups=IDENTITY_GROUPS) -> dict[bytes, bytes]:
    """Each term's stand-in: the next of its group."""
    return {g[i].encode(): g[(i + 1) % len(g)].encode() for g in groups for i in range(len(g))}


def features_of(body: bytes) -> set[bytes]:
    """Words of a text, beginnings of its longer words (``^``), and those that two different words have (``^^``)."""
    return _with_stems(set(words_of(body)))


def _with_stems(words: set[bytes]) -> set[bytes]:
    out = set(words)
    for size in STEMS:
        seen: set[bytes] = set()
        for word in words:
            if len(word) > size:
                stem = word[:size]
                out.add(b"^^" + stem if stem in seen else b"^" + stem)
                seen.add(stem)
    return out


def telling_words(rows: DataFrame, most: int = WORDS, least: int = 3, clear: float = CLEAR) -> list[bytes]:
    """Words whose share of documents differs most between the classes, by ``clear`` standard errors or more."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[bytes, list[int]] = {}
            for body, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
                for word in features_of(bytes(body.as_buffer())):
                    counts.setdefault(word, [0, 0])[label] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(counts), pa.binary()),
                    pa.array([c[0] for c in counts.values()], pa.int64()),
                    pa.array([c[1] for c in counts.values()], pa.int64()),
                ],
                ["word", "n0", "n1"],
            )

    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    a, b = sizes.get(0, 0), sizes.get(1, 0)
    counts = arrow_map(rows, seen, "word binary, n0 long, n1 long").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    share = (F.col("n0") + F.col("n1")) / (a + b)
    spread = F.sqrt(share * (1 - share) * (1 / a + 1 / b)) + 1e-9
    top = (
        counts.where(F.col("n0") + F.col("n1") >= least)
        .withColumn("z", F.abs(F.col("n1") / b - F.col("n0") / a) / spread)
        .where(F.col("z") >= clear)
        .orderBy(F.desc("z"), "word")
        .limit(most)
    )
    return [bytes(r.word) for r in top.select("word").collect()]


def features(rows: DataFrame, words: list[bytes], terms: dict[bytes, bytes]):
    """Word numbers of every sampled text, of its counterfactual (or nothing), and labels."""
    number = {w: i for i, w in enumerate(words)}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain, swapped = [], []
            for body in batch.column("text"):
                found = set(words_of(bytes(body.as_buffer())))
                plain.append(sorted(number[w] for w in _with_stems(found) if w in number))
                other = {terms.get(w, w) for w in found}  # words first, so that the stems are those of the swapped text
                swapped.append(sorted(number[w] for w in _with_stems(other) if w in number) if other != found else None)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(plain, kind), pa.array(swapped, kind), batch.column("label")], ["plain", "swapped", "label"]
            )

    return arrow_map(rows, find, "plain array<int>, swapped array<int>, label int").collect()


def dense(lists, width: int) -> np.ndarray:
    """One row of 0 and 1 per list, and a last column of 1."""
    out = np.zeros((len(lists), width + 1), dtype=np.float32)
    for i, row in enumerate(lists):
        out[i, row] = 1
    out[:, width] = 1
    return out


def fit(x: np.ndarray, y: np.ndarray, change: np.ndarray, ridge: float = 0.2, fairness: float = 10.0, steps: int = 12) -> np.ndarray:
    """Weights that minimise log loss + ridge |w|**2 / 2 + fairness / 2 * sum((change @ w)**2).

    ``change``: rows of a counterfactual text less the text. The last column of ``x`` is the intercept.
    """
    w = np.zeros(x.shape[1])
    damp = np.full(x.shape[1], ridge)
    damp[-1] = 1e-6
    extra = np.diag(damp) + fairness * (change.T.astype(np.float64) @ change)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + extra @ w
        curve = (x * (p * (1 - p))[:, None].astype(np.float32)).T @ x + extra
        step = np.linalg.solve(curve.astype(np.float64), slope)
        w -= step * min(1.0, 8.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-4:
            break
    return w


def train(rows: DataFrame, groups=IDENTITY_GROUPS, fairness: float = 10.0) -> tuple[dict[bytes, float], float]:
    """Weight of every known word, and the intercept."""
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        share = 1.0 if sizes.get(1) else 0.0
        return {}, math.inf if share else -math.inf
    terms = swaps(groups)
    words = list(dict.fromkeys([*telling_words(rows), *sorted(terms)]))
    found = features(rows, words, terms)
    x = dense([r.plain for r in found], len(words))
    pairs = [i for i, r in enumerate(found) if r.swapped is not None]
    change = dense([found[i].swapped for i in pairs], len(words)) - x[pairs]
    w = fit(x, np.array([r.label for r in found], dtype=np.float64), change, fairness=fairness)
    return dict(zip(words, w[:-1].tolist(), strict=True)), float(w[-1])


def score(docs: DataFrame, weights: dict[bytes, float], intercept: float, column: str = "text") -> DataFrame:
    """Every column of ``docs`` as struct ``doc``, and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast((weights, intercept))  # at most WORDS words and the terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base = shared.value
        for batch in batches:
            out = []
            for body in batch.column("z"):
                logit = base + sum(known[w] for w in sorted(known.keys() & features_of(bytes(body.as_buffer()))))
                out.append(1 / (1 + math.exp(-logit)) if logit > -500 else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(out, pa.float64())], ["doc", "score"])

    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.coalesce(F.col(column), F.lit("")).cast("binary").alias("z"))
    return arrow_map(rows, run, f"doc {rows.schema['doc'].dataType.simpleString()}, score double")


def train_on(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS):
    return train(training_rows(docs, labels, "toxic", 4, 2, most))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text of ``documents``; labels of the held-out fold are never read."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    weights, intercept = train_on(docs, labels)
    return score(docs, weights, intercept).select(
        F.col("doc.doc_id").alias("doc_id"),
        (fold(F.col("doc.doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
