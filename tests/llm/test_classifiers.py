import random
import zlib

import numpy as np
import pytest
from helpers import documents

from rainroute.llm import quality, toxicity
from rainroute.llm.labelled import fold, training_rows

POOL = [f"wort{i}" for i in range(400)]


def toxic_rows(seed, number):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(number):
        bad = i % 4 == 0
        words = [rng.choice(POOL) for _ in range(30)] + ([rng.choice(["scum", "moron", "idiot"])] if bad else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_folds(spark):
    rows = documents(spark, [(i, "") for i in [*range(50), None]])
    got = {r.doc_id: r.f for r in rows.select("doc_id", fold(rows.doc_id, 4).alias("f")).collect()}
    assert got == {None: 0, **{i: zlib.crc32(str(i).encode()) % 4 for i in range(50)}}


def test_training_rows_are_bounded_and_never_held_out(spark):
    rows, labels = toxic_rows(1, 80)
    labels = [*labels, (1, None), (None, 1), (2, 1)]
    docs, table = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = training_rows(docs, table, "toxic", 4, 2, 1000).collect()
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {r.text for r in got} == {t for i, t in rows if i not in held}
    assert training_rows(docs, table, "toxic", 4, 2, 7).count() == 7


def test_toxicity_learns_and_ignores_the_other_columns(spark):
    rows, labels = toxic_rows(2, 400)
    docs = documents(spark, rows, "score double, label string, doc int", (0.5, "x", 1))
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    weights, intercept = toxicity.train_on(docs, table)
    odd = documents(spark, [(900, None), (901, ""), (None, "you SCUM"), (903, "nice day " * 50_000), (903, "scum"), (903, "scum")])
    fresh, truth = toxic_rows(3, 200)
    got = {r.doc.doc_id: r.score for r in toxicity.score(documents(spark, fresh), weights, intercept).collect()}
    assert np.mean([(got[i] >= toxicity.THRESHOLD) == bool(y) for i, y in truth]) > 0.97
    scores = [(r.doc.doc_id, r.score) for r in toxicity.score(odd, weights, intercept).collect()]
    assert scores[0][1] == scores[1][1] < 0.3 < scores[2][1] and scores[3][1] < 0.3 and scores[4] == scores[5]


def test_swapped_identity_terms_change_the_score_less(spark):
    """Labels that lean on one term of a group: the penalty takes the lean out of the score."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        bad = i % 2
        term = "muslims" if rng.random() < (0.8 if bad else 0.2) else "christians"
        rows.append((" ".join([*(rng.choice(POOL) for _ in range(12)), term, *(["scum"] if bad and i % 3 else [])]), bad))
    table = spark.createDataFrame(rows, "text string, label int")
    gap = {}
    for penalty in (0.0, 10.0):
        weights, _ = toxicity.train(table, fairness=penalty)
        gap[penalty] = abs(weights[b"muslims"] - weights[b"christians"])
    assert gap[10.0] < 0.1 * gap[0.0]


def test_a_sentence_and_its_swapped_twin_score_alike(spark):
    """A term's stems are swapped with it, so the lean cannot move from the word to them."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        bad = i % 2
        term = "muslims" if rng.random() < (0.8 if bad else 0.2) else "christians"
        rows.append((" ".join([*(rng.choice(POOL) for _ in range(12)), term, *(["scum"] if bad and i % 3 else [])]), bad))
    table = spark.createDataFrame(rows, "text string, label int")
    twins = documents(spark, [(1, "my neighbours are christians"), (2, "my neighbours are muslims"), (3, "my neighbours are jews")])
    gap = {}
    for penalty in (0.0, 10.0):
        model = toxicity.train(table, fairness=penalty)
        logits = [np.log(r.score / (1 - r.score)) for r in toxicity.score(twins, *model).collect()]
        gap[penalty] = max(logits) - min(logits)
    assert gap[10.0] < 0.1 * gap[0.0], gap


def test_stems_follow_the_swapped_words(spark):
    body = "Muslims and musliminnen"
    table = spark.createDataFrame([(body, 1), ("no term at all", 0)], "text string, label int")
    words = sorted(toxicity.features_of(body.lower().encode()) | toxicity.features_of(b"jews and musliminnen"))
    found = {r.label: r for r in toxicity.features(table, words, toxicity.swaps())}
    assert {words[i] for i in found[1].plain} == toxicity.features_of(body.lower().encode())
    assert {words[i] for i in found[1].swapped} == toxicity.features_of(b"jews and musliminnen")
    assert found[0].swapped is None


@pytest.mark.parametrize("labels,score", [([], 0.0), ([(1, 0), (3, 0)], 0.0), ([(1, 1), (3, 1)], 1.0)])
def test_without_labels_of_both_kinds(spark, labels, score):
    docs = documents(spark, [(1, "a b"), (3, "c"), (4, None)])
    weights, intercept = toxicity.train_on(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(docs, weights, intercept).collect()} == {score}
    rows = spark.createDataFrame([("x", y) for _, y in labels], "text string, label int")
    assert {r.score for r in quality.score(docs, quality.train(rows)).collect()} == {score}


def test_passages_of_odd_texts():
    data = np.frombuffer(("é" * 700 + "The The | 12!").encode(), np.uint8)
    x, counts = quality.passages(data, np.array([0, 0, 1400, len(data), len(data)]))
    assert counts.tolist() == [1, 3, 1, 1] and x.shape == (6, quality.FEATURES) and np.isfinite(x).all()
    whole, _ = quality.passages(data, np.array([1400, len(data)]))
    assert np.allclose(whole[0], x[4])


def test_gradient_of_the_network():
    rng = np.random.default_rng(1)
    x, counts, y = rng.normal(size=(9, quality.FEATURES)), np.array([1, 3, 5]), np.array([0.0, 1.0, 1.0])
    net = quality.Network()
    slope = net.gradient(x, counts, y)

    def loss():
        logit, _ = net.forward(x, counts)
        return np.mean(np.log1p(np.exp(logit)) - y * logit)

    for name in net.w:
        at = tuple(0 for _ in net.w[name].shape)
        kept = net.w[name][at]
        net.w[name][at] = kept + 1e-6
        up = loss()
        net.w[name][at] = kept - 1e-6
        down = loss()
        net.w[name][at] = kept
        assert abs((up - down) / 2e-6 - slope[name][at]) < 1e-6


def test_quality_finds_the_bad_passage_in_long_texts(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        parts = [" ".join(rng.choice(POOL) for _ in range(60)) for _ in range(rng.randrange(1, 6))]
        if i % 2:
            parts.insert(rng.randrange(len(parts) + 1), " ".join(rng.choice(POOL).upper() + "!!" for _ in range(60)))
        rows.append(("\n".join(parts), 1 - i % 2))
    model = quality.train(spark.createDataFrame(rows[:200], "text string, label int"))
    docs = documents(spark, [(i, t) for i, (t, _) in enumerate(rows[200:])], "score int, body string", (1, "b"))
    got = {r.doc.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, (_, y) in enumerate(rows[200:])]) > 0.9
    odd = quality.score(documents(spark, [(1, None), (1, ""), (2, "x" * 400_000), (3, "a"), (3, "a")]), model).collect()
    assert len(odd) == 5 and all(0 <= r.score <= 1 for r in odd) and odd[0].score == odd[1].score
    assert quality.score(documents(spark, []), model).collect() == []
