"""Against all cosines."""

import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_hard_negatives import table, vectors

from rainroute.llm import learned_partitions as lp
from rainroute.llm import vector_blocks as vb


def cosine(a, b):
    return math.fsum(x * y for x, y in zip(a, b, strict=False)) / math.sqrt(math.fsum(x * x for x in a)) / math.sqrt(math.fsum(x * x for x in b))


def nearest(rows, most=5):
    """{query_id: [(vec_id, cosine)]} of (vec_id, label, vector)."""
    usable = list({(i, tuple(v)): None for i, _, v in rows if i is not None and v and None not in v and any(v) and all(map(math.isfinite, v))})
    out = {}
    for i, v in usable:
        if i % 50 == 0:
            scored = sorted((-round(cosine(v, w), 12), j) for j, w in usable if j != i)
            out[i] = [(j, -s) for s, j in scored[:most]]
    return out


def found(df, visits=None):
    out = {}
    for r in sorted(lp.nearest_neighbours(lp.usable(df), F.col("id") % 50 == 0, visits=visits).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
        assert r.rank == len(out[r.query_id])
    return out


def hits(got, want):
    return sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want) / sum(map(len, want.values()))


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(lp, "ROWS", 50)
    monkeypatch.setattr(vb, "BLOCK", 13)
    monkeypatch.setattr(vb, "PACK", 3)
    monkeypatch.setattr(vb, "SALT", 20)


def test_all_partitions_give_the_exact_answer(spark, small):
    rows = vectors(1, 900, 9)
    assert found(table(spark, rows), visits=1000) == nearest(rows)


@pytest.mark.parametrize("centres", [0, 15])
def test_measured_visits_reach_the_recall(spark, small, centres):
    rows = vectors(2, 1500, 16, centres)
    df = table(spark, rows)
    index = lp.Index(lp.usable(df), 5)
    assert index.parts == 30 and (index.visits <= 8 if centres else index.visits <= 29)
    got = found(df)
    assert all(len(x) == 5 for x in got.values())
    assert hits(got, nearest(rows)) >= 0.9
    assert lp.recall(lp.usable(df), F.col("id") % 50 == 0) == pytest.approx(hits(got, nearest(rows)))


def test_ties_copies_and_unusable_rows(spark, small):
    same = [0.5, -0.25, 0.125]
    rows = [(i, 0, same) for i in range(0, 400)] + [(i, 1, same) for i in range(0, 400, 10)]
    rows += [(500, 1, [0.25, 0.0, 0.0]), (550, 1, [-0.5, 0.25, -0.125]), (600, 9, [0.0, 0.0, 0.0]), (650, 2, [0.5]), (651, None, [0.375, 0.125])]
    rows += [(700, 2, [2.0**90, 2.0**90, 0.0]), (750, 2, [2.0**-90, 2.0**-90, 0.0]), (None, 1, same), (800, 1, None), (850, 1, [None, 0.1]), (900, 2, [float("nan")]), (950, 2, [])]
    got = found(table(spark, rows, "id int, cell string, vector int, rank double", (1, "c", 2, 0.5)), visits=1000)
    want = nearest(rows)
    assert got == want and set(got) == {0, 50, 100, 150, 200, 250, 300, 350, 500, 550, 650, 700, 750}
    assert got[0] == [(j, 1.0) for j in (1, 2, 3, 4, 5)]


def test_few_rows_give_all_candidates(spark):
    three = [(50, 1, [1.0, 0.0]), (51, 1, [0.875, 0.125]), (100, 2, [0.0, 2.0])]
    assert found(table(spark, three)) == nearest(three)
    assert found(table(spark, [(50, 1, [1.0])])) == {}
    assert found(table(spark, [])) == {} == found(table(spark, [(50, 1, None)]))


def test_partitions_are_balanced_and_follow_the_graph():
    rows = vectors(4, 1200, 8, 12)
    points = lp.unit(np.array([v for _, _, v in rows]))
    edges = lp.nearest_rows(points, points, 10, np.arange(1200))
    part = lp.balanced_cut(points, edges, 12)
    assert np.bincount(part, minlength=12).max() <= 100
    assert (part[edges] == part[:, None]).mean() > 0.6
    assert (np.arange(1200)[:, None] != edges).all()


def test_query(spark, tiny):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{tiny}/embeddings.parquet").collect()]
    got = {}
    for r in lp.op12_approximate_neighbours(spark, tiny).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
    assert hits(got, nearest(rows)) >= 0.9


def test_the_fit_holds_few_scores_at_a_time():
    """The driver has 1,500 MB; scores of a thousand sample rows against all others took 150 of them."""
    points = lp.unit(np.random.default_rng(3).normal(size=(6144, 64)))
    tracemalloc.start()
    got = lp.nearest_rows(points, points, 10, np.arange(len(points)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
    scores = points[:50] @ points.T
    scores[np.arange(50), np.arange(50)] = -np.inf
    assert [set(x) for x in got[:50].tolist()] == [set(x) for x in np.argsort(-scores, axis=1)[:, :10].tolist()]


def test_many_rows_alike_are_decided_in_bounded_memory(monkeypatch):
    """A block whose rows all tie with the last one gives the smallest ids, and no vector per pair is held."""
    monkeypatch.setattr(lp, "PICKED", 1000)
    monkeypatch.setattr(lp, "PAIRS", 256)
    rows = np.tile(np.array([[0.5, -0.25, 0.125, 0.75]], np.float32), (1024, 16))
    ids = np.arange(1024)[::-1].copy()
    nearest_ = lp.Nearest(rows[:64], np.arange(64), np.full(64, -np.inf), 5, vb.Scores())
    units = lp.unit(rows.astype(np.float64)).astype(np.float32)
    tracemalloc.start()
    for i in range(0, 1024, 512):
        nearest_.meet(np.arange(64), rows[i : i + 512], units[i : i + 512], ids[i : i + 512])
    who, found_ids, score = nearest_.decide()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20
    assert [sorted(found_ids[who == i].tolist()) for i in range(64)] == [[j for j in range(6) if j != i][:5] for i in range(64)]
    assert (np.abs(score - 1) < 1e-12).all()
