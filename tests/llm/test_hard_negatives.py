"""Against all scores."""

import math

import numpy as np
import pytest
from conftest import plan
from pyspark.sql import functions as F

from rainroute.llm import hard_negatives as hn
from rainroute.llm import vector_blocks as vb


def expected(rows):
    """Rows as (vec_id, label, vector); the contract read word for word."""
    usable = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        usable[(i, label, tuple(math.floor(256 * x) for x in v))] = None
    usable = list(usable)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, label, v in usable:
        if i % 50:
            continue
        scored = sorted(((-dot(v, w), j, m) for j, m, w in usable if j != i))
        for s, j, _ in [x for x in scored if x[2] == label][:5]:
            fits = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fits)]
    return sorted(out)


def table(spark, rows, extra="", value=()):
    schema = "vec_id long, embedding array<float>, label int" + (f", {extra}" if extra else "")
    return spark.createDataFrame([(i, v, label, *value) for i, label, v in rows], schema)


def mined(df):
    found = hn.hard_negatives(hn.whole_numbers(df), F.col("id") % 50 == 0)
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in found.collect())


def vectors(seed, n, width, centres=0):
    """Random unit vectors as 32-bit floats, around some centres if asked."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, width))
    if centres:
        v = 0.4 * v / np.sqrt(width) + rng.normal(size=(centres, width))[rng.integers(centres, size=n)] / np.sqrt(width)
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    return [(i, int(x), y) for i, x, y in zip(range(n), rng.integers(0, 4, n), v.tolist(), strict=True)]


@pytest.mark.parametrize("width, centres", [(2, 0), (7, 0), (16, 6), (1, 0)])
def test_equals_all_scores(spark, monkeypatch, width, centres):
    monkeypatch.setattr(hn, "FIRST", 20)
    monkeypatch.setattr(hn, "PER_CELL", 16)
    monkeypatch.setattr(vb, "BLOCK", 13)
    monkeypatch.setattr(vb, "PACK", 3)
    monkeypatch.setattr(vb, "SALT", 20)
    rows = vectors(width, 700, width, centres)
    if width == 1:
        rows = [(i, label, [x * (i + 1) / 700 for x in v]) for i, label, v in rows]
    got = mined(table(spark, rows))
    assert got == expected(rows) and got


def test_searches_stop_on_certified_windows(spark, monkeypatch):
    """Where vectors lie around centres, most cells are never visited."""
    rows = vectors(5, 1500, 8, 12)
    df = hn.whole_numbers(table(spark, rows))
    monkeypatch.setattr(hn, "PER_CELL", 8)
    monkeypatch.setattr(hn, "FIRST", 64)
    index = hn.Index(df)
    queries = index.placed.where("id % 50 = 0").select(F.col("id").alias("own"), F.col("label").alias("group"), "vector", "cell")
    queries = queries.withColumn("key", F.col("own"))
    found = hn.positives(index, queries)
    last = found.groupBy("key").agg(F.min("score").cast("double").alias("least"))
    visits = vb.visits_of(queries.join(last, "key"), ["group", "cell", "key"], index.visitor(0, 1 << 30), index.counts, hn._payload(8, []), hn.NAMES)
    pairs = visits.select((F.length("key") / 8).alias("n")).agg(F.sum("n")).first()[0]
    assert pairs < 0.5 * 30 * len(index.counts)


def test_ties_copies_and_unusable_rows(spark):
    same = [0.5, -0.25, 0.125]
    rows = [(i, i % 3, same) for i in range(0, 120)]
    rows += [(i, i % 3, same) for i in range(0, 120, 10)]  # repeated rows
    rows += [(200, 1, [0.25, 0.0, 0.0]), (250, 1, [-0.5, 0.25, -0.125]), (300, 9, [0.0, 0.0, 0.0]), (350, 2, [0.4])]
    rows += [(201, 2, [0.3, -0.1, 0.1]), (202, 2, [0.3, -0.1]), (203, 0, [0.0]), (204, 0, [])]
    rows += [(205, None, same), (None, 1, same), (206, 1, None), (207, 1, [None, 0.1, 0.2]), (208, 2, [float("nan"), 0.1, 0.2]), (400, 2, [float("inf"), 0.1, 0.2])]
    df = table(spark, rows, "id int, cell string, vector int, score double", (1, "c", 2, 0.5))
    got = mined(df)
    assert got == expected(rows) and got
    assert {r[0] for r in got} == {0, 50, 100, 200, 250, 350}  # of 250, positive and negative both score 0


def test_one_label_has_no_negatives_and_few_rows_are_all(spark):
    rows = [(i, 3, v) for i, _, v in vectors(1, 40, 5) if i % 7]
    assert mined(table(spark, [(50, 3, rows[0][2]), *rows])) == []
    two = [(50, 1, [1.0, 0.0]), (51, 1, [0.9, 0.1]), (52, 2, [0.5, 0.0])]
    assert mined(table(spark, two)) == expected(two) == [(50, 51, 1, 52, 256 * 230, 256 * 128)]
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(50, 1, None)])) == []


def test_scores_beyond_floating_point_are_whole_numbers():
    q, v = np.array([[(1 << 27) - 1, 3]]), np.array([[(1 << 27) - 1, 1], [(1 << 27) - 1, 2]])
    assert hn.exact_scores(q, v).tolist() == [[((1 << 27) - 1) ** 2 + 3, ((1 << 27) - 1) ** 2 + 6]]
    who, row = vb.best_per_query(hn.exact_scores(q, v), np.array([1, 2]), np.ones((1, 2), bool), 1)
    assert row.tolist() == [1]


def test_cells_come_by_falling_bound():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=9), rng.normal(size=5)
    a[4] = -np.inf
    got = list(hn.multi_sequence(a, b))
    assert [x[0] for x in got] == sorted((x + y for x in a for y in b if np.isfinite(x)), reverse=True)
    assert len({(i, j) for _, i, j in got}) == 8 * 5
    assert list(hn.multi_sequence(np.array([-np.inf]), b)) == []


def test_query(spark, tiny):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{tiny}/embeddings.parquet").collect()]
    got = hn.op11_hard_negative_mining(spark, tiny)
    assert sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) == expected(rows)


def test_a_pack_visits_tiles_once_and_is_not_broadcast(spark, monkeypatch):
    """What queries send does not grow with the number of cells, and few queries that want many cells stay on the executors."""
    monkeypatch.setattr(hn, "PER_CELL", 4)
    monkeypatch.setattr(vb, "BLOCK", 200)
    rows = vectors(6, 1200, 8)
    index = hn.Index(hn.whole_numbers(table(spark, rows)))
    queries = index.placed.where("id % 50 = 0").select(F.col("id").alias("own"), F.col("label").alias("group"), "vector", "cell")
    queries = queries.withColumn("key", F.col("own")).withColumn("least", F.lit(float("-inf")))
    names = [*hn.NAMES, "least"]
    visits = vb.visits_of(queries, ["group", "cell", "key"], index.visitor(0, index.n), index.counts, hn._payload(8, ["least"], index.kind), names)
    tiles = len(vb.Tiles(index.counts).spans())
    assert len(index.counts) > 100 and tiles < 10
    pairs = visits.select((F.length("key") / 8).alias("n")).agg(F.sum("n")).first()[0]
    assert pairs <= 24 * tiles
    new = vb.met(visits, index.blocks, hn._prepared(8, index.kind), hn._meeting(8, index.kind, 5, 1), names, "key long, id long, score long")
    assert "Broadcast" not in plan(new)
    assert new.count() >= 24 * 5


def test_tiles_hold_few_rows_and_large_cells_have_several(monkeypatch):
    monkeypatch.setattr(vb, "BLOCK", 10)
    monkeypatch.setattr(vb, "SALT", 30)
    monkeypatch.setattr(vb, "TILES", 1)
    counts = {9: 12, 1: 5, 2: 20, 4: 6, 5: 1000, 7: 30}
    tiles = vb.Tiles(counts)
    held = {}
    for tile, n, i, j in tiles.spans():
        held[tile, n] = [tiles.cells[k] for k in range(i, j)]
        assert [tiles.place[c] for c in held[tile, n]] == list(range(j - i))
    assert sorted(c for cells in held.values() for c in cells) == sorted(counts)
    assert all(sum(counts[c] for c in cells) <= 30 * n for (_, n), cells in held.items())
    taken = [t for (tile, n) in held for t in range(tile, tile + n)]
    assert len(taken) == len(set(taken)) and held[min(held)] == [1, 2]
    assert tiles.several[5] == 34


def test_early_waves_and_the_rest_visit_every_cell_once(spark, monkeypatch):
    """Without a bound every query meets every row in exactly one wave."""
    monkeypatch.setattr(hn, "PER_CELL", 10)
    monkeypatch.setattr(hn, "FIRST", 40)
    monkeypatch.setattr(hn, "STEP", 4)
    index = hn.Index(hn.whole_numbers(table(spark, vectors(8, 900, 6))))
    pack = index.placed.limit(30).withColumn("least", F.lit(float("-inf"))).toArrow()
    waves = list(index.waves())
    due = [index.visitor(low, high)(pack).astype(int) for low, high in waves]
    assert len(waves) == 3 and (sum(due) == 1).all()
    sizes = np.array([index.counts[c] for c in sorted(index.counts)])
    assert ((due[0] @ sizes) >= 40).all() and ((due[0] + due[1]) @ sizes >= 160).all() and ((due[0] @ sizes) < 40 + sizes.max()).all()
