import random

import numpy as np
from helpers import documents, edited_copies, random_texts

import brute
from rainroute.llm import components, ngram_join


def check(df, rows):
    got = sorted((r.id if r.id is not None else -1, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect())
    first = brute.classes([t for _, t in rows])
    members = {}
    for (i, _), c in zip(rows, first, strict=True):
        if i is not None:
            members.setdefault(c, []).append(i)
    want = []
    for (i, t), c in zip(rows, first, strict=True):
        n = len(brute.shingles(t))
        want.append((-1 if i is None else i, n, min(members.get(c, [None])) if n else i))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_against_brute_force_with_heavy_shingles_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HEAVY", 6)
    heavy = ngram_join.heavy_shingles
    monkeypatch.setattr(ngram_join, "heavy_shingles", lambda texts: heavy(texts, 6))
    texts = edited_copies(1, 14) + random_texts(3, 30) + ["a b c", "A  b\tC", "a b", None, "", " \n", None, "word " * 3000]
    rows = list(enumerate(texts, 50))
    random.Random(4).shuffle(rows)
    rows += [rows[0], rows[0], (None, "a b"), (None, None), (7, rows[1][1])]
    check(documents(spark, rows, "node int, label string, shingle long, n string", (1, "l", 2, "n")), rows)


def test_empty_table(spark):
    assert ngram_join.near_duplicates(documents(spark, [])).collect() == []


def test_bounds_keep_every_alike_pair():
    """Two alike sets share a deciding shingle in any order."""
    rng = np.random.default_rng(5)
    heavy = rng.integers(0, 1 << 54, 40).astype(np.uint64)
    order = ngram_join.Order(heavy)
    for _ in range(300):
        pool = np.unique(np.concatenate([rng.integers(0, 1 << 54, 60).astype(np.uint64), rng.choice(heavy, 20)]))
        a, b = (np.sort(rng.choice(pool, rng.integers(40, 60), replace=False)) for _ in range(2))
        both = len(np.intersect1d(a, b))
        _, found, _ = ngram_join.deciding(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), order)
        p = len(a) - -(-3 * len(a) // 4) + 1
        if 4 * both >= 3 * (len(a) + len(b) - both):
            assert len(np.intersect1d(found[:p], found[p:]))


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200)] + [(5, 5)]
    random.Random(1).shuffle(links)
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, **{200 + i: 200 for i in range(3)}}
