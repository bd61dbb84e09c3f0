import numpy as np
import pytest
from helpers import documents, random_texts

import brute
from rainroute.llm import anchors, repeats, substring_dedup, suffix_dedup, text

CASES = [None, "", " ", "x", "naïve " * 30, "naïve " * 30 + "y", "ab" * 40, "ab" * 40, "ab" * 41]


def check_bytes(df, rows, width, **options):
    got = sorted(
        (r.doc.doc_id if r.doc.doc_id is not None else -1, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept))
        for r in suffix_dedup.remove_repeats(df, width, **options).collect()
    )
    want = sorted(
        (-1 if i is None else i, *x) for (i, _), x in zip(rows, brute.byte_repeats([t for _, t in rows], width), strict=True)
    )
    assert got == want


def check_words(df, rows, width, **options):
    got = sorted(
        (r.doc.doc_id if r.doc.doc_id is not None else -1, r.n_words, r.n_removed, r.kept)
        for r in substring_dedup.remove_repeated_words(df, width, **options).collect()
    )
    want = sorted(
        (-1 if i is None else i, *x) for (i, _), x in zip(rows, brute.word_repeats([t for _, t in rows], width), strict=True)
    )
    assert got == want


@pytest.mark.parametrize("width", [7, 24, 61])
def test_bytes_against_brute_force(spark, width):
    rows = list(enumerate(random_texts(width, 60) + CASES))
    check_bytes(documents(spark, rows), rows, width)


@pytest.mark.parametrize("width", [3, 9])
def test_words_against_brute_force(spark, width):
    rows = list(enumerate(random_texts(width, 60) + CASES))
    check_words(documents(spark, rows), rows, width)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    texts = random_texts(5, 12)
    rows = [(None, texts[0]), (None, None), (3, texts[1]), (3, texts[1]), (3, texts[2]), *enumerate(texts[3:], 10), (9, None)]
    df = documents(spark, rows, "k1 string, z int, runs string, owner long, a long, n_bytes string", ("x", 1, "r", 2, 3, "n"))
    check_bytes(df, rows, 20)
    check_words(df, rows, 6)
    assert set(suffix_dedup.remove_repeats(df, 20).first().doc.asDict()) == set(df.columns) - {"text"}


@pytest.mark.parametrize("module,check,width", [(suffix_dedup, check_bytes, 20), (substring_dedup, check_words, 6)])
def test_copies_of_a_row_have_its_repeats_once(spark, monkeypatch, module, check, width):
    texts = random_texts(5, 12)
    rows = [(None, texts[0])] * 40 + [(7, texts[1])] * 40 + list(enumerate(texts[2:], 10)) + [(50, texts[0][3:]), (51, texts[1][3:])]
    joined, cut = [], []
    arrow_map, block_rows = module.arrow_map, repeats.block_rows
    monkeypatch.setattr(module, "arrow_map", lambda df, *a: joined.append(df) or arrow_map(df, *a))
    monkeypatch.setattr(repeats, "block_rows", lambda df, *a: cut.append(df) or block_rows(df, *a))
    check(documents(spark, rows), rows, width)
    (lists,), (texts_cut,) = joined, cut
    assert lists.where("size(runs) > size(array_distinct(runs))").count() == 0
    assert texts_cut.count() == texts_cut.select("k1", "k2").distinct().count() > 2


def test_empty_table(spark):
    df = documents(spark, [])
    assert suffix_dedup.remove_repeats(df, 20).collect() == []
    assert substring_dedup.remove_repeated_words(df, 5).collect() == []


def test_groups_too_large_for_one_task_are_counted_instead(spark, monkeypatch):
    rows = list(enumerate(random_texts(8, 50, passages=1) + CASES))
    df = documents(spark, rows)
    check_words(df, rows, 6, most=1)
    found = repeats.repeated_starts

    def small(docs, unit, solver, most=1):
        return found(docs, unit, solver, 1)

    monkeypatch.setattr(repeats, "repeated_starts", small)
    check_bytes(df, rows, 24)


def test_text_longer_than_a_piece(spark):
    rng = np.random.default_rng(3)
    long = "".join(chr(97 + c) for c in rng.integers(0, 26, 5 * text.PIECE))
    tail = long[-700:]
    rows = [(1, long), (2, "left " + tail + " right"), (3, tail[:400])]
    got = {r.doc.doc_id: r for r in suffix_dedup.remove_repeats(documents(spark, rows), 400).collect()}
    assert [got[i].n_removed for i in (1, 2, 3)] == [700, 700, 400]
    assert bytes(got[1].kept) == long[:-700].encode()


def test_solvers_agree_with_each_other_on_symbols():
    rng = np.random.default_rng(1)
    for window in (3, 5, 8):
        left = [rng.integers(0, 3, rng.integers(0, window)).astype(np.uint8) for _ in range(200)]
        right = [rng.integers(0, 3, rng.integers(0, window)).astype(np.uint8) for _ in range(200)]
        group = np.sort(rng.integers(0, 20, 200))
        one = suffix_dedup.collection_repeats(group, left, right, window)
        two = substring_dedup.automaton_repeats(group, left, right, window)
        assert set(zip(*map(np.ndarray.tolist, one), strict=True)) == set(zip(*map(np.ndarray.tolist, two), strict=True))


def test_more_groups_than_one_collection_holds():
    left, right = [np.array([1, 2], np.uint8)] * 1200, [np.array([3, 4], np.uint8)] * 1200
    group = np.repeat(np.arange(600), 2)
    string, start = suffix_dedup.collection_repeats(group, left, right, 4)
    assert sorted(zip(string.tolist(), start.tolist(), strict=True)) == [(i, t) for i in range(1200) for t in (0, 1)]


def test_every_window_belongs_to_one_segment():
    rng = np.random.default_rng(2)
    symbols, bounds = rng.integers(0, 4, 500).astype(np.uint64), np.array([0, 3, 3, 60, 61, 400, 500])
    row, lo, hi, _, _, _ = anchors.segments(symbols, bounds, 12, 4)
    got = sorted((r, s) for r, a, b in zip(row, lo, hi, strict=True) for s in range(a, b + 1))
    assert got == [(r, s) for r, n in enumerate(np.diff(bounds)) for s in range(n - 11)]
