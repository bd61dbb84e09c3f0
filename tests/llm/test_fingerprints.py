import numpy as np
from helpers import documents, random_texts

import brute
from rainroute.llm import fingerprints


def expected_next(rows):
    """Index of each row's next: falling ids (null last), equal ids by text, the first after the last."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0), rows[i][1] or ""))
    return {order[k]: order[(k + 1) % len(order)] for k in range(len(order))}


def edited(rows, nexts, i):
    text, following = rows[i][1] or "", rows[nexts[i]][1] or ""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def check(spark, rows, **extra):
    got = fingerprints.fingerprints(documents(spark, rows, **extra)).collect()
    nexts = expected_next(rows)
    key = lambda r: tuple(str(x) for x in r)
    want = [(i, len(t or ""), brute.sha(edited(rows, nexts, k).encode())) for k, (i, t) in enumerate(rows)]
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted(want, key=key)
    return got, nexts


def test_edited_texts_and_estimates(spark):
    rows = list(enumerate(random_texts(4, 150, words=80, vocabulary=900), 5))
    got, nexts = check(spark, rows)
    by_id = {r.doc_id: r for r in got}
    off = [by_id[i].near_edited - brute.likeness(t, edited(rows, nexts, k)) for k, (i, t) in enumerate(rows)]
    off += [by_id[i].near_next - brute.likeness(t, rows[nexts[k]][1]) for k, (i, t) in enumerate(rows)]
    assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.12


def test_estimates_as_close_as_64_samples_make_them(spark):
    rows = list(enumerate(random_texts(4, 120, words=80, vocabulary=60), 5))
    got, nexts = check(spark, rows)
    assert {len(r.fingerprint) for r in got} == {len(r.edited_fingerprint) for r in got} == {6 * 64}
    by_id = {r.doc_id: r for r in got}
    off = [by_id[i].near_edited - brute.likeness(t, edited(rows, nexts, k)) for k, (i, t) in enumerate(rows)]
    off += [by_id[i].near_next - brute.likeness(t, rows[nexts[k]][1]) for k, (i, t) in enumerate(rows)]
    assert abs(np.mean(off)) < 0.015 and np.std(off) < 0.09


def test_ties_nulls_empty_and_repeated_rows(spark):
    rows = [(3, "b c d e f g"), (3, "a a a"), (3, "a a a"), (None, "x y z"), (None, None), (2, ""), (1, None), (9, "é" * 10), (8, "a a a")]
    got, _ = check(spark, rows, extra="part int, kind string, f0 int", value=(1, "k", 2))
    empty = {r.fingerprint for r in got if r.n_chars == 0}
    alike = {r.fingerprint for r in got if r.n_chars == 5 and r.doc_id in (3, 8)}
    assert len(empty) == 1 and len(alike) == 1  # equal texts, equal fingerprints
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_one_document_and_none(spark):
    (row,), _ = check(spark, [(1, "abc def ghi jkl")])
    assert row.near_next == 1.0
    assert fingerprints.fingerprints(documents(spark, [])).collect() == []


def test_long_text(spark):
    check(spark, [(1, "ab cd " * 200_000), (2, "x")])


def test_samples_are_drawn_from_the_gamma_distribution(spark):
    found = spark.range(200_000).selectExpr("xxhash64(id) as h").selectExpr(f"{fingerprints._gamma('h')} as g").toPandas().g
    assert abs(found.mean() - 2) < 0.02 and abs(found.var() - 2) < 0.05


def test_words_left_out_change_no_sample(spark):
    rows = [(i, k, t) for i, t in enumerate(random_texts(4, 60, words=80, vocabulary=900)) for k in range(2)]
    rows = [(i, k, t if k == 0 else t[: len(t) // 2] + " more") for i, k, t in rows] + [(99, 0, ""), (99, 1, "a a a b")]
    bodies = spark.createDataFrame(rows, "part int, kind int, body string")
    whole, most, few = (
        {r.part: r for r in fingerprints.signatures(bodies, ["part"], 2, near=near).collect()}
        for near in (float("inf"), fingerprints.NEAR, 4.0)
    )
    assert len(whole) == 61 and all(r.sure for r in whole.values()) and most == whole
    sure = [r for r in few.values() if r.sure]
    assert 0 < len(sure) < 61 and all(r == whole[r.part] for r in sure)


def test_all_words_are_taken_where_a_sample_is_not_sure(spark):
    docs = documents(spark, list(enumerate(random_texts(4, 30, words=80, vocabulary=900))))
    want, got = fingerprints.fingerprints(docs), fingerprints.fingerprints(docs, near=0.5)
    assert fingerprints._fingerprints(docs, 0.5).where("not sure").count() > 0
    assert sorted(want.collect()) == sorted(got.collect())


def test_no_python_in_the_plan(spark, tiny):
    from conftest import plan

    text = plan(fingerprints.op4_document_fingerprints(spark, tiny))
    assert not any(x in text for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_no_python_in_the_plan_of_what_is_written(spark, tiny):
    from conftest import plan

    text = plan(fingerprints._fingerprints(spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text"), fingerprints.NEAR))
    assert "HashAggregate" in text and not any(x in text for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
