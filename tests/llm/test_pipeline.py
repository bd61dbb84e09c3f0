import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
from helpers import documents, edited_copies

import brute
import corpus_pipeline
from rainroute.llm import stages
from rainroute.llm.registry import REGISTRY

CLASH = ("k1 long, row string, label int, n_chars long", (1, "r", 2, -1))


@pytest.fixture(scope="module")
def table(tiny):
    return pq.read_table(f"{tiny}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def items(tiny):
    return [(r["item_id"], r["text"]) for r in pq.read_table(f"{tiny}/benchmark.parquet").to_pylist()]


def test_every_operator_has_one_query():
    numbers = [int(name[2:].split("_")[0]) for name in REGISTRY]
    assert sorted(numbers) == list(range(1, 14))


def test_queries_on_whole_tables(spark, tiny, table, items):
    """Each query whose rows have one right answer, against brute force over the whole table."""
    texts, ids = [r["text"] for r in table], [r["doc_id"] for r in table]

    def rows(name, *columns):
        found = REGISTRY[name](spark, tiny).collect()
        assert sorted(r.doc_id for r in found) == sorted(ids)
        return {r.doc_id: tuple(r[c] for c in columns) for r in found}

    got = rows("op1_suffix_dedup", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == {i: (*x[:3], brute.sha(x[3])) for i, x in zip(ids, brute.byte_repeats(texts, 400), strict=True)}
    got = rows("op2_benchmark_decontamination", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute.contamination(texts, items, 10)
    assert got == {i: (n, h, len(x), brute.sha(",".join(x).encode()), h > 0) for i, (n, h, x) in zip(ids, want, strict=True)}
    got = rows("op6_ngram_jaccard_join", "n_shingles", "component_id")
    members = {}
    for i, c in zip(ids, brute.classes(texts), strict=True):
        members.setdefault(c, []).append(i)
    assert got == {i: (len(brute.shingles(t)), min(members[c])) for i, t, c in zip(ids, texts, brute.classes(texts), strict=True)}
    got = rows("op7_substring_dedup", "n_words", "n_removed", "kept_sha256")
    assert got == {i: (*x[:2], brute.sha(x[2].encode())) for i, x in zip(ids, brute.word_repeats(texts, 35), strict=True)}


def test_near_duplicate_stage_keeps_one_of_each_component(spark, tiny):
    rows = list(enumerate(edited_copies(3, 10) + [None, "", None, " "], 10))
    random.Random(2).shuffle(rows)
    rows += [rows[0], rows[0], (None, rows[1][1]), (500, None), (500, None)]
    df = documents(spark, rows, *CLASH)
    kept = stages.drop_near_duplicates(spark, df, tiny)
    assert kept.columns == df.columns
    got = sorted((str(r.doc_id), r.text) for r in kept.collect() if brute.shingles(r.text))
    first = {}
    for (i, t), c in zip(rows, brute.classes([t for _, t in rows]), strict=True):
        if brute.shingles(t):
            first.setdefault(c, []).append((i is None, i or 0, str(i), t))
    assert got == sorted(min(x)[2:] for x in first.values())
    others = Counter((r.doc_id, r.text) for r in kept.collect() if not brute.shingles(r.text))
    assert others == Counter({(i, t) for i, t in rows if not brute.shingles(t)})  # once each


def test_repeat_stage_cuts_texts_and_keeps_documents(spark, tiny):
    passage = " ".join(f"shared{i}é" for i in range(60))
    rows = [(1, "own one " + passage), (2, passage + " own two"), (3, "clean"), (4, None), (5, "")]
    kept = stages.cut_repeats(spark, documents(spark, rows, *CLASH), tiny).collect()
    want = {1: "own one ", 2: " own two", 3: "clean", 4: None, 5: ""}
    assert {r.doc_id: r.text.strip() if r.text else r.text for r in kept} == {i: t.strip() if t else t for i, t in want.items()}
    assert {r.doc_id: r.n_chars for r in kept if r.doc_id > 2} == {3: -1, 4: -1, 5: -1}


@pytest.mark.parametrize("stage", [f for _, f in stages.STAGES])
def test_stages_take_an_empty_table(spark, tiny, stage):
    found = stage(spark, documents(spark, [], *CLASH), tiny)
    assert found.collect() == []
    if stage is not stages.STAGES[-1][1]:
        assert found.columns == ["doc_id", "text", "k1", "row", "label", "n_chars"]


def test_run_over_the_tables(spark, tiny, table, items):
    """The rows of the last stage belong to documents that the stages kept, each with its text as they left it."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "bpe_encoding"]
    result = {r.doc_id: r for r in corpus_pipeline.run(spark, tiny).collect()}
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    kept = {r.doc_id: r.text for r in stages.drop_toxic(spark, docs, tiny).collect()}
    ids = [r["doc_id"] for r in table if r["doc_id"] in kept]
    texts = [kept[i] for i in ids]
    one = {}
    for i, c in zip(ids, brute.classes(texts), strict=True):
        one[c] = min(i, one.get(c, i))
    stay = sorted(one.values())
    cut = [x[3].decode("utf-8", "ignore") for x in brute.byte_repeats([kept[i] for i in stay], 400)]
    clean = {i: t for i, t, (_, hit, _) in zip(stay, cut, brute.contamination(cut, items, 10), strict=True) if not hit}
    assert {i: r.decoded_sha256 for i, r in result.items()} == {i: brute.sha(t.encode()) for i, t in clean.items()}
