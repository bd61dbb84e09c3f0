"""Against whole texts tokenised by both libraries and every pair of tokens compared."""

import random
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents

import brute
from rainroute.llm import alignment

pytest.importorskip("public_tokenizers")

ODD = [
    "", " ", "  ", "a", "a ", "\n", "\n\n a", "a \n\tb", "<|endoftext|> x", "x▁y", "日本語 ñ 😀 é", "<0x41> <s></s><unk>", "\x00a", "a▁ b", " lead",
    "trail  \n\n ", "a\x1c b　c\xa0d", "it's We'll  don't", "é x", "�", "a\r\n b\r\n", "x" * 300, "();\n  return\n", "🏳️‍🌈 ok", "ﬁ ℌ", "  z",
]


@pytest.fixture(scope="module")
def models():
    return alignment.public_models()


@pytest.fixture(scope="module")
def both(models):
    return alignment.Aligner(*models)


def aligned(both, text):
    """(n_a, n_b, n_groups, groups) and the list of links."""
    none = (0, 0, 0, ""), []
    if not text:
        return none
    full = (" " + text).encode()
    ids = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    pieces = [[e.spelt(np.array([i])).tobytes() for i in side] for e, side in zip((both.a_entries, both.b_entries), ids, strict=True)]
    if any(b"".join(p) != full for p in pieces):
        return none
    a, b = ([0, *accumulate(map(len, p))] for p in pieces)
    common = sorted(set(a[1:]) & set(b[1:]))
    groups = []
    for low, high in zip([0, *common], common, strict=False):
        inside = [[str(i) for i, end in zip(side, ends[1:], strict=True) if low < end <= high] for side, ends in zip(ids, (a, b), strict=True)]
        groups.append("|".join(",".join(x) for x in inside))
    links = [
        (ids[0][i], ids[1][j])
        for i in range(len(ids[0])) for j in range(len(ids[1])) if max(a[i], b[j]) < min(a[i + 1], b[j + 1])
    ]
    return (len(ids[0]), len(ids[1]), len(common), ";".join(groups)), links


def expected(both, texts):
    found = [aligned(both, t) for t in texts]
    counts = Counter(p for _, links in found for p in set(links))
    highest = {}
    for (a, _), n in counts.items():
        highest[a] = max(n, highest.get(a, 0))
    return [
        (*x[:3], len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links), x[3])
        for x, links in found
    ]


def odd_texts(seed, number):
    rng = random.Random(seed)
    kinds = [lambda: rng.randrange(32, 127), lambda: rng.randrange(0, 0x3100), lambda: 32, lambda: 10, lambda: 97, lambda: 0x2581 if rng.random() < 0.02 else 98]
    return ["".join(chr(rng.choice(kinds)()) for _ in range(rng.randrange(1, 50))) for _ in range(number)]


def test_units_give_the_tokens_of_whole_texts(both):
    assert both.cut is not None
    texts = ODD + odd_texts(3, 600)
    found = alignment.block_of(both, texts, True)
    for i, t in enumerate(texts):
        want, links = aligned(both, t)
        got = tuple(int(found[c][i]) for c in ("n_a", "n_b", "n_groups")) + (found["groups"][i],)
        assert got == want, t
        assert found["n_links"][i] == len(links)
    assert any(aligned(both, t)[0][0] == 0 for t in texts if t), "a text that does not survive B is among them"


def test_texts_that_may_not_be_cut(models):
    whole = alignment.Aligner(*models)
    whole.cut = None
    texts = ODD + odd_texts(4, 100)
    cut = alignment.block_of(alignment.Aligner(*models), texts, True)
    got = alignment.block_of(whole, texts, True)
    for c in ("n_a", "n_b", "n_groups", "n_links"):
        assert got[c].tolist() == cut[c].tolist()
    assert got["groups"] == cut["groups"]


def test_spans_inside_a_character_come_from_decoded_bytes():
    decoded = np.array([2, 3, 4, 7])
    offered = np.array([4, 4, 4, 7])  # three tokens of one four-byte character, then three plain ones
    assert alignment.refined(decoded, offered, np.array([False, False, True, True])).tolist() == [2, 3, 4, 7]


@pytest.mark.parametrize("limit", [1, 200, 1 << 20])
def test_counts_over_all_blocks(spark, both, models, limit):
    texts = [*ODD, None, *odd_texts(5, 40), *["the same words again"] * 7, "the same word again"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "the same"), (3, texts[3])]
    df = documents(spark, rows, "units int, doc string, `a.b` string", (1, "d", "e")).repartition(3)
    out = alignment.alignment(df, models, limit=limit)
    got = sorted(
        (-1 if r.doc.doc_id is None else r.doc.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups, r.groups_sha256)
        for r in out.collect()
    )
    want = expected(both, [t for _, t in rows])
    assert got == sorted((-1 if i is None else i, *w, brute.sha(w[-1].encode()) if w[-1] else "") for (i, _), w in zip(rows, want, strict=True))
    assert out.first().doc["a.b"] == "e"


def test_empty_tables(spark, models):
    assert alignment.alignment(documents(spark, []), models).collect() == []
    only = documents(spark, [(1, None), (2, "")])
    assert sorted((r.doc.doc_id, r.n_a, r.count_sum, r.groups_sha256) for r in alignment.alignment(only, models).collect()) == [(1, 0, 0, ""), (2, 0, 0, "")]


def test_query_over_the_whole_table(spark, both, tiny):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    rows = [r for r in rows if len(r[1] or "") < 1500]  # all pairs of tokens of longer ones take long
    df = documents(spark, rows)
    got = {r.doc.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in alignment.alignment(df, alignment.public_models()).collect()}
    assert got == {i: w for (i, _), w in zip(rows, expected(both, [t for _, t in rows]), strict=True)}
    assert alignment.op13_cross_tokenizer_alignment(spark, tiny).count() == spark.read.parquet(f"{tiny}/documents.parquet").count()


def test_blocks_do_not_depend_on_the_size_of_batches():
    """A task holds a block and a batch, however many rows it reads; blocks are cut by bytes and rows."""
    rng = random.Random(4)
    texts = [rng.choice([None, "", "é" * rng.randrange(60), "x" * rng.randrange(200)]) for _ in range(400)]
    texts[50] = "y" * 700
    table = pa.table({"doc": list(range(400)), "body": texts})
    size = lambda t: len((t or "").encode())
    cut = []
    for rows in (1, 7, 400):
        read = [0]

        def batches(rows=rows, read=read):
            for b in table.to_batches(max_chunksize=rows):
                read[0] += b.num_rows
                yield b

        blocks, given = [], 0
        for block in alignment.gathered_batches(batches(), 500, 30):
            given += block.num_rows
            assert read[0] - given <= rows
            blocks.append(block.column("doc").to_pylist())
            assert len(blocks[-1]) <= 30 and (sum(map(size, block.column("body").to_pylist())) <= 500 or blocks[-1] == [50])
        assert [d for b in blocks for d in b] == list(range(400))
        cut.append(blocks)
    assert cut[0] == cut[1] == cut[2]
    assert list(alignment.gathered_batches(iter([]), 500, 30)) == []


def test_a_block_in_parts_is_the_same_block(both, monkeypatch):
    """Units are aligned, and documents' pairs counted, some at a time."""
    rng = random.Random(5)
    words = [*ODD, "tokenizer", "alignment", "covers", "naïve", "日本", "x1", "the"]
    texts = [*ODD, None, *(" ".join(rng.choice(words) + str(rng.randrange(60)) for _ in range(rng.randrange(1, 80))) for _ in range(120))]
    whole = alignment.block_of(both, texts, True)
    monkeypatch.setattr(alignment, "UNITS", 2 * alignment.TOGETHER)
    monkeypatch.setattr(alignment, "PART", 100)
    calls = []
    align = both.align
    monkeypatch.setattr(both, "align", lambda units: calls.append(len(units)) or align(units))
    parts = list(alignment.pieces_of(both, texts, True))
    assert len(calls) > 3 and max(calls) <= 2 * alignment.TOGETHER
    assert len(parts) > 5 and [i for i, _, _ in parts] == [0, *(j for _, j, _ in parts[:-1])] and parts[-1][1] == len(texts)
    for c in (*alignment.PER_DOC, "groups", "groups_sha256"):
        assert [x for _, _, p in parts for x in p[c]] == list(whole[c])
    counts = Counter()
    for _, _, p in parts:
        counts.update(dict(zip(np.frombuffer(p["pairs"], "<i8").tolist(), np.frombuffer(p["holders"], "<i8").tolist(), strict=True)))
    assert counts == dict(zip(np.frombuffer(whole["pairs"], "<i8").tolist(), np.frombuffer(whole["holders"], "<i8").tolist(), strict=True))
    assert max(len(p["units"]) + len(p["links"]) for _, _, p in parts) < 0.5 * (len(whole["units"]) + len(whole["links"]))
    assert [p["groups"] for _, _, p in alignment.pieces_of(both, [None, ""], True)] == [["", ""]]
