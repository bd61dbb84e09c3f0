import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents

import brute
from rainroute.llm import bpe, token_output

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

ODD = ["", " ", "a", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "it's We'll", "  \n\n a b\x85c\x1cd", "aaaaaaaaab" * 500, "日本語 ñ 😀"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def spec():
    return bpe.public_spec()


def test_equals_the_library_on_random_text(library, spec):
    vocab = bpe.Vocabulary(spec)
    rng = random.Random(2)
    texts = ODD + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0, 0x3100), 32, 10])) for _ in range(40)) for _ in range(800)]
    tokens, ends = vocab.encode_batch(texts)
    for i, t in enumerate(texts):
        ids = library.encode(t, add_special_tokens=False).ids
        mine = tokens[ends[i] : ends[i + 1]]
        assert mine.tolist() == ids
        assert vocab.decode(mine).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False) == t


def test_query_columns(spark, library, spec):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (None, "x y"), (3, ODD[3])]
    df = documents(spark, rows, "ids int, doc string", (1, "d"))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.token_digests(df, spec).collect())
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((-1 if i is None else i, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha((t or "").encode())))
    assert got == sorted(want)
    assert bpe.token_digests(documents(spark, []), spec).collect() == []


def testforgetting_words_changes_nothing(spec, monkeypatch):
    texts = [f"word{i} and more" for i in range(300)]
    whole = bpe.Vocabulary(spec).encode_batch(texts)[0].tolist()
    monkeypatch.setattr(bpe, "KNOWN", 10)
    vocab = bpe.Vocabulary(spec)
    assert [t for x in texts for t in vocab.encode_batch([x])[0].tolist()] == whole


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 31, 32, 33, 1000])
def test_permutation(size):
    for key in (0, 1, 99):
        assert sorted(token_output.permute(np.arange(size), size, key).tolist()) == list(range(size))


def test_shards_hold_every_token_once(spark, library, tmp_path):
    library.encode_special_tokens = True  # an end token written in a text is ordinary text here
    rows = [(i, t) for i, t in enumerate(ODD * 3)] + [(None, None), (5, ODD[5])]
    documents(spark, rows, "slot int, shard string", (1, "s")).repartition(3).write.parquet(f"{tmp_path}/docs")
    df = spark.read.parquet(f"{tmp_path}/docs")
    folder = f"file://{tmp_path}/shards"
    found = token_output.write_corpus(df, token_output.public_ranks(), folder, length=16, records=8)
    manifest = sorted(found.collect(), key=lambda r: r.slot)
    n = len(manifest)
    assert [r.slot for r in manifest] == list(range(n))
    slots = token_output.read_slots(folder, 0, n, length=16, records=8)
    assert slots.shape == (n, 16)
    assert [brute.sha(s.tobytes()) for s in slots] == [r.sha256 for r in manifest]
    stream = slots[token_output.permute(np.arange(n), n, 2024)].ravel().tolist()  # back in the order of the stream
    tokens = sum((len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows), 0)
    assert sum(r.n_tokens for r in manifest) == tokens and stream[tokens:] == [50256] * (16 * n - tokens)
    want = sorted(tuple(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows)
    docs, one = [], []
    for t in stream[:tokens]:
        if t == 50256:
            docs.append(tuple(one))
            one = []
        else:
            one.append(t)
    assert sorted(docs) == want
    library.encode_special_tokens = False
    # A reader that resumes at any slot sees the same records.
    assert (token_output.read_slots(folder, 11, 9, length=16, records=8) == slots[11:20]).all()
    assert {i for r in manifest for i in r.doc_ids} == {i for i, _ in rows}


def test_no_documents_no_shards(spark, tmp_path):
    empty = token_output.write_corpus(documents(spark, []), token_output.public_ranks(), f"file://{tmp_path}/none")
    assert empty.collect() == []


def test_tokens_without_lookahead_are_those_of_the_pattern(library):
    """Texts without runs of white space are read in one pass of an automaton, the others by the whole pattern."""
    ranks = token_output.public_ranks()
    assert "(?!" not in token_output.encoder(ranks, token_output._PLAIN)._pat_str
    parts = ["a", "B", "1", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "\r", "'s", "'", "é", "中", "!"]
    parts += ["\u0301", "<|end|>", "<|endoftext|>", "\u200b", "😀"]
    draw = np.random.default_rng(3)
    texts = ["".join(parts[i] for i in draw.integers(0, len(parts), n)) for n in draw.integers(0, 12, 20_000)]
    found = list(token_output.encoded(pa.array([*texts, None, *ODD]), ranks))
    library.encode_special_tokens = True
    want = [x.ids for x in library.encode_batch([*texts, "", *ODD], add_special_tokens=False)]
    library.encode_special_tokens = False
    assert [x.tolist() for x in found] == want
