"""Byte-level BPE encoding and decoding with a public vocabulary, in batched numpy merge rounds.

A text is cut at the vocabulary's added tokens and into words by the pretokeniser's
pattern. Words not seen before by the task are merged together: their symbols stand in
one flat array; each round looks up every neighbouring pair by binary search over
the sorted pair keys, and merges in each word its pair of lowest rank, left to
right, until no word has a pair left. Words seen before come from a bounded table.

Defined cases: null and empty texts have no tokens; repeated rows get the same
tokens; an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tasks import arrow_map

#: The pretokeniser's pattern; a fixed value of the vocabulary. White space is Unicode's, spelled
#: out because ``\s`` of the regex module also has U+001C to U+001F.
_S = r"\x09-\x0D\x20\x85\xA0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"

KNOWN = 200_000  # words a task remembers
PIECE = 2_000_000  # characters handled at a time


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1
    characters for themselves, the others counted on from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b) if b in printable else chr(spare))
        spare += b not in printable
    return out


class Vocabulary:
    """Merges as sorted pair keys, tokens as one byte array with offsets."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        characters = byte_characters()
        to_byte = {c: b for b, c in enumerate(characters)}
        self.of_byte = np.array([vocab[c] for c in characters], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)  # by rank
        self.added = {t["content"]: t["id"] for t in model["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        tokens = [b""] * size
        for token, number in vocab.items():
            tokens[number] = bytes(to_byte[c] for c in token)
        for token, number in self.added.items():
            tokens[number] = token.encode()
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.offsets = np.cumsum([0, *map(len, tokens)])
        self.split = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.words = regex.compile(PATTERN)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.empty(0, dtype=np.int64)  # tokens of the known words, one after another
        self.stops = np.zeros(1, dtype=np.int64)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words in one array, and its offsets (words + 1)."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_word = [], []
        none = len(self.ranks)
        while len(symbols):
            keys = (symbols[:-1] << 32) | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), none - 1)
            rank = np.full(len(symbols), none, dtype=np.int64)
            rank[:-1] = np.where((self.keys[at] == keys) & (word[1:] == word[:-1]), self.ranks[at], none)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            counts = np.diff(np.append(first, len(word)))
            best = np.repeat(np.minimum.reduceat(rank, first), counts)
            ended = best == none
            if ended.any():
                done_symbols.append(symbols[ended])
                done_word.append(word[ended])
                symbols, word, rank, best = (x[~ended] for x in (symbols, word, rank, best))
                if not len(symbols):
                    break
            hit = rank == best
            # Of pairs that overlap (aaa), every second one from the left is merged.
            run = np.arange(len(hit)) - np.maximum.accumulate(np.where(hit, -1, np.arange(len(hit))))
            take = hit & (run % 2 == 1)
            symbols = np.where(take, self.merged[np.minimum(rank, none - 1)], symbols)
            keep = np.ones(len(symbols), dtype=bool)
            keep[1:] = ~take[:-1]
            symbols, word = symbols[keep], word[keep]
        if not done_symbols:
            return np.empty(0, np.int64), np.zeros(len(words) + 1, np.int64)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.searchsorted(word[order], np.arange(len(words) + 1))

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """Places of the words in the table; new words are merged and added."""
        out = list(map(self.number.get, pieces))
        if None in out:
            new = list(dict.fromkeys(p for p, n in zip(pieces, out, strict=True) if n is None))
            tokens, stops = self.merge([w.encode() for w in new])
            start = len(self.number)
            self.number.update(zip(new, range(start, start + len(new)), strict=True))
            self.stops = np.concatenate([self.stops, stops[1:] + len(self.flat)])
            self.flat = np.concatenate([self.flat, tokens])
            out = list(map(self.number.__getitem__, pieces))
        return np.array(out, dtype=np.int64)

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts in one array, and its offsets (texts + 1)."""
        if len(self.number) > KNOWN:
            self.forget()
        pieces, counts = [], []
        marks = []  # (place, added token) among the pieces
        for body in texts:
            before = len(pieces)
            at = 0
            if self.split is not None:
                for m in self.split.finditer(body):
                    pieces += self.words.findall(body[at : m.start()])
                    marks.append((len(pieces), self.added[m.group()]))
                    pieces.append("")
                    at = m.end()
            pieces += self.words.findall(body[at:] if at else body)
            counts.append(len(pieces) - before)
        if not pieces:
            return np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        number = self._numbers(pieces)
        sizes = self.stops[number + 1] - self.stops[number]
        starts = self.stops[number]
        flat = self.flat
        if marks:  # an added token is one token, appended behind the table for this batch
            place, token = np.array([m[0] for m in marks]), np.array([m[1] for m in marks], dtype=np.int64)
            sizes[place], starts[place] = 1, len(flat) + np.arange(len(marks))
            flat = np.concatenate([flat, token])
        tokens = gathered(flat, starts, sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return tokens, ends[np.concatenate([[0], np.cumsum(counts)])]

    def decode(self, tokens: np.ndarray) -> bytes:
        """Bytes of the tokens; ids outside the vocabulary have none."""
        tokens = tokens[(tokens >= 0) & (tokens < len(self.offsets) - 1)]
        start = self.offsets[tokens]
        return gathered(self.bytes, start, self.offsets[tokens + 1] - start).tobytes()


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[start:start + size] of every stretch, one after another."""
    ends = np.cumsum(sizes)
    if not len(ends):
        return values[:0]
    at = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
    return values[at + np.repeat(starts, sizes)]


@lru_cache(maxsize=2)
def vocabulary(spec: str) -> Vocabulary:
    return Vocabulary(spec)


def batches_of(texts: list[str], limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` characters each; a longer text stands alone."""
    start = size = 0
    for i, body in enumerate(texts):
        if size and size + len(body) > limit:
            yield start, i
            start, size = i, 0
        size += len(body)
    if start < len(texts):
        yield start, len(texts)


def public_spec(name: str = "byte_bpe_50k.json") -> str:
    """The vocabulary file's text, read on the driver and sent to the tasks (1.5 MB)."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, spec: str, column: str = "text") -> DataFrame:
    """Every column of ``docs`` but the text as struct ``doc``; ids, decoded (text) and its bytes' hash.

    ``ids``: unsigned 32-bit little-endian numbers as bytes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(shared.value)
        for batch in batches:
            texts = [x or "" for x in batch.column("body").to_pylist()]
            for a, b in batches_of(texts):
                tokens, ends = vocab.encode_batch(texts[a:b])
                parts = [tokens[x:y] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                raw = [p.astype("<u4").tobytes() for p in parts]
                decoded = [vocab.decode(p).decode("utf-8", "replace") for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(a, b - a), pa.array(raw, pa.binary()), pa.array(decoded, pa.string())],
                    ["doc", "ids", "decoded"],
                )
        vocab.forget()  # the next task reads other texts

    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns if c != column]).alias("doc"), F.col(column).alias("body")
    )
    return arrow_map(rows, run, f"doc {rows.schema['doc'].dataType.simpleString()}, ids binary, decoded string")


def token_digests(docs: DataFrame, spec: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the token ids and of the decoded text."""
    return encode(docs.select("doc_id", "text"), spec).select(
        F.col("doc.doc_id").alias("doc_id"),
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token and round-trip digests of every text of ``documents``."""
    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_spec())
