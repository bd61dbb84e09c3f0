"""Token-ID output: all token sequences of a corpus in a training order, as fixed-stride shards.

The tokens of all documents, each followed by an end token (the id after the vocabulary's), make one stream, cut into
sequences of ``length`` tokens. A keyed Feistel network permutes the sequence
numbers; numbers beyond the last sequence are walked through it again until they fall inside.
So every sequence has its slot without a shuffle of the whole or a list of numbers. A
shard is a range of slots: a file of records of equal size, in the order of slots. The place of a
slot follows from its number, so a reader can resume anywhere and reads on sequentially.

Documents are tokenised twice: once to count each task's tokens, once to cut sequences. That moves
every token once and keeps no copy of all tokens beside the shards. So ``docs`` must give the same
rows in the same order each time, as a scan of files does; a task that finds another
number of tokens than was counted fails. A task writes a shard under a name of its
own and renames it when it is whole, so a repeated task leaves the same file.

Defined cases: null and empty texts are one end token; repeated rows are in the stream
once each; the last sequence is filled up with end tokens; an empty table writes no
shard and gives no rows; further columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyarrow import fs
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainroute.session import materialise, scratch_path

from . import text
from .tasks import arrow_map

LENGTH = 2048  # tokens of a sequence
RECORDS = 4096  # sequences of a shard
_ROUNDS = 6
#: The pretokeniser's pattern (a fixed value of the vocabulary) in possessive form, which does not step back.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: The same without lookahead, as one pass of an automaton: for texts without a run of white space before a visible character.
_PLAIN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
_WHITE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"  # as Unicode has it
_RUN = f"[{_WHITE}][{_WHITE}][^{_WHITE}]"


def permute(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..size - 1, for any of its members."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
    keys = text.mix(np.arange(1, _ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (text.mix(right ^ k) & mask)
        return (left << shift) | right

    out = network(numbers.astype(np.uint64))
    while (beyond := out >= size).any():  # cycle-walking
        out[beyond] = network(out[beyond])
    return out.astype(np.int64)


@lru_cache(maxsize=4)
def encoder(ranks: bytes, pattern: str = _PATTERN) -> tiktoken.Encoding:
    """Byte-level BPE from lines of token (base 64) and rank; the end token is its last one."""
    pairs = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    # The library's arrays need some special token; none is looked for in texts.
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=pairs, special_tokens={"<|end|>": max(pairs.values()) + 1})


def encoded(column: pa.StringArray, ranks: bytes) -> Iterator[np.ndarray]:
    """Tokens of each text; a null has none."""
    plain, whole = encoder(ranks, _PLAIN), encoder(ranks)
    for body, run in zip(column.to_pylist(), pc.match_substring_regex(column, _RUN).to_pylist(), strict=True):
        yield (whole if run else plain).encode_to_numpy(body or "", allowed_special=frozenset(), disallowed_special=())


def public_ranks(name: str = "byte_bpe_50k.tiktoken") -> bytes:
    """The vocabulary file, read on the driver and sent to the tasks (1 MB)."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def token_counts(docs: DataFrame, shared: Broadcast) -> dict[int, int]:
    """Tokens of each task's documents, end tokens included: a number per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            total += sum(len(x) + 1 for x in encoded(batch.column("text"), shared.value))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([total])], ["part", "n"])

    return {r.part: r.n for r in arrow_map(docs.select("text"), run, "part long, n long").collect()}


def sequence_parts(docs: DataFrame, shared: Broadcast, counts: dict[int, int], length: int, records: int, key: int) -> DataFrame:
    """Sequences, whole or the parts that a task has of them: shard, slot, sequence, offset, doc_ids, ids.

    ``counts``: what ``token_counts`` found.
    """
    total, bases = 0, {}
    for part, n in sorted(counts.items()):
        bases[part] = total
        total += n
    count = -(-total // length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = encoder(shared.value).max_token_value
        kind = stride_type(last)
        width, end = np.dtype(kind).itemsize, np.array([last], dtype=kind).tobytes()
        part = TaskContext.get().partitionId()
        position = begin = bases[part]
        held: list[bytes] = []
        ids: list[int | None] = []
        out: list[tuple] = []

        def close() -> None:
            nonlocal begin
            if held:
                out.append((begin // length, begin % length, list(dict.fromkeys(ids)), b"".join(held)))
            held.clear()
            ids.clear()
            begin = position

        for batch in batches:
            for doc, tokens in zip(batch.column("doc_id").to_pylist(), encoded(batch.column("text"), shared.value), strict=True):
                raw, done = tokens.astype(kind).tobytes() + end, 0
                while done < len(raw):
                    piece = raw[done : done + (length - position % length) * width]
                    held.append(piece)
                    ids.append(doc)
                    done += len(piece)
                    position += len(piece) // width
                    if position % length == 0:
                        close()
            if len(out) >= 500:
                yield rows(out)
                out = []
        close()
        if out:
            yield rows(out)
        if position != bases[part] + counts[part]:
            raise ValueError("the documents changed between two readings; write them to files first")

    def rows(out: list[tuple]) -> pa.RecordBatch:
        sequence = np.array([x[0] for x in out], dtype=np.int64)
        slot = permute(sequence, count, key)
        return pa.RecordBatch.from_arrays(
            [
                pa.array((slot // records).astype(np.int32)),
                pa.array(slot),
                pa.array(sequence),
                pa.array(np.array([x[1] for x in out], dtype=np.int64)),
                pa.array([x[2] for x in out], pa.list_(pa.int64())),
                pa.array([x[3] for x in out], pa.binary()),
            ],
            ["shard", "slot", "sequence", "offset", "doc_ids", "ids"],
        )

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows_in, run, "shard int, slot long, sequence long, offset long, doc_ids array<long>, ids binary")


def stride_type(end: int) -> str:
    """Type code of a token: 2 or 4 bytes, in the order of the machine (little-endian on those that Spark runs on)."""
    return "H" if end < 1 << 16 else "I"


def shard_name(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def write_shards(parts: DataFrame, folder: str, shards: int, length: int, records: int, width: int, end: bytes) -> DataFrame:
    """Writes every shard and returns what stands where: slot, sequence, shard, byte_offset, n_tokens, doc_ids, sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        shard, sink, name = -1, None, ""
        current: list = []  # slot, sequence, shard, parts
        out: list[tuple] = []

        def finish_record() -> None:
            if not current:
                return
            slot, sequence, of, ids, pieces = current
            body = b"".join(pieces)
            n = len(body) // width
            body += end * (length - n)
            sink.write(body)
            out.append((slot, sequence, of, (slot % records) * length * width, n, list(dict.fromkeys(ids)), hashlib.sha256(body).hexdigest()))
            current.clear()

        def finish_shard() -> None:
            if sink is not None:
                sink.close()
                store.move(name, shard_name(root, shard))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "slot", "sequence", "doc_ids", "ids"))
            for of, slot, sequence, ids, piece in zip(*columns, strict=True):
                if not current or current[0] != slot:
                    finish_record()
                    if of != shard:
                        finish_shard()
                        shard, name = of, f"{root}/.writing-{of}-{uuid.uuid4().hex}"
                        sink = store.open_output_stream(name)
                    current[:] = [slot, sequence, of, [], []]
                current[3] += ids
                current[4].append(piece)
            if len(out) >= 1000:
                yield rows(out)
                out = []
        finish_record()
        finish_shard()
        if out:
            yield rows(out)

    names = "slot long, sequence long, shard int, byte_offset long, n_tokens long, doc_ids array<long>, sha256 string"
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string()]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in names.split(", ")])

    dealt = parts.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot", "offset")
    return arrow_map(dealt, run, names)


def write_corpus(docs: DataFrame, ranks: bytes, folder: str, length: int = LENGTH, records: int = RECORDS, key: int = 2024) -> DataFrame:
    """Tokenises ``docs`` (doc_id, text) and writes the shards under ``folder``; the manifest, a row per sequence."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    end = encoder(ranks).max_token_value
    kind = stride_type(end)
    counts = token_counts(docs, shared)
    shards = max(1, -(-sum(counts.values()) // (length * records)))
    parts = sequence_parts(docs, shared, counts, length, records, key)
    width = np.dtype(kind).itemsize
    return materialise(write_shards(parts, folder, shards, length, records, width, np.array([end], dtype=kind).tobytes()), "manifest")


def read_slots(folder: str, first: int, count: int, kind: str = "<u2", length: int = LENGTH, records: int = RECORDS) -> np.ndarray:
    """``count`` sequences from slot ``first`` on, as read by a training job that resumes there."""
    store, root = fs.FileSystem.from_uri(folder)
    size = length * np.dtype(kind).itemsize
    out = []
    while count > 0:
        here = min(count, records - first % records)
        with store.open_input_file(shard_name(root, first // records)) as f:
            f.seek(first % records * size)
            raw = f.read(here * size)
        if not raw:
            break
        out.append(np.frombuffer(raw, dtype=kind).reshape(-1, length))
        first, count = first + here, count - here
    return np.concatenate(out) if out else np.empty((0, length), dtype=kind)


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` as token shards in the shared folder; the manifest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return write_corpus(docs, public_ranks(), scratch_path(spark, "shards"))
