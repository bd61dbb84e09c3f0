"""Benchmark decontamination: benchmark windows found in documents by one Aho-Corasick automaton.

Texts are lower-cased in A-Z and read as words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
Every run of ``width`` consecutive words of an item is a pattern; an item of fewer
words, but not none, is one pattern. A document is scanned once, as its words joined
by spaces, and matches are mapped back to word numbers and to byte places of the
original text.

Patterns go to the tasks in blocks of at most ``BLOCK`` bytes, so no broadcast or
automaton grows with the benchmark; each further block is one more scan of the documents.

Defined cases: null and empty texts have no words and no hits; items without words
have no patterns; rows of one item id count as one item, a null id as the empty string; rows alike in id and text get the same
result each; an empty benchmark hits nothing; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainroute.session import materialise

from . import text
from .repeats import key_columns
from .suffix_dedup import covered
from .tasks import arrow_map

WIDTH = 10
BLOCK = 2 << 20  # bytes of patterns in one automaton

#: Lower-cases A-Z and turns every separator into a space.
_NORMAL = np.where(text.PUNCTUATION[text.LOWER], 0x20, text.LOWER).astype(np.uint8).tobytes()

_FOUND = "n_words long, hits array<struct<start:int,stop:int>>, spans array<struct<start:int,stop:int>>, items array<string>"


def words_of(body: bytes) -> list[bytes]:
    return body.translate(_NORMAL).split()


def patterns(items: DataFrame, width: int, id_column: str = "item_id", column: str = "text") -> DataFrame:
    """One row per different window: pattern (bytes), n words, items (ids as text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, sizes = [], [], []
            for item, body in zip(batch.column("item").to_pylist(), batch.column("z").to_pylist(), strict=True):
                words = words_of(body)
                n = min(width, len(words))
                for i in range(len(words) - n + 1 if n else 0):
                    ids.append(item)
                    found.append(b" ".join(words[i : i + n]))
                    sizes.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(found, pa.binary()), pa.array(sizes, pa.int32())], ["item", "pattern", "n"]
            )

    rows = items.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(column), F.lit("")).cast("binary").alias("z"),
    )
    return (
        arrow_map(rows, cut, "item string, pattern binary, n int")
        .groupBy("pattern", "n")
        .agg(F.collect_set("item").alias("items"))
    )


def blocks_of(found: DataFrame, limit: int) -> Iterator[list[tuple[bytes, int, list[str]]]]:
    """Patterns in lists of at most ``limit`` bytes (ids included), one list on the driver at a time."""
    block, size = [], 0
    for row in found.toLocalIterator():
        cost = len(row.pattern) + sum(len(x) for x in row["items"])
        if block and size + cost > limit:
            yield block
            block, size = [], 0
        block.append((bytes(row.pattern), row.n, list(row["items"])))
        size += cost
    if block:
        yield block


def automaton_of(block: list[tuple[bytes, int, list[str]]]):
    """Bytes are read as Latin-1 characters; a space before and after keeps to whole words."""
    out = ahocorasick.Automaton()
    for number, (pattern, _, _) in enumerate(block):
        out.add_word(f" {pattern.decode('latin-1')} ", number)
    if block:
        out.make_automaton()
    return out


def scan(docs: DataFrame, block: list[tuple[bytes, int, list[str]]], always: bool) -> DataFrame:
    """Adds n_words, hits (words), spans (bytes of the text) and items; without ``always`` only rows with hits.

    ``docs`` has ``z``, the text as bytes, which is left out of the result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(block)
    others = [c for c in docs.columns if c != "z"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        automaton = automaton_of(known)
        for batch in batches:
            keep, out = [], ([], [], [], [])
            for row, body in enumerate(batch.column("z")):
                body = bytes(body.as_buffer())
                words = words_of(body)
                hits, spans, items = [], [], set()
                if known and words:
                    line = f" {b' '.join(words).decode('latin-1')} "
                    matches = list(automaton.iter(line))
                    if matches:
                        hits, items = _hits(line, matches, known)
                        spans = _spans(body, hits)
                if always or hits:
                    keep.append(row)
                    for column, value in zip(out, (len(words), hits, spans, sorted(items)), strict=True):
                        column.append(value)
            part = batch.take(pa.array(keep, pa.int64())) if len(keep) < batch.num_rows else batch
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in others),
                    pa.array(out[0], pa.int64()),
                    *(pa.array([[{"start": a, "stop": b} for a, b in x] for x in c], kind) for c in out[1:3]),
                    pa.array(out[3], pa.list_(pa.string())),
                ],
                [*others, "n_words", "hits", "spans", "items"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "z")
    return arrow_map(docs, find, f"{schema}, {_FOUND}")


def _hits(line: str, matches, known):
    starts = np.flatnonzero(np.frombuffer(line.encode("latin-1"), dtype=np.uint8) == 0x20)
    ends = np.array([e for e, _ in matches])  # the space after the match
    stop = np.searchsorted(starts, ends)
    size = np.array([known[number][1] for _, number in matches])
    items = {item for _, number in matches for item in known[number][2]}
    return covered(list(zip((stop - size).tolist(), stop.tolist(), strict=True))), items


def _spans(body: bytes, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    data = text.LOWER[np.frombuffer(body, dtype=np.uint8)]
    start, stop = text.word_bounds(data, np.array([0, len(data)]), text.PUNCTUATION)
    return [(int(start[a]), int(stop[b - 1])) for a, b in hits]


def find_contamination(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, column: str = "text", id_column: str = "doc_id", block: int = BLOCK
) -> DataFrame:
    """Every column of ``docs`` as struct ``doc``, and n_words, hits, spans, items of each row."""
    found = materialise(patterns(items, width), "patterns")
    rows = docs.select(
        *key_columns(F.col(id_column), F.col(column)),
        F.struct(*docs.columns).alias("doc"),
        F.coalesce(F.col(column), F.lit("")).cast("binary").alias("z"),
    )
    blocks = blocks_of(found, block)
    first, second = next(blocks, []), next(blocks, None)
    out = scan(rows.drop("k1", "k2") if second is None else rows, first, always=True)
    while second is not None:  # each block's hits are few rows, merged by key
        more = materialise(scan(rows.drop("doc"), second, always=False), "hits").dropDuplicates(["k1", "k2"])
        more = more.select("k1", "k2", *[F.col(c).alias(f"more_{c}") for c in ("hits", "spans", "items")])
        out = out.join(more, ["k1", "k2"], "left")
        for c in ("hits", "spans", "items"):
            out = out.withColumn(
                c, F.array_sort(F.array_distinct(F.concat(c, F.coalesce(f"more_{c}", F.expr(f"filter({c}, x -> false)")))))
            ).drop(f"more_{c}")
        second = next(blocks, None)
    return out.drop("k1", "k2")


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents without any benchmark window, unchanged."""
    return find_contamination(docs, items, width).where(F.size("hits") == 0).select("doc.*")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    # Hits of different blocks may overlap, so words are counted, not lengths added.
    n_hit = "size(array_distinct(flatten(transform(hits, h -> sequence(h.start, h.stop - 1)))))"
    return find_contamination(docs, items).select(
        F.col("doc.doc_id").alias("doc_id"),
        "n_words",
        F.expr(f"if(size(hits) = 0, 0, {n_hit})").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
