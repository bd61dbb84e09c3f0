"""Windows of symbols that start at two or more places of a corpus: the search around a solver.

1. Every document is cut into segments owned by an anchor (``anchors``). Anchors that
   occur once are dropped; a segment whose whole text occurs elsewhere is a repeat.
2. One copy of each other segment goes on. Its windows are dealt into blocks of
   ``block`` neighbouring starts, counted from the anchor. All windows of a block share a
   core of ``width - block + 1`` symbols, so windows can only be equal in blocks
   whose anchor, place and core are equal: the group. Groups of one are dropped.
3. Within a group a block is a short string: symbols left of the core, the core as one
   symbol, symbols right of it. Windows of ``width`` symbols are stretches of
   ``block`` symbols there. The solver, one of the operators, finds the repeated ones.
4. A group of more than ``most`` strings is not solved in one task: its windows are
   hashed, and counted by Spark with partial sums.

Symbols are compared by 64-bit hashes. Rows alike in ``doc_id`` and text are separate
documents that repeat each other. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainroute.session import materialise

from . import anchors, text
from .tasks import arrow_map

KEY = ("k1", "k2")

#: (group number of each string, symbols left of the core, symbols right of it) to the
#: window starts that are repeated: arrays of string number and start.
Solver = Callable[[np.ndarray, list[np.ndarray], list[np.ndarray], int], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Unit:
    """What is repeated: windows of ``width`` bytes or words, anchored by ``k`` of them."""

    kind: str  # "bytes" or "words"
    width: int
    k: int
    block: int

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of every symbol, offsets of the rows in it, and the symbols as solvers see them."""
        if self.kind == "bytes":
            return text.constants(256, 11)[data], offsets, data
        start, stop = text.word_bounds(data, offsets, text.SPACE)
        found = text.word_hashes(data, start, stop)
        return found, text.word_counts(start, offsets), found

    @property
    def payload(self) -> type:
        return np.uint8 if self.kind == "bytes" else np.uint64


def key_columns(doc_id: Column, body: Column) -> list[Column]:
    """128 bits that stand for a row by its id and text."""
    return [F.xxhash64(doc_id, body).alias("k1"), F.xxhash64(F.lit(7), body, doc_id).alias("k2")]


def packed(docs: DataFrame, body: str, *others: str) -> DataFrame:
    """Key and compressed text (``z``), for shuffles that move texts."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.set_column(
                batch.schema.get_field_index("z"),
                "z",
                pa.array([squeeze(z.as_buffer()) for z in batch.column("z")], pa.binary()),
            )

    df = docs.select(*others, F.coalesce(F.col(body), F.lit("")).cast("binary").alias("z"))
    return arrow_map(df, pack, df.schema)


def squeeze(buffer: pa.Buffer) -> bytes:
    """Length and zstd-compressed bytes."""
    return len(buffer).to_bytes(8, "little") + pa.compress(buffer, codec="zstd", asbytes=True)


def unsqueeze(z: bytes) -> bytes:
    n = int.from_bytes(z[:8], "little")
    return pa.decompress(z[8:], decompressed_size=n, codec="zstd", asbytes=True) if n else b""


def _pieces(data: np.ndarray, offsets: np.ndarray, unit: Unit):
    """Runs of rows as symbols; a text longer than a piece comes in overlapping parts.

    Yields first row, hashes, row bounds, and how many symbols of the (only) row came before.
    """
    for a, b in text.runs(offsets):
        part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        symbols, bounds, _ = unit.symbols(part, at)
        if len(symbols) <= 4 * text.PIECE:
            yield a, symbols, bounds, 0
            continue
        step = 2 * text.PIECE
        for lo in range(0, len(symbols) - unit.width + 1, step):
            cut = symbols[lo : lo + step + unit.width - 1]
            yield a, cut, np.array([0, len(cut)]), lo


def anchor_rows(docs: DataFrame, unit: Unit) -> DataFrame:
    """One row per segment: key, first and last window start, anchor place, owner and segment hash."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text.buffers(batch.column("text"))
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in KEY)
            for first, symbols, bounds, before in _pieces(data, offsets, unit):
                rows, lo, hi, at, owner, seg = anchors.segments(symbols, bounds, unit.width, unit.k)
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(k1[first + rows]),
                            pa.array(k2[first + rows]),
                            pa.array((lo + before).astype(np.int32)),
                            pa.array((hi + before).astype(np.int32)),
                            pa.array((at + before).astype(np.int32)),
                            pa.array(owner.view(np.int64)),
                            pa.array(seg.view(np.int64)),
                        ],
                        ["k1", "k2", "lo", "hi", "at", "owner", "seg"],
                    )

    return arrow_map(docs, find, "k1 long, k2 long, lo int, hi int, at int, owner long, seg long")


_BLOCKS = "group long, k1 long, k2 long, start int, windows int, left binary, right binary"


def block_rows(wanted: DataFrame, unit: Unit) -> DataFrame:
    """Blocks of the wanted segments; ``wanted``: key, z, segs (lo, hi, at, owner)."""
    w, width, size = unit.block, unit.width, np.dtype(unit.payload).itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            held = 0
            for k1, k2, z, segs in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "z", "segs")), strict=True):
                body = np.frombuffer(unsqueeze(z), dtype=np.uint8)
                symbols, _, seen = unit.symbols(body, np.array([0, len(body)]))
                sums = text.prefix_sums(symbols)
                lo, hi, at = (np.array([s[c] for s in segs], dtype=np.int64) for c in ("lo", "hi", "at"))
                owner = np.array([s["owner"] for s in segs], dtype=np.int64).view(np.uint64)
                low, high = (at - hi) // w, (at - lo) // w  # block numbers, by the distance from start to anchor
                seg = np.repeat(np.arange(len(segs)), high - low + 1)
                number = np.arange(len(seg)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
                number += low[seg]
                far = np.minimum(number * w + w - 1, at[seg] - lo[seg])
                near = np.maximum(number * w, at[seg] - hi[seg])
                start, stop = at[seg] - far, at[seg] - near + width
                core, core_stop = at[seg] - number * w, at[seg] - (number * w + w - 1) + width
                group = text.mix(
                    text.stretch(sums, core, core_stop) ^ text.mix(owner[seg] + number.astype(np.uint64))
                )
                raw = seen.tobytes()
                out[0].append(group.view(np.int64))
                out[1].append(np.full(len(seg), k1))
                out[2].append(np.full(len(seg), k2))
                out[3].append(start.astype(np.int32))
                out[4].append((far - near + 1).astype(np.int32))
                for column, a, b in ((5, start, core), (6, core_stop, stop)):
                    out[column] += [raw[x:y] for x, y in zip((a * size).tolist(), (b * size).tolist(), strict=True)]
                held += len(seg)
                if held >= 20_000:
                    yield _blocks(out)
                    out, held = [[] for _ in range(7)], 0
            if held:
                yield _blocks(out)

    return arrow_map(wanted.select("k1", "k2", "z", "segs"), cut, _BLOCKS)


def _blocks(out: list[list]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(x)) for x in out[:5]] + [pa.array(x, pa.binary()) for x in out[5:]]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _BLOCKS.split(", ")])


def _intervals(k1, k2, string, start, first) -> pa.RecordBatch:
    """Neighbouring repeated starts of a string as one row."""
    order = np.lexsort((start, string))
    string, start = string[order], start[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (string[1:] != string[:-1]) | (start[1:] > start[:-1] + 1)
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(start)) - 1
    s = string[at]
    return pa.RecordBatch.from_arrays(
        [pa.array(k1[s]), pa.array(k2[s]), pa.array(first[s] + start[at]), pa.array(first[s] + start[end])],
        ["k1", "k2", "a", "b"],
    )


def solved(blocks: DataFrame, unit: Unit, solver: Solver, batch_strings: int = 4096) -> DataFrame:
    """Repeated window starts of blocks that stand in the order of their groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _until_none(batches):
            if batch is not None:
                rest = batch if rest is None else pa.concat_batches([rest, batch])
                if rest.num_rows < batch_strings:
                    continue
            if rest is None or not rest.num_rows:
                continue
            group = rest.column("group").to_numpy()
            # The last group may go on in the next batch.
            other = np.flatnonzero(group != group[-1])
            stop = len(group) if batch is None else int(other[-1]) + 1 if len(other) else 0
            if stop:
                yield from _solve(rest.slice(0, stop), unit, solver)
                rest = rest.slice(stop)

    return arrow_map(blocks, run, "k1 long, k2 long, a int, b int")


def _until_none(batches):
    yield from batches
    yield None


def _solve(batch: pa.RecordBatch, unit: Unit, solver: Solver) -> Iterator[pa.RecordBatch]:
    group = batch.column("group").to_numpy()
    new = np.ones(len(group), dtype=bool)
    new[1:] = group[1:] != group[:-1]
    number = np.cumsum(new) - 1
    batch = batch.filter(pa.array(np.bincount(number)[number] > 1))
    if not batch.num_rows:
        return
    number = np.unique(batch.column("group").to_numpy(), return_inverse=True)[1]
    left, right = ([np.frombuffer(x, unit.payload) for x in batch.column(c).to_pylist()] for c in ("left", "right"))
    string, start = solver(number, left, right, unit.block)
    if len(string):
        k1, k2, first = (batch.column(c).to_numpy() for c in ("k1", "k2", "start"))
        yield _intervals(k1, k2, string, start.astype(np.int32), first)


def counted(blocks: DataFrame, unit: Unit) -> DataFrame:
    """The same for groups of any size: every window hashed, equal hashes counted."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = unit.block
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                left, right = ([np.frombuffer(x, unit.payload) for x in part.column(c).to_pylist()] for c in ("left", "right"))
                strings = [np.concatenate([a, b]) for a, b in zip(left, right, strict=True)]
                flat = text.mix(np.concatenate(strings).astype(np.uint64) + np.uint64(1))
                base = np.cumsum([0, *(len(s) for s in strings)])[:-1]
                n = part.column("windows").to_numpy().astype(np.int64)
                string = np.repeat(np.arange(len(n)), n)
                t = np.arange(len(string)) - np.repeat(np.cumsum(n) - n, n)
                place = np.array([len(x) for x in left])[string] - t  # of the core within the window
                at0 = base[string] + t
                found = text.mix(text.stretch(text.prefix_sums(flat), at0, at0 + w - 1) + place.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("group").take(pa.array(string)),
                        pa.array(found.view(np.int64)),
                        part.column("k1").take(pa.array(string)),
                        part.column("k2").take(pa.array(string)),
                        pa.array((part.column("start").to_numpy()[string] + t).astype(np.int32)),
                    ],
                    ["group", "hash", "k1", "k2", "a"],
                )

    rows = arrow_map(blocks, windows, "group long, hash long, k1 long, k2 long, a int")
    twice = rows.groupBy("group", "hash").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(twice, ["group", "hash"]).select("k1", "k2", "a", F.col("a").alias("b"))


def repeated_starts(docs: DataFrame, unit: Unit, solver: Solver, most: int = 16_384) -> DataFrame:
    """Intervals a..b of window starts that are repeated, by key; ``docs``: key, text."""
    spark = docs.sparkSession
    rows = anchor_rows(docs, unit)
    # Written first: the join below then deals rows on its own, and Spark can split a hot owner.
    often = materialise(
        rows.groupBy("owner")
        .agg(F.count("*").alias("n"), F.min("seg").alias("s0"), F.max("seg").alias("s1"))
        .where("n > 1")
        .select("owner", (F.col("s0") == F.col("s1")).alias("alike")),
        "owners",
    )
    kept = materialise(rows.join(often, "owner"), "anchors")
    mixed = kept.where("not alike")
    sets = materialise(
        mixed.groupBy("owner", "seg").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "lo", "hi", "at")).alias("one")),
        "segments",
    )
    many = sets.where("n > 1").select("owner", "seg")
    whole = kept.where("alike").select("k1", "k2", F.col("lo").alias("a"), F.col("hi").alias("b"))
    copies = mixed.join(many, ["owner", "seg"]).select("k1", "k2", F.col("lo").alias("a"), F.col("hi").alias("b"))
    wanted = (
        sets.select("one.*", "owner").groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi", "at", "owner")).alias("segs"))
    )
    # Rows alike repeat each other, so a second copy adds nothing.
    texts = packed(docs, "text", "k1", "k2").dropDuplicates(["k1", "k2"])
    blocks = materialise(block_rows(texts.join(wanted, ["k1", "k2"]), unit), "blocks")
    hot = materialise(blocks.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > most).select("group"), "hot")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cold = blocks.join(hot, "group", "left_anti").repartition(parts, "group").sortWithinPartitions("group")
    found = solved(cold, unit, solver)
    rest = counted(blocks.join(hot, "group", "left_semi"), unit)
    return whole.unionAll(copies).unionAll(found).unionAll(rest)
