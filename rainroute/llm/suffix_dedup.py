"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere.

The strings of a batch of groups (see ``repeats``) are sorted column by column, from
their last symbol to their first: each round inserts one symbol per string into
the collection's Burrows-Wheeler transform, group by group, and brings the common
prefixes of neighbours up to date. Only the transform and the prefix lengths are
kept between rounds; both are read and rewritten front to back. They are the external files of the
method, held in memory because a batch is bounded.

Defined cases: null and empty texts keep nothing and lose nothing; a text shorter
than ``width`` is never cut; rows alike in id and text repeat each other; an empty
table gives no rows; further columns pass through. A cut may split a UTF-8 character: the kept bytes
(``kept``) are exact, the kept text leaves out bytes that are no character any more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import repeats
from .tasks import arrow_map

_CORE = 0xFE  # UTF-8 has no byte above 0xF4
_GROUPS = 256  # collections side by side: group and symbol fit 16 bits


def collection_repeats(
    group: np.ndarray, left: list[np.ndarray], right: list[np.ndarray], window: int
) -> tuple[np.ndarray, np.ndarray]:
    """Strings and starts of their ``window``-symbol stretches that occur twice in a group."""
    strings, starts = [], []
    order = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.diff(group[order], prepend=-1))
    for at in range(0, len(edges), _GROUPS):
        stop = edges[at + _GROUPS] if at + _GROUPS < len(edges) else len(order)
        mine = order[edges[at] : stop]
        local = (np.searchsorted(edges, np.arange(edges[at], stop), side="right") - 1 - at).astype(np.uint16)
        s, t = _collections(local, [left[i] for i in mine], [right[i] for i in mine], window)
        strings.append(mine[s])
        starts.append(t)
    return np.concatenate(strings), np.concatenate(starts)


def _collections(group: np.ndarray, left: list[np.ndarray], right: list[np.ndarray], window: int):
    m = len(group)
    sizes_left, sizes_right = (np.array([len(x) for x in side]) for side in (left, right))
    length = sizes_left + 1 + sizes_right
    columns = np.zeros((int(length.max()) + 1, m), dtype=np.uint8)  # row j: j-th symbol from the end; 0: none
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        columns[: len(b), i] = b[::-1] + 1
        columns[len(b), i] = _CORE
        columns[len(b) + 1 : len(b) + 1 + len(a), i] = a[::-1] + 1
    strings = np.bincount(group)
    high = group << np.uint16(8)
    code = high | columns[0]  # the transform: group and the symbol before each suffix
    common = np.zeros(m, dtype=np.int16)  # symbols shared with the suffix above
    place = np.arange(m)  # of each string's latest suffix
    live = np.arange(m)
    for j in range(1, int(length.max()) + 1):
        place, live = place[length[live] >= j], live[length[live] >= j]
        target, order, rank = _mapping(code, strings)
        # Where the new suffixes go: after all smaller ones of their group.
        to = target[place]
        r = rank[place]
        own = code[place]
        above, below = order[np.maximum(r - 1, 0)], order[np.minimum(r + 1, len(order) - 1)]
        has_above, has_below = (r > 0) & (code[above] == own), (r + 1 < len(order)) & (code[below] == own)
        grown = len(code) + len(live)
        # New suffixes are shifted by those of this round that stand before them: target counts all of them.
        keep = np.ones(grown, dtype=bool)
        keep[to] = False
        new_code = np.empty(grown, dtype=np.uint16)
        new_code[keep] = code
        new_code[to] = high[live] | columns[j, live]
        new_common = np.empty(grown, dtype=np.int16)
        new_common[keep] = common
        new_common[to] = 0
        new_common[to[has_above]] = 1 + _least(common, above[has_above] + 1, place[has_above] + 1)
        new_common[to[has_below] + 1] = 1 + _least(common, place[has_below] + 1, below[has_below] + 1)
        code, common, place = new_code, new_common, to
    return _read_off(code, common, strings, length, window)


def _mapping(code: np.ndarray, strings: np.ndarray):
    """For each suffix, where the suffix one symbol longer stands when all of them are in.

    Also the suffixes by (group, symbol), and each one's rank in that order.
    """
    order = np.argsort(code, kind="stable")
    rank = np.empty(len(code), dtype=np.int64)
    rank[order] = np.arange(len(code))
    group = code >> np.uint16(8)
    ends = np.bincount(group[(code & np.uint16(0xFF)) == 0], minlength=len(strings))  # those with no longer suffix
    before = np.cumsum(strings) - np.cumsum(ends)  # empty suffixes of groups so far, less whole strings
    return rank + before[group], order, rank


def _least(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Minimum of values[start:stop] for many non-empty ranges."""
    if not len(start):
        return np.empty(0, dtype=values.dtype)
    padded = np.append(values, np.int16(0))
    order = np.argsort(start, kind="stable")  # else the gaps between ranges would be long
    out = np.empty(len(start), dtype=values.dtype)
    out[order] = np.minimum.reduceat(padded, np.column_stack([start[order], stop[order]]).ravel())[::2]
    return out


def _read_off(code, common, strings, length, window):
    """Walk every string through the finished transform and note its repeated stretches."""
    twice = common >= window
    twice[:-1] |= common[1:] >= window
    target, _, _ = _mapping(code, strings)
    base = np.flatnonzero(np.diff((code >> np.uint16(8)).astype(np.int64), prepend=-1))
    m = len(length)
    group = np.repeat(np.arange(len(strings)), strings)
    place = base[group] + np.arange(m) - (np.cumsum(strings) - strings)[group]
    live, found, starts = np.arange(m), [], []
    for j in range(1, int(length.max()) + 1):
        keep = length[live] >= j
        place, live = target[place[keep]], live[keep]
        if j >= window:
            hit = live[twice[place]]
            found.append(hit)
            starts.append(length[hit] - j)
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(starts)


def unit(width: int) -> repeats.Unit:
    return repeats.Unit("bytes", width, k=min(32, max(1, width // 4)), block=max(2, min(64, width // 4)))


def remove_repeats(docs: DataFrame, width: int = 400, column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Further columns of ``docs`` as struct ``doc``; kept (bytes), kept_text, was_null, n_bytes, n_removed, spans.

    ``spans``: start and stop of each maximal removed run, in bytes of the text.
    """
    key = repeats.key_columns(F.col(id_column), F.col(column))
    body = docs.select(*key, F.col(column).alias("text"))
    starts = repeats.repeated_starts(body, unit(width), collection_repeats)
    # A set: rows alike in id and text share a key, and each has all of their repeats.
    per_doc = starts.groupBy("k1", "k2").agg(F.collect_set(F.struct("a", "b")).alias("runs"))
    rows = docs.select(
        *key,
        F.struct(*[F.col(c) for c in docs.columns if c != column]).alias("doc"),
        F.col(column).isNull().alias("was_null"),
        F.col(column).alias("body"),
    )
    texts = repeats.packed(rows, "body", "k1", "k2", "doc", "was_null")
    joined = texts.join(per_doc, ["k1", "k2"], "left").select("doc", "was_null", "z", "runs")
    doc_type = joined.schema["doc"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, spans, kept = [], [], [], []
            for z, runs in zip(batch.column("z").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                body = repeats.unsqueeze(z)
                mine = covered([(r["a"], r["b"] + width) for r in runs or ()])
                parts, at = [], 0
                for a, b in mine:
                    parts.append(body[at:a])
                    at = b
                kept.append(b"".join([*parts, body[at:]]))
                size.append(len(body))
                removed.append(sum(b - a for a, b in mine))
                spans.append([{"start": a, "stop": b} for a, b in mine])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("was_null"),
                    pa.array(kept, pa.binary()),
                    pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()),
                    pa.array(size, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                ],
                ["doc", "was_null", "kept", "kept_text", "n_bytes", "n_removed", "spans"],
            )

    counts = "n_bytes long, n_removed long, spans array<struct<start:bigint,stop:bigint>>"
    return arrow_map(joined, cut, f"doc {doc_type}, was_null boolean, kept binary, kept_text string, {counts}")


def covered(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open stretches, as maximal runs in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of ``documents`` covered by a 400-byte string that also starts elsewhere."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, 400).select(
        F.col("doc.doc_id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
