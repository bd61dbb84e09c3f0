"""Substring dedup: words covered by a long run of words that also starts elsewhere.

The strings of one group (see ``repeats``) are a reference shard. Its suffix automaton,
with the number of places of every state, is built once, and all strings of the
documents in the shard are streamed through it: the matching statistic at a
word is the longest stretch ending there that stands at two places or more. A
shard is sent where its documents are by a shuffle, not broadcast: the shards
of a corpus together have no size bound, each alone has.

Defined cases: null and empty texts have no words; a text of fewer than ``width``
words is never cut; rows alike in id and text repeat each other; an empty
table gives no rows; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import repeats
from .suffix_dedup import covered
from .tasks import arrow_map

_CORE = -1
MOST = 4096  # strings of one automaton


class SuffixAutomaton:
    """Automaton of several strings; ``places`` counts where a state's stretches end."""

    def __init__(self, strings: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.places = [-1], [0], [0]
        for string in strings:
            last = 0
            for symbol in string:
                last = self._add(last, symbol)
                self.places[last] += 1
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.places[self.link[state]] += self.places[state]

    def _state(self, moves: dict[int, int], link: int, size: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.size.append(size)
        self.places.append(0)
        return len(self.size) - 1

    def _clone(self, origin: int, target: int, symbol: int) -> int:
        clone = self._state(dict(self.next[target]), self.link[target], self.size[origin] + 1)
        self.link[target] = clone
        while origin >= 0 and self.next[origin].get(symbol) == target:
            self.next[origin][symbol] = clone
            origin = self.link[origin]
        return clone

    def _add(self, last: int, symbol: int) -> int:
        known = self.next[last].get(symbol)
        if known is not None:  # an earlier string had this prefix
            return known if self.size[known] == self.size[last] + 1 else self._clone(last, known, symbol)
        state = self._state({}, 0, self.size[last] + 1)
        origin = last
        while origin >= 0 and symbol not in self.next[origin]:
            self.next[origin][symbol] = state
            origin = self.link[origin]
        if origin >= 0:
            target = self.next[origin][symbol]
            fits = self.size[target] == self.size[origin] + 1
            self.link[state] = target if fits else self._clone(origin, target, symbol)
        return state

    def matches(self, string: list[int], least: int = 2) -> Iterator[int]:
        """For each end, the length of the longest stretch that stands at ``least`` places."""
        state = length = 0
        for symbol in string:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            step = self.next[state].get(symbol)
            if step is not None:
                state, length = step, length + 1
                while state and self.places[state] < least:
                    state = self.link[state]
                    length = self.size[state]
            yield length


def automaton_repeats(
    group: np.ndarray, left: list[np.ndarray], right: list[np.ndarray], window: int
) -> tuple[np.ndarray, np.ndarray]:
    """Strings and starts of their ``window``-symbol stretches that occur twice in a group."""
    found, starts = [], []
    order = np.argsort(group, kind="stable")
    for shard in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        strings = [[*left[i].tolist(), _CORE, *right[i].tolist()] for i in shard]
        automaton = SuffixAutomaton(strings)
        for i, string in zip(shard.tolist(), strings, strict=True):
            for end, length in enumerate(automaton.matches(string)):
                if length >= window:
                    found.append(i)
                    starts.append(end + 1 - window)
    return np.array(found, dtype=np.int64), np.array(starts, dtype=np.int64)


def unit(width: int) -> repeats.Unit:
    return repeats.Unit("words", width, k=max(1, min(8, width // 3)), block=max(2, min(8, width // 2)))


def remove_repeated_words(
    docs: DataFrame, width: int = 35, column: str = "text", id_column: str = "doc_id", most: int = MOST
) -> DataFrame:
    """Further columns of ``docs`` as struct ``doc``; kept (text), n_words, n_removed, spans of words."""
    key = repeats.key_columns(F.col(id_column), F.col(column))
    body = docs.select(*key, F.col(column).alias("text"))
    starts = repeats.repeated_starts(body, unit(width), automaton_repeats, most)
    # A set: rows alike in id and text share a key, and each has all of their repeats.
    per_doc = starts.groupBy("k1", "k2").agg(F.collect_set(F.struct("a", "b")).alias("runs"))
    rows = docs.select(
        *key,
        F.struct(*[F.col(c) for c in docs.columns if c != column]).alias("doc"),
        F.col(column).alias("body"),
    )
    joined = repeats.packed(rows, "body", "k1", "k2", "doc").join(per_doc, ["k1", "k2"], "left").select("doc", "z", "runs")
    doc_type = joined.schema["doc"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, removed, spans, kept = [], [], [], []
            for z, runs in zip(batch.column("z").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                found = repeats.unsqueeze(z).split()  # at the separators of text.SPACE
                n = len(found)
                mine = covered([(r["a"], r["b"] + width) for r in runs or ()])
                inside = np.zeros(n, dtype=bool)
                for a, b in mine:
                    inside[a:b] = True
                kept.append(b" ".join(compress(found, (~inside).tolist())))
                words.append(n)
                removed.append(int(inside.sum()))
                spans.append([{"start": a, "stop": b} for a, b in mine])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(words, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                ],
                ["doc", "kept", "n_words", "n_removed", "spans"],
            )

    return arrow_map(
        joined,
        cut,
        f"doc {doc_type}, kept string, n_words long, n_removed long, spans array<struct<start:bigint,stop:bigint>>",
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` covered by 35 consecutive words that also start elsewhere."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeated_words(docs, 35).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
