"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text.

Tokenizer A is byte-level BPE, B a sentence-piece model with byte fallback; both read a space and the text. The
libraries' own spans (character offsets of A, the pieces' offsets of B) are the coarse cuts. Where several tokens share a
character, or a character is spelt by fallback bytes, the decoded bytes of the tokens refine the cuts, and everywhere
they confirm them: a text whose tokens do not give back its bytes has no tokens.

A text is aligned in units that end before a space or line feed that follows a visible character. Neither vocabulary
has a token across such a place (B's pieces are searched for one; if there were one, texts stay whole), so tokens of
units are tokens of the text. Each unit that a block of documents has is aligned once.

How often documents link a pair of ids is summed over the whole corpus. Blocks of documents (``BLOCK`` bytes of text, a
longer text stands alone) get back the sums of the pairs they hold and nothing else, by joins; no table of all pairs
is held anywhere.

Defined cases: null and empty texts, and texts that do not survive a tokenizer, have no tokens: zeros and no groups;
repeated rows are documents of their own and count each; ties of the highest count all count; an empty table gives no
rows; further columns pass through inside struct ``doc``, whatever their names.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .bpe import byte_characters, gathered
from .tasks import arrow_map, release, small_batches
from .text import buffers
from .text import runs as text_runs

BLOCK = 8 << 20  # bytes of text whose documents share a table of units
PART = 1 << 19  # characters or units of a block's documents that are taken apart at a time
ROWS = 100_000  # documents of a block at most
CUT = re.compile(r"(?<=\S)(?=[ \n])")
TOGETHER = 100  # units given to a library as one text; its work on a text grows faster than the text
UNITS = 256 * TOGETHER  # units whose tokens are held together; runs of ``TOGETHER`` end there in any case
AT_ONCE = 64  # such texts whose tokens are checked together
SPACE = "▁"


class Entries:
    """Bytes of every id of a vocabulary, one after another."""

    def __init__(self, entries: list[bytes]):
        self.bytes = np.frombuffer(b"".join(entries), dtype=np.uint8)
        self.sizes = np.array([len(e) for e in entries], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def spelt(self, ids: np.ndarray) -> np.ndarray:
        return gathered(self.bytes, self.starts[ids], self.sizes[ids])


class Tokens:
    """Tokens of a list of units: ids, the end of each in bytes from the list's start, and the unit of each."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, right: np.ndarray, stops: np.ndarray):
        self.ids, self.ends, self.right = ids, ends, right
        self.unit = np.searchsorted(stops, ends, side="left")


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def refined(decoded: np.ndarray, offered: np.ndarray, sure: np.ndarray) -> np.ndarray:
    """Ends of tokens: the library's where ``sure``, and from the last sure one on by decoded bytes elsewhere."""
    last = np.maximum.accumulate(np.where(sure, np.arange(len(sure)), -1))
    at = np.maximum(last, 0)
    base = np.where(last >= 0, offered[at] - decoded[at], 0)
    return np.where(sure, offered, base + decoded)


class Aligner:
    """Both tokenizers."""

    def __init__(self, spec: str, proto: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        model = json.loads(spec)
        size = max([*model["model"]["vocab"].values(), *(t["id"] for t in model["added_tokens"])]) + 1
        to_byte = {c: b for b, c in enumerate(byte_characters())}
        entries = [b""] * size
        for token, number in model["model"]["vocab"].items():
            if all(c in to_byte for c in token):
                entries[number] = bytes(to_byte[c] for c in token)
        self.a_entries = Entries(entries)

        self.b = SentencePieceProcessor(model_proto=proto)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_entries = Entries(
            [
                b"" if self.b.is_control(i) or self.b.is_unknown(i) else bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                for i, p in enumerate(pieces)
            ]
        )
        across = re.compile(rf"[^{SPACE} ][{SPACE} ]|.\n", re.DOTALL)
        self.cut = None if any(across.search(p) for p in pieces) else CUT
        sides = [[f"{i}{end}" for i in range(len(e.sizes)) for end in (",", "|" if e is self.a_entries else ";", "")] for e in (self.a_entries, self.b_entries)]
        self.written = [np.array(s, dtype=object) for s in sides]

    def units(self, text: str) -> list[str]:
        full = " " + text
        return self.cut.split(full) if self.cut else [full]

    def _runs(self, units: list[str]) -> list[tuple[int, int]]:
        """Stretches of units that may be given to the libraries as one text: only the last may end in white space."""
        n = len(units)
        if not self.cut:
            return [(i, i + 1) for i in range(n)]
        closed = np.array([u[-1:].isspace() for u in units], dtype=bool)
        ends = distinct(np.concatenate([np.flatnonzero(closed) + 1, np.arange(TOGETHER, n, TOGETHER), [n]])) if n else np.empty(0, np.int64)
        return list(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=False))

    def tokens(self, units: list[str], stops: np.ndarray) -> tuple[Tokens, Tokens]:
        """Tokens of all units by A and by B; ``stops``: the units' ends in bytes. Texts given start with the word x."""
        lead = " x" if self.cut else ""
        out = []
        for spans, entries in ((self._spans_a, self.a_entries), (self._spans_b, self.b_entries)):
            found = []
            bounds = self._runs(units)
            while bounds:
                alone = []
                for start in range(0, len(bounds), AT_ONCE):
                    some = bounds[start : start + AT_ONCE]
                    texts = [lead + "".join(units[i:j]) for i, j in some]
                    raw = [t.encode() for t in texts]
                    at = np.cumsum([0, *map(len, raw)])
                    ids, counts, low, high = spans(texts, raw, at)
                    text_of = np.repeat(np.arange(len(some)), counts)
                    decoded = np.cumsum(entries.sizes[ids])
                    cuts = np.concatenate([[0], decoded])[np.concatenate([[0], np.cumsum(counts)])]  # of the texts in what is spelt
                    decoded = decoded - (cuts[:-1] - at[:-1])[text_of]
                    # A cut that the library gives between two characters is sure; inside a character it gives none.
                    other = np.append(text_of[1:] != text_of[:-1], True)[: len(ids)]
                    sure = other | (np.append(low[1:], 0)[: len(ids)] == high)
                    sure &= np.diff(high, prepend=0) > 0
                    ends = refined(decoded, high, sure)
                    spelt = entries.spelt(ids).tobytes()
                    right = np.array([spelt[x:y] == r for x, y, r in zip(cuts[:-1].tolist(), cuts[1:].tolist(), raw, strict=True)])
                    right[text_of[ends != decoded]] = False
                    for k in np.flatnonzero(~right).tolist():
                        if some[k][1] - some[k][0] > 1:  # one unit that does not survive costs the others nothing
                            alone += [(x, x + 1) for x in range(*some[k])]
                    first = np.array([i for i, _ in some])
                    begin = np.append(0, stops)[first]
                    ends = ends - (at[:-1] + len(lead) - begin)[text_of]
                    # Without its own bytes a unit has no ends; its tokens are put at its end.
                    ends = np.where(right[text_of], ends, stops[[j - 1 for _, j in some]][text_of])
                    again = ~right & np.array([j - i > 1 for i, j in some])
                    keep = ~again[text_of] & ~(right[text_of] & (ends <= begin[text_of]))
                    found.append((first[text_of][keep], ids[keep], ends[keep], right[text_of][keep]))
                bounds = alone
            start, ids, ends, right = [np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in range(4)]
            order = np.argsort(start, kind="stable")
            out.append(Tokens(ids[order], ends[order], right[order].astype(bool), stops))
        return out[0], out[1]

    def _spans_a(self, texts: list[str], raw: list[bytes], at: np.ndarray) -> tuple[np.ndarray, ...]:
        """ids of all texts, their number in each, first and last byte + 1 of each, counted from the first text on."""
        encoded = [self.a.encode(t, add_special_tokens=False) for t in texts]
        ids = [e.ids for e in encoded]
        counts = np.array([len(i) for i in ids], dtype=np.int64)
        total = int(counts.sum())
        offsets = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in encoded)), np.int64, 2 * total).reshape(-1, 2)
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        byte = np.append(np.flatnonzero((flat & 0xC0) != 0x80), len(flat))  # characters' first bytes
        offsets += np.repeat(np.cumsum([0, *map(len, texts)])[:-1], counts)[:, None]
        return np.fromiter(chain.from_iterable(ids), np.int64, total), counts, byte[offsets[:, 0]], byte[offsets[:, 1]]

    def _spans_b(self, texts: list[str], raw: list[bytes], at: np.ndarray) -> tuple[np.ndarray, ...]:
        """The model puts a space before a text, so the text's own first space is left to it."""
        found = [self._pieces(t[1:]) for t in texts]
        counts = np.array([len(f) for f in found], dtype=np.int64)
        total = int(counts.sum())
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(found)), np.int64, 3 * total).reshape(-1, 3)
        base = np.repeat(at[:-1], counts)
        return spans[:, 0], counts, spans[:, 1] + base + 1, spans[:, 2] + base + 1

    def _pieces(self, text: str) -> list[tuple[int, int, int]]:
        """(id, first byte, last byte + 1) of the pieces, as the library's proto gives them."""
        if not text:
            # The library gives no piece for an empty text; its added space is the piece of a space.
            return [(self.b.piece_to_id(SPACE), -1, 0)]
        try:
            proto = self.b.encode(text, return_type="proto")
        except TypeError:  # a version that still has the immutable proto, whose spans count characters
            proto = self.b.encode(text, out_type="immutable_proto")
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw)).tolist()
            return [(p.id, at[p.begin], at[p.end]) for p in proto.pieces]
        return [(p.id, p.begin, p.end) for p in proto.pieces]

    def align(self, units: list[str]) -> Aligned:
        return Aligned(self, units)


class Aligned:
    """Units and what covers them; per unit: right or not, tokens of A and B, groups, links and the groups as text."""

    def __init__(self, aligner: Aligner, units: list[str]):
        n = len(units)
        stops = np.cumsum([len(u.encode()) for u in units]) if n else np.empty(0, np.int64)
        a, b = aligner.tokens(units, stops)
        self.right = np.ones(n, dtype=bool)
        ended = np.zeros(n, dtype=bool)
        for side in (a, b):
            self.right[side.unit[~side.right & (side.unit < n)]] = False
            ended[:] = False
            ended[np.searchsorted(stops, side.ends[np.isin(side.ends, stops)])] = True
            self.right &= ended
        for side in (a, b):
            keep = np.append(self.right, False)[side.unit]
            side.ids, side.ends, side.unit = side.ids[keep], side.ends[keep], side.unit[keep]
        self.a, self.b = a, b
        common = a.ends[np.isin(a.ends, b.ends, assume_unique=True, kind="sort")]
        segments = distinct(np.concatenate([a.ends, b.ends]))  # each is covered by one token of A and one of B: a link
        self.link_a = a.ids[np.searchsorted(a.ends, segments)]
        self.link_b = b.ids[np.searchsorted(b.ends, segments)]
        link_unit = np.searchsorted(stops, segments)
        self.links = np.bincount(link_unit, minlength=n)
        self.n_a, self.n_b = np.bincount(a.unit, minlength=n), np.bincount(b.unit, minlength=n)
        self.n_groups = np.bincount(np.searchsorted(stops, common), minlength=n)
        self.groups = self._text(aligner, common, n)

    def _text(self, aligner: Aligner, common: np.ndarray, n: int) -> list[str]:
        parts, group, unit = [], [], []
        for side, written in ((self.a, aligner.written[0]), (self.b, aligner.written[1])):
            number = np.searchsorted(common, side.ends)
            closes = np.isin(side.ends, common)
            sign = closes.astype(np.int64)
            if side is self.b:  # nothing follows the last group of a unit
                last = np.append(side.unit[1:] != side.unit[:-1], True) if len(side.unit) else np.empty(0, bool)
                sign[last] = 2
            parts.append(written[3 * side.ids + sign])
            group.append(2 * number + (side is self.b))
            unit.append(side.unit)
        order = np.argsort(np.concatenate(group), kind="stable")
        flat = np.concatenate(parts)[order].tolist()
        cuts = np.searchsorted(np.concatenate(unit)[order], np.arange(n + 1)).tolist()
        return ["".join(flat[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


class Together:
    """What is kept of alignments of consecutive units, without their tokens."""

    def __init__(self, parts: Iterator[Aligned]):
        kept = [(p.right, p.n_a, p.n_b, p.n_groups, p.links, (p.link_a << 32) | p.link_b, p.groups) for p in parts]
        self.right, self.n_a, self.n_b, self.n_groups, self.links, self.pairs = (np.concatenate(c) for c in list(zip(*kept, strict=True))[:6])
        self.groups = list(chain.from_iterable(k[6] for k in kept))


@lru_cache(maxsize=1)
def aligner(spec: str, proto: bytes) -> Aligner:
    return Aligner(spec, proto)


def public_models(a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> tuple[str, bytes]:
    """Both vocabulary files, read on the driver and sent to the tasks (1.9 MB)."""
    import public_tokenizers

    with open(public_tokenizers.path(a), encoding="utf-8") as f, open(public_tokenizers.path(b), "rb") as g:
        return f.read(), g.read()


def _parts(sizes: list[int], part: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of documents of a block that are worked on together, ``PART`` characters or units or one document each."""
    return text_runs(np.cumsum([0, *sizes]), part or PART)


def block_of(aligned_by: Aligner, texts: list[str | None], keep_groups: bool) -> dict:
    """All of a block in one piece; see ``pieces_of``."""
    return next(pieces_of(aligned_by, texts, keep_groups, 1 << 62))[2]


def pieces_of(aligned_by: Aligner, texts: list[str | None], keep_groups: bool, part: int | None = None) -> Iterator[tuple[int, int, dict]]:
    """Alignment of some documents, their units, and the id pairs they link with the number of documents of each.

    Units are aligned for all of them; what is found is given for a few documents (from, to) at a time, as rows that are
    joined later should be small.
    """
    number: dict[str, int] = {}
    sizes, sequence = np.zeros(len(texts), dtype=np.int64), []
    for i, j in _parts([len(t or "") for t in texts]):  # units as strings take many times the text's bytes
        rows = [aligned_by.units(t) if t else [] for t in texts[i:j]]
        for unit in dict.fromkeys(chain.from_iterable(rows)):
            number.setdefault(unit, len(number))
        sizes[i:j] = [len(r) for r in rows]
        sequence.append(np.fromiter(map(number.__getitem__, chain.from_iterable(rows)), np.int64, int(sizes[i:j].sum())))
        del rows
    known = list(number)
    sequence = np.concatenate(sequence) if sequence else np.empty(0, np.int64)
    del number
    found = Together(aligned_by.align(known[i : i + UNITS]) for i in range(0, max(len(known), 1), UNITS))
    doc = np.repeat(np.arange(len(texts)), sizes)
    fine = np.ones(len(texts), dtype=bool)
    fine[doc[~found.right[sequence]]] = False
    fine &= sizes > 0
    sequence, doc = sequence[fine[doc]], doc[fine[doc]]
    totals = {c: np.bincount(doc, getattr(found, c)[sequence], len(texts)).astype(np.int64) for c in ("n_a", "n_b", "n_groups")}
    totals["n_links"] = np.bincount(doc, found.links[sequence], len(texts)).astype(np.int64)
    unit_stops = np.searchsorted(doc, np.arange(1, len(texts) + 1))
    groups, cuts = np.array([*found.groups, None], dtype=object), [0, *unit_stops.tolist()]
    kept, digests = [], []
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        text = ";".join(groups[sequence[i:j]].tolist())
        kept.append(text if keep_groups else None)
        digests.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
    del groups, found.groups
    pairs, place = np.unique(found.pairs, return_inverse=True)
    stops = np.cumsum(found.links)
    for i, j in _parts(np.diff(unit_stops, prepend=0).tolist(), part):
        first, last = cuts[i], cuts[j]
        # The units and pairs of these documents, numbered anew.
        units, its_units = _numbered(sequence[first:last], len(known))
        links, its_pairs = _numbered(gathered(place, stops[units] - found.links[units], found.links[units]), len(pairs))
        ends = np.cumsum(found.links[units])
        # Each document's distinct units, then its distinct pairs.
        once = distinct(doc[first:last] * max(len(units), 1) + its_units)
        unit, holder = once % max(len(units), 1), once // max(len(units), 1)
        held = gathered(its_pairs, ends[unit] - found.links[units[unit]], found.links[units[unit]])
        held = distinct(np.repeat(holder, found.links[units[unit]]) * max(len(links), 1) + held)
        yield i, j, {
            **{c: totals[c][i:j] for c in totals},
            "groups": kept[i:j],
            "groups_sha256": digests[i:j],
            "units": _short(its_units, len(units)),
            "unit_stops": (unit_stops[i:j] - first).astype("<i8").tobytes(),
            "links": _short(its_pairs, len(links)),
            "link_stops": ends.astype("<u4").tobytes(),
            "pairs": pairs[links].astype("<i8").tobytes(),
            "holders": np.bincount(held % max(len(links), 1), minlength=len(links))[: len(links)].astype("<i8").tobytes(),
        }


def _numbered(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values below ``most``, and each value's number among them."""
    there = np.zeros(most, dtype=bool)
    there[values] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[values]


def _short(numbers: np.ndarray, several: int) -> bytes:
    """Numbers below ``several`` in two bytes each if they fit, else in four; see ``_long``."""
    return numbers.astype("<u2" if several <= 1 << 16 else "<u4").tobytes()


def _long(numbers: bytes, several: int) -> np.ndarray:
    return np.frombuffer(numbers, "<u2" if several <= 1 << 16 else "<u4").astype(np.int64)


def gathered_batches(batches: Iterator[pa.RecordBatch], limit: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Rows of small batches in blocks of at most ``limit`` bytes of ``body`` and ``rows`` rows; a longer text stands alone.

    No more than a block and a batch are held, however many rows a task reads.
    """
    held: list[pa.RecordBatch] = []
    size = count = 0
    for batch in batches:
        sizes = np.diff(buffers(batch.column("body"))[1])
        start = 0
        while start < batch.num_rows:
            room = np.searchsorted(np.cumsum(sizes[start : start + rows - count]), limit - size, side="right")
            if not room and held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size, count = [], 0, 0
                continue
            stop = start + max(int(room), 1)
            held.append(batch.slice(start, stop - start))
            size, count, start = size + int(sizes[start:stop].sum()), count + stop - start, stop
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


PER_DOC = ("n_a", "n_b", "n_groups", "n_links")
BYTES = ("units", "unit_stops", "links", "link_stops", "pairs", "holders")


def aligned_blocks(
    docs: DataFrame, models: tuple[str, bytes], column: str = "text", keep_groups: bool = False, limit: int = BLOCK
) -> DataFrame:
    """One written row per few documents of a block: their other columns, their alignment, and what links they hold.

    ``keep_groups`` also keeps every document's groups as text (``a1,a2|b1;a3|b2``), not only their digest.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(*shared.value)
        number = TaskContext.get().partitionId() << 32
        for block in gathered_batches(batches, limit, ROWS):
            gc.disable()  # millions of small tuples, none in a cycle
            try:
                for i, j, found in pieces_of(both, block.column("body").to_pylist(), keep_groups):
                    whole = pa.array([0, j - i], pa.int32())
                    columns = [pa.array([number], pa.int64()), pa.ListArray.from_arrays(whole, block.column("doc").slice(i, j - i))]
                    columns += [pa.ListArray.from_arrays(whole, pa.array(found[c], pa.int64())) for c in PER_DOC]
                    columns += [pa.ListArray.from_arrays(whole, pa.array(found[c], pa.string())) for c in ("groups", "groups_sha256")]
                    columns += [pa.array([found[c]], pa.binary()) for c in BYTES]
                    yield pa.RecordBatch.from_arrays(columns, ["block", "docs", *PER_DOC, "groups", "groups_sha256", *BYTES])
                    number += 1
            finally:
                gc.enable()
            del found, columns, block
            release()  # before the next block: what one has freed is else kept beside what the next one takes

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != column] or [F.lit(1).alias("one")]).alias("doc"),
        F.col(column).alias("body"),
    )
    schema = T.StructType().add("block", "long").add("docs", T.ArrayType(rows.schema["doc"].dataType))
    for c in (*PER_DOC, "groups", "groups_sha256"):
        schema.add(c, T.ArrayType(T.LongType() if c in PER_DOC else T.StringType()))
    for c in BYTES:
        schema.add(c, "binary")
    return materialise(arrow_map(rows, run, schema), "aligned")


def held_pairs(blocks: DataFrame) -> DataFrame:
    """(block, a, b, docs): how many documents of a block link the ids a and b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, holders in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "holders")), strict=True):
                keys, docs = np.frombuffer(pairs, "<i8"), np.frombuffer(holders, "<i8")
                keys, docs = keys[docs > 0], docs[docs > 0]
                for i in range(0, len(keys), 10_000):
                    k = keys[i : i + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(k), block)), pa.array((k >> 32).astype(np.int32)), pa.array((k & 0xFFFFFFFF).astype(np.int32)), pa.array(docs[i : i + 10_000])],
                        ["block", "a", "b", "docs"],
                    )

    return arrow_map(blocks.select("block", "pairs", "holders"), run, "block long, a int, b int, docs long")


def link_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, docs, highest): documents corpus-wide that link a and b, and whether no other b has more for this a."""
    totals = materialise(held_pairs(blocks).groupBy("a", "b").agg(F.sum("docs").alias("docs")), "link-counts")
    most = totals.groupBy("a").agg(F.max("docs").alias("most"))
    return totals.join(most, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("highest"))


def document_links(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document: struct ``doc``, tokens, groups and links, ``n_best`` and ``count_sum`` from the corpus-wide counts."""
    # One number per pair: the count, with the flag in its lowest bit.
    value = F.col("counts.docs") * 2 + F.col("counts.highest").cast("long")
    sums = (
        held_pairs(blocks).alias("held").join(counts.alias("counts"), ["a", "b"])
        .groupBy("block").agg(F.collect_list(F.struct((F.col("a").cast("long") * (1 << 32) + F.col("b")).alias("k"), value.alias("v"))).alias("sums"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda c, row=row: batch.column(c)[row].as_py()
                pairs, stops = np.frombuffer(get("pairs"), "<i8"), np.frombuffer(get("link_stops"), "<u4").astype(np.int64)
                links, sequence = _long(get("links"), len(pairs)), _long(get("units"), len(stops))
                value = np.zeros(len(pairs), dtype=np.int64)
                got = batch.column("sums")[row].values
                if got is not None and len(got):
                    value[np.searchsorted(pairs, got.field("k").to_numpy())] = got.field("v").to_numpy()
                before = np.concatenate([[0], stops])
                per_unit = []
                for of_pair in (value & 1, value >> 1):
                    sums = np.concatenate([[0], np.cumsum(of_pair[links])])
                    per_unit.append(sums[before[1:]] - sums[before[:-1]])
                ends = np.concatenate([[0], np.frombuffer(get("unit_stops"), "<i8")])
                out = []
                for of_unit in per_unit:
                    sums = np.concatenate([[0], np.cumsum(of_unit[sequence])])
                    out.append(pa.array(sums[ends[1:]] - sums[ends[:-1]]))
                columns = [batch.column(c)[row].values for c in ("docs", *PER_DOC, "groups", "groups_sha256")]
                yield pa.RecordBatch.from_arrays([*columns, *out], ["doc", *PER_DOC, "groups", "groups_sha256", "n_best", "count_sum"])

    schema = T.StructType().add("doc", blocks.schema["docs"].dataType.elementType)
    for c in (*PER_DOC, "groups", "groups_sha256", "n_best", "count_sum"):
        schema.add(c, "string" if c.startswith("groups") else "long")
    wanted = ["docs", *PER_DOC, "groups", "groups_sha256", "units", "unit_stops", "links", "link_stops", "pairs"]
    return arrow_map(blocks.join(sums, "block", "left").select(*wanted, "sums"), run, schema)


def alignment(docs: DataFrame, models: tuple[str, bytes], column: str = "text", keep_groups: bool = True, limit: int = BLOCK) -> DataFrame:
    """Alignment of every document with counts over all of them; see ``document_links``."""
    blocks = aligned_blocks(docs, models, column, keep_groups, limit)
    return document_links(blocks, link_counts(blocks))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups, links and their corpus-wide counts for every text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return alignment(docs, public_models(), keep_groups=False).select(
        F.col("doc.doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
