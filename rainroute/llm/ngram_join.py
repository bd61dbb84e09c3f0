"""N-gram Jaccard join: documents whose sets of word shingles are alike, and their components.

The matrix of documents by shingles is multiplied with its transpose, block by block: a
block holds the shingles of a hash range, in it the documents of a shingle meet, and the
products, one per pair and shingle, are added up over all blocks. Only the columns
that can decide a pair are multiplied: a document of n shingles can be alike
only to one that shares one of its first n - ceil(0.75 n) + 1 in a common order. Heavy
shingles come last in that order, so a passage that many documents share makes no
pairs unless they are made of it. A pair whose shared count cannot reach the
overlap that its sizes ask for is discarded; the full sets decide the others.

Documents with the same set are one row of the matrix. Components only need enough
links: first every document meets the first document of its column (linear in the rows),
then only pairs of columns whose components still differ are multiplied.

Defined cases: lower-cased words ``[^\\x20\\x09-\\x0D]+``; fewer words than a shingle make one
shingle; null and empty texts have none and are linked with nothing; rows alike are linked; a component of
null ids has a null id; an empty table gives no rows; further columns pass through. Sets and
shingles are told apart by hashes of 64 and 54 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainroute.session import materialise

from . import text
from .components import components
from .keys import picked
from .repeats import key_columns, packed, unsqueeze
from .tasks import arrow_map

WORDS = 5
HEAVY = 64  # documents from which a shingle is sorted last
HEAVY_MOST = 500_000  # heavy shingles sent to the tasks (4 MB): the heaviest; only the order depends on it
COUNTED = 1 << 21  # shingles a task counts at a time
HASH_BITS = 54  # of a shingle
ROWS = 1 << (64 - HASH_BITS)  # texts handled at a time


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, one after another, and offsets (rows + 1).

    At most ``ROWS`` rows: row and hash share 64 bits, so that one plain sort orders both.
    """
    body, at = text.LOWER[data[offsets[0] : offsets[-1]]], offsets - offsets[0]
    start, stop = text.word_bounds(body, at, text.SPACE)
    hashes = text.word_hashes(body, start, stop)
    bounds = text.word_counts(start, at)
    sums = text.prefix_sums(hashes)
    row = np.repeat(np.arange(len(at) - 1), np.diff(bounds))
    first = np.arange(len(hashes))
    last = np.minimum(first + words, bounds[row + 1])
    keep = (last - first == words) | (first == bounds[row])
    first, last, row = first[keep], last[keep], row[keep]
    found = text.stretch(sums, first, last) >> np.uint64(64 - HASH_BITS)
    packed = np.sort((row.astype(np.uint64) << np.uint64(HASH_BITS)) | found)
    new = np.ones(len(packed), dtype=bool)
    new[1:] = packed[1:] != packed[:-1]
    packed = packed[new]
    row = (packed >> np.uint64(HASH_BITS)).astype(np.int64)
    return packed & np.uint64((1 << HASH_BITS) - 1), np.searchsorted(row, np.arange(len(at)))


def set_hashes(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash per set; 0 for the empty set."""
    out = np.zeros(len(bounds) - 1, dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(text.mix(found), dtype=np.uint64)])
    size = np.diff(bounds)
    out[:] = text.mix(sums[bounds[1:]] - sums[bounds[:-1]] + size.astype(np.uint64))
    out[size == 0] = 0
    return out


def _sets_of(batch: pa.RecordBatch, column: str = "text"):
    """Row, sets, bounds and set hashes of pieces of a batch."""
    data, offsets = text.buffers(batch.column(column))
    for a, b in text.runs(offsets, most=ROWS):
        found, bounds = shingle_sets(data, offsets[a : b + 1])
        yield a, found, bounds, set_hashes(found, bounds)


def heavy_shingles(texts: DataFrame, least: int = HEAVY, most: int = HEAVY_MOST) -> np.ndarray:
    """Shingles of ``least`` or more documents, lightest first; counted per task, then summed.

    A shingle that a task's buffer holds once is left out of its sum, which
    can only make it count as light: the order of columns, never a result, depends on it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, found, _, _ in _sets_of(batch):
                held.append(found)
                size += len(found)
                if size >= COUNTED:
                    yield counts(held)
                    held, size = [], 0
        if held:
            yield counts(held)

    def counts(held: list[np.ndarray]) -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values[n > 1].view(np.int64)), pa.array(n[n > 1])], ["shingle", "n"])

    summed = arrow_map(texts, run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = summed.where(F.col("n") >= least).orderBy(F.desc("n"), "shingle").limit(most)
    # toArrow moves at most 4 MB of hashes.
    found = top.select("shingle").toArrow().column("shingle").to_numpy().view(np.uint64)
    return found[::-1].copy()


class Order:
    """The common order of shingles: light ones by hash, then the heavy ones, lightest first."""

    def __init__(self, heavy: np.ndarray):
        self.values, self.places = np.sort(heavy), np.argsort(heavy, kind="stable")

    def places_of(self, found: np.ndarray) -> np.ndarray:
        """Place as one number: the hash of a light shingle; above all hashes for a heavy one."""
        if not len(self.values):
            return found
        at = np.minimum(np.searchsorted(self.values, found), len(self.values) - 1)
        late = self.places[at].astype(np.uint64) + np.uint64(1 << HASH_BITS)
        return np.where(self.values[at] == found, late, found)


def deciding(found: np.ndarray, bounds: np.ndarray, order: Order):
    """The first n - ceil(0.75 n) + 1 shingles of every set in the common order: row, shingle, place."""
    size = np.diff(bounds)
    row = np.repeat(np.arange(len(size)), size)
    place = order.places_of(found)
    moved = np.flatnonzero(np.bincount(row, weights=place >> np.uint64(HASH_BITS), minlength=len(size)))
    if len(moved):  # only sets with heavy shingles have to be sorted again
        inside = np.isin(row, moved)
        again = np.flatnonzero(inside)[np.lexsort((place[inside], row[inside]))]
        found, place = found.copy(), place.copy()
        found[inside], place[inside] = found[again], place[again]
    n = size[row]
    keep = np.arange(len(found)) - bounds[row] < n - -(-3 * n // 4) + 1
    return row[keep], found[keep], place[keep]


def set_rows(docs: DataFrame, heavy: np.ndarray, column: str) -> DataFrame:
    """Key and id of every row, and of its set: hash (node), size, place of its last deciding shingle, light ones."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(shared.value)
        for batch in batches:
            for a, found, bounds, nodes in _sets_of(batch):
                n = len(nodes)
                row, _, place = deciding(found, bounds, order)
                last, light = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.int64)
                last[row] = place  # places rise within a row
                late = order.places_of(found) >> np.uint64(HASH_BITS)
                every = np.repeat(np.arange(n), np.diff(bounds))
                light += np.bincount(every, weights=late == 0, minlength=n).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(a, n) for c in ("k1", "k2", "id")),
                        pa.array(np.diff(bounds)),
                        pa.array(nodes.view(np.int64)),
                        pa.array(last.view(np.int64)),
                        pa.array(light),
                    ],
                    ["k1", "k2", "id", "n", "node", "last", "light"],
                )

    id_type = docs.schema["id"].dataType.simpleString()
    return arrow_map(
        docs.select("k1", "k2", "id", F.col(column).alias("text")),
        run,
        f"k1 long, k2 long, id {id_type}, n long, node long, last long, light long",
    )


def prefix_rows(texts: DataFrame, heavy: np.ndarray) -> DataFrame:
    """shingle and node of the deciding columns of each set, once per task and set."""
    shared = texts.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(shared.value)
        seen: set[int] = set()
        for batch in batches:
            for _, found, bounds, nodes in _sets_of(batch):
                fresh = np.zeros(len(nodes), dtype=bool)
                for i, node in enumerate(nodes.tolist()):
                    if node not in seen:
                        fresh[i] = True
                        seen.add(node)
                if len(seen) > 500_000:
                    seen.clear()
                row, shingle, _ = deciding(found, bounds, order)
                keep = fresh[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle[keep].view(np.int64)), pa.array(nodes[row[keep]].view(np.int64))], ["shingle", "node"]
                )

    return arrow_map(texts, run, "shingle long, node long")


def shared_columns(rows: DataFrame) -> DataFrame:
    """Distinct rows of the shingles that stand in two sets or more.

    Rows come sorted and are read as a stream; of a shingle nothing is held but its first row.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (shingle, node) of the row before
        alone = False  # whether that row is the first of its shingle and not given out yet
        for batch in batches:
            key, node = batch.column("shingle").to_numpy(), batch.column("node").to_numpy()
            fresh = np.ones(len(key), dtype=bool)
            fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
            if len(key) and last is not None and last == (key[0], node[0]):
                fresh[0] = False
            key, node = key[fresh], node[fresh]
            if not len(key):
                continue
            before = np.concatenate([[last is not None and last[0] == key[0]], key[1:] == key[:-1]])
            after = np.concatenate([key[1:] == key[:-1], [False]])
            out = before | after
            if alone and before[0]:
                yield pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]])], ["shingle", "node"])
            yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(node[out])], ["shingle", "node"])
            last, alone = (key[-1], node[-1]), not out[-1]

    dealt = rows.repartition(parts, "shingle").sortWithinPartitions("shingle", "node")
    return arrow_map(dealt, run, "shingle long, node long")


def _side(rows: DataFrame, name: str, *others: str) -> DataFrame:
    return rows.select(*others, *[F.col(c).alias(f"{c}_{name}") for c in ("node", "n", "most", "last", "label")])


def _of_first_end(a, b):
    """Of two values the one of the set whose last deciding shingle comes first in the order; the larger if none does."""
    first = F.when(F.col("last_a") < F.col("last_b"), a)
    return first.when(F.col("last_a") > F.col("last_b"), b).otherwise(F.greatest(a, b))


def _possible():
    """Whether a and b can be alike by their sizes and by what is known of each alone.

    ``most`` is a set's size less its deciding shingles that decide for no other set. Of the set whose last
    deciding shingle comes first, all of these would decide for the other one too if they were in it.
    """
    sizes = 4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b")
    return sizes & (7 * _of_first_end(F.col("most_a"), F.col("most_b")) >= 3 * (F.col("n_a") + F.col("n_b")))


def _bounded(products: DataFrame) -> DataFrame:
    """Pairs (a, b) whose summed products can still reach the overlap that J >= 0.75 asks for.

    All deciding shingles of the set whose last one comes first in the order are known
    to be shared or not, so at most ``shared`` of them count.
    """
    sums = products.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(
        F.count("*").alias("shared"),
        *[F.first(c).alias(c) for c in ("n_a", "n_b", "last_a", "last_b")],
    )
    open_a, open_b = (F.ceil(F.col(n) * 0.75) - 1 for n in ("n_a", "n_b"))
    return sums.where(7 * (F.col("shared") + _of_first_end(open_a, open_b)) >= 3 * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def verified(pairs: DataFrame, rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= 75 * union, by their full sets."""
    pairs = materialise(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    one = rows.join(nodes, "node").groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("one"))
    wanted = materialise(one.select("one.k1", "one.k2", "node"), "wanted")
    bodies = packed(picked(docs, wanted.select("k1", "k2")), "text", "k1", "k2").groupBy("k1", "k2").agg(F.any_value("z").alias("z"))
    bodies = materialise(bodies.join(wanted, ["k1", "k2"]).select("node", "z"), "bodies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[bytes, np.ndarray] | None = None
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("z_a").to_pylist(), batch.column("z_b").to_pylist(), strict=True):
                if kept is None or kept[0] != left:
                    kept = (left, one_set(left))
                x, y = kept[1], one_set(right)
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            part = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"])

    def one_set(z: bytes) -> np.ndarray:
        data = np.frombuffer(unsqueeze(z), dtype=np.uint8)
        return shingle_sets(data, np.array([0, len(data)]))[0]

    left = pairs.join(bodies.select(F.col("node").alias("b"), F.col("z").alias("z_b")), "b")
    both = left.join(bodies.select(F.col("node").alias("a"), F.col("z").alias("z_a")), "a")
    return materialise(arrow_map(both.select("a", "b", "z_a", "z_b"), run, "a long, b long"), "links")


def alike_sets(docs: DataFrame, rows: DataFrame, heavy: np.ndarray) -> DataFrame:
    """node and label: components of sets that are alike; sets without a link are left out.

    ``docs``: k1, k2, text. ``rows``: what ``set_rows`` has of them.
    """
    columns = materialise(shared_columns(prefix_rows(docs.select("text"), heavy)), "columns")
    found = columns.groupBy("node").agg(F.count("*").alias("found"))
    sets = rows.where("n > 0").groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "last", "light")])
    decide = F.col("n") - F.ceil(F.col("n") * 0.75) + 1
    sets = materialise(
        sets.join(found, "node").withColumn("most", F.col("n") - (decide - F.col("found"))).withColumn("label", F.col("node")), "nodes"
    )
    marked = materialise(columns.join(sets, "node"), "marked")
    # The document least of its own makes the centre of a column.
    share = F.floor(F.col("light") * 1000 / F.col("n"))
    centre = marked.groupBy("shingle").agg(F.min(F.struct(share, "node", "n", "most", "last", "label")).alias("c"))
    stars = _side(marked, "b", "shingle").join(_side(centre.select("shingle", "c.*"), "a", "shingle"), "shingle")
    first = verified(_bounded(stars.where("node_a <> node_b").where(_possible())), rows, docs)
    labels = components(first)
    marked = marked.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    marked = materialise(marked, "marked")
    mixed = marked.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("shingle")
    rest = marked.join(mixed, "shingle")
    products = _side(rest, "a", "shingle").join(_side(rest, "b", "shingle"), "shingle")
    products = products.where("node_a < node_b and label_a <> label_b").where(_possible())
    return components(first.unionAll(verified(_bounded(products), rows, docs)))


def near_duplicates(docs: DataFrame, column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """k1, k2 (key of id and text), id, n_shingles, label and component_id of every row.

    ``component_id`` is the smallest id of the rows reachable by links, the row itself included.
    """
    docs = docs.select(
        *key_columns(F.col(id_column), F.col(column)),
        F.col(id_column).alias("id"),
        F.coalesce(F.col(column), F.lit("")).alias("text"),
    )
    heavy = heavy_shingles(docs.select("text"))
    rows = materialise(set_rows(docs, heavy, "text"), "sets")
    labels = alike_sets(docs.select("k1", "k2", "text"), rows, heavy)
    joined = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = joined.where("n > 0").groupBy("label").agg(F.min("id").alias("component_id"))
    return joined.join(least, "label", "left").select(
        "k1",
        "k2",
        "id",
        F.col("n").alias("n_shingles"),
        "label",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of ``documents``: five-word shingles, Jaccard 0.75 or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
