"""Labelled documents to train on: a bounded sample that never holds the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainroute.session import materialise


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """``text`` and ``label`` of at most ``most`` labelled documents outside the held-out fold.

    The labels with the smallest hashes of the id are taken, so the sample does not depend on
    the order of rows. A document with several labels counts as 1 if any is 1. Only the
    chosen ids are broadcast: ``most`` rows of two numbers.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(fold(F.col("doc_id"), folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return materialise(texts.join(F.broadcast(chosen), "doc_id").select("text", "label"), "training")
