"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame.

All but the last return the columns of ``docs``. Labels and benchmark items come from the
tables beside the documents. Every stage takes null texts as empty; rows alike in id and
text are one document to the near-duplicate stage and separate ones elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainroute.session import materialise

from . import bpe, decontaminate, ngram_join, suffix_dedup, toxicity
from .keys import picked
from .repeats import key_columns
from .tasks import small_batches


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; the others stay as they are."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    weights, intercept = toxicity.train_on(docs.select("doc_id", "text"), labels)
    return toxicity.score(docs, weights, intercept).where(F.col("score") < toxicity.THRESHOLD).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id stays (of equal ids, the smallest key).

    Documents without words are linked with nothing and stay; rows alike in id and text are one.
    """
    key = key_columns(F.col("doc_id"), F.col("text"))
    found = materialise(ngram_join.near_duplicates(docs.select("doc_id", "text")), "classes")
    order = F.struct(F.col("id").isNull(), "id", "k1", "k2")
    first = found.where("n_shingles > 0").groupBy("label").agg(F.min(order).alias("first"))
    others = found.where("n_shingles > 0").join(first, "label").where("k1 <> first.k1 or k2 <> first.k2")
    go = materialise(others.select("k1", "k2").distinct(), "go")
    again = found.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2")
    again = materialise(again.join(go, ["k1", "k2"], "left_anti"), "again")
    keyed = docs.select(*key, F.struct(*docs.columns).alias("row"))
    once = picked(picked(keyed, go, "left_anti"), again, "left_anti").select("row")
    copies = picked(keyed, again).groupBy("k1", "k2").agg(F.any_value("row").alias("row")).select("row")
    return once.unionAll(copies).select("row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of 400 bytes are cut out of the texts; every document stays."""
    found = suffix_dedup.remove_repeats(docs, 400)
    columns = {c: F.col("doc").getField(c) for c in docs.columns if c != "text"}
    columns["text"] = F.when(F.col("was_null"), F.lit(None).cast("string")).otherwise(F.col("kept_text"))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(columns["n_chars"]).cast(kind)
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go; the others stay as they are."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.drop_contaminated(docs, items)


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the token ids and of the decoded text."""
    return bpe.token_digests(docs, bpe.public_spec())


def _bounded(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage with small Arrow batches: memory that a stage's batches took is kept by the executors for the next."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("toxicity", _bounded(drop_toxic)),
    ("ngram_jaccard_join", _bounded(drop_near_duplicates)),
    ("suffix_array_dedup", _bounded(cut_repeats)),
    ("benchmark_decontamination", _bounded(drop_contaminated)),
    ("bpe_encoding", _bounded(token_digests)),
]
