"""Queries of this subpackage and their SQL.

Operators without SQL (token output, fingerprints, license scans, tokens, classifiers) are tested in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment,
    bpe,
    decontaminate,
    fingerprints,
    hard_negatives,
    learned_partitions,
    licenses,
    ngram_join,
    quality,
    substring_dedup,
    suffix_dedup,
    token_output,
    toxicity,
)
from .oracle import ORACLE

__all__ = ["ORACLE", "REGISTRY"]

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        suffix_dedup.op1_suffix_dedup,
        decontaminate.op2_benchmark_decontamination,
        token_output.op3_token_output,
        fingerprints.op4_document_fingerprints,
        licenses.op5_license_scans,
        ngram_join.op6_ngram_jaccard_join,
        substring_dedup.op7_substring_dedup,
        bpe.op8_bpe_encoding,
        toxicity.op9_toxicity,
        quality.op10_quality_classifier,
        hard_negatives.op11_hard_negative_mining,
        learned_partitions.op12_approximate_neighbours,
        alignment.op13_cross_tokenizer_alignment,
    )
}
