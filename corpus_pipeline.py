"""A training corpus from ``documents``: good quality, no near copies, no repeated passages, no benchmark items, packed.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from snaplake.llm import decontaminate, near_dedup, packing, passages, quality
from snaplake.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose probability of a good grade is below a half. The classifier learns from the rated
    documents of the given tables."""
    model = quality.fit(table(spark, sf_dir, "documents"), quality.ratings(table(spark, sf_dir, "labels")))
    return quality.select_documents(docs, model)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies, at a similarity of 0.8 of five-word
    shingles. Rows without an id stay."""
    return near_dedup.drop_near_duplicates(docs, percent=80)


def substring_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words or more that an earlier document has. No document goes."""
    return passages.cut_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences' pieces: doc_id, piece, start, length, ids, sequence_id, offset."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), size=4096, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_deduplication),
    ("substring dedup", substring_deduplication),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Classifiers, sketches and tokenizers are not SQL: tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the last stage makes of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
