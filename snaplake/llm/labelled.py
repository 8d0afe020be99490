"""A bounded sample of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a row without an id. Fold 2 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, most: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, label, part) of at most ``most`` labelled documents outside fold 2, in the order of a hash of
    their ids. ``part`` is 0 to 3, by other bits of the id's crc32. Of an id's several labels the largest holds.

    The ids of the sample are broadcast, ``most`` of them at most, so texts are filtered where they are read.
    """
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), label.alias("label")).filter("doc_id is not null and label is not null")
    chosen = known.filter(fold(F.col("doc_id")) != 2).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    part = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 4) % 4
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return base.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label", part.cast("int").alias("part"))
