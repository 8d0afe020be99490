"""Token counts: the exact histogram of encoded lengths, and what its running sums answer for any context limit.

One row for each length holds all there is to know of the lengths: sums from a length on give the documents and tokens
that are as long or longer, those before it the ranks for quantiles, and both together the tokens left when documents
are cut at a limit. The histogram has at most as many rows as there are different lengths; its running sums go by
stretches of ``STRETCH`` lengths whose totals are summed apart, so no task holds all of it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import blocks, int64, stored
from snaplake.llm.vocabulary import encoder

STRETCH = 1024
COUNTS = ["documents", "tokens"]


def token_lengths(docs: DataFrame, tokenizer: str, group: str | None = None, text: str = "text") -> DataFrame:
    """(part, length) of every document: its encoded length, without special tokens; null texts have none."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            for row, data, bounds in blocks(batch.column(1)):
                _, at = encode(data, bounds)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(at) - 1), int64(np.diff(at))], names=["part", "length"])

    part = F.lit(None) if group is None else F.col(group)
    return docs.select(part.cast("string").alias("part"), F.col(text).cast("string").alias("text")).mapInArrow(rows, "part string, length long")


def length_histogram(docs: DataFrame, tokenizer: str, group: str | None = None, limits: Sequence[int] = (), text: str = "text") -> DataFrame:
    """A row for each length and each of ``limits``, over all documents (part null) and for each value of ``group``
    (null as ''), with

    - documents, tokens: of exactly that length;
    - documents_from, tokens_from: of that length or longer;
    - share_to: the share of documents of that length or shorter; the q-quantile is the first length with a share of
      at least q;
    - cut_total: tokens that are left if documents are cut at that length.

    Null and empty texts have length 0. An empty table makes no rows.
    """
    lengths = token_lengths(docs, tokenizer, group, text)
    # Stored, since several sums are made of it: texts are encoded once.
    counted = stored(lengths.groupBy("part", "length").agg(F.count("*").alias("documents")), "lengths")
    if group is None:
        grouped = counted.select(F.lit(None).cast("string").alias("part"), "length", "documents")
    else:
        named = counted.select(F.struct(F.coalesce("part", F.lit("")).alias("part")).alias("p"), "length", "documents")
        both = F.array("p", F.struct(F.lit(None).cast("string").alias("part")))
        grouped = named.select(F.explode(both).alias("p"), "length", "documents").select("p.part", "length", "documents")
    if limits:
        wanted = F.explode(F.array(*[F.lit(int(n)).cast("long") for n in limits]))
        grouped = grouped.unionByName(grouped.select("part").distinct().select("part", wanted.alias("length"), F.lit(0).cast("long").alias("documents")))
    histogram = grouped.groupBy("part", "length").agg(F.sum("documents").alias("documents"))
    histogram = histogram.withColumns({"tokens": F.col("length") * F.col("documents"), "stretch": F.floor(F.col("length") / STRETCH)})

    later = Window.partitionBy("part").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("part")
    stretches = histogram.groupBy("part", "stretch").agg(*[F.sum(c).alias(c) for c in COUNTS])
    stretches = stretches.select(
        F.col("part").alias("p"), F.col("stretch").alias("s"),
        *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"later_{c}") for c in COUNTS],
        *[F.sum(c).over(whole).alias(f"all_{c}") for c in COUNTS],
    )
    inside = Window.partitionBy("part", "stretch").orderBy(F.desc("length"))
    here = histogram.withColumns({f"here_{c}": F.sum(c).over(inside) for c in COUNTS})
    joined = here.join(stretches, F.col("part").eqNullSafe(F.col("p")) & (F.col("stretch") == F.col("s")))
    sums = joined.withColumns({f"{c}_from": F.col(f"later_{c}") + F.col(f"here_{c}") for c in COUNTS})
    return sums.select(
        "part", "length", *COUNTS, "documents_from", "tokens_from",
        (1 - (F.col("documents_from") - F.col("documents")) / F.col("all_documents")).alias("share_to"),
        (F.col("all_tokens") - F.col("tokens_from") + F.col("length") * F.col("documents_from")).alias("cut_total"),
    )
