"""Token ids as files: canonical length-limited Huffman code from the counts of all ids, in independent blocks.

A written set is a folder with two tables. ``codes`` has the code length of each id; canonical codes follow from the
lengths. ``blocks`` has a row for each block: the file and block number, the documents' ids and token counts, the
payload, and the bit offset of every 256th token in it, a checkpoint from which decoding can begin. Documents are in
ascending order of their ids over files, blocks and places. A block is one or more whole documents and needs nothing
but the code table to be read; its checkpoints are decoded side by side, one table look-up for a token of each.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snaplake.llm.common import blocks, int64, lists
from snaplake.llm.packing import with_end
from snaplake.llm.vocabulary import encoder

STEP = 256
BLOCKS = "file int, block int, first long, doc_ids array<long>, counts array<long>, checkpoints array<long>, payload binary"
TOKENS = "file int, at long, doc_id long, n_tokens long, ids binary"


def code_lengths(counts: np.ndarray, longest: int) -> np.ndarray:
    """Best code lengths of at most ``longest`` bits, by package-merge; ``counts`` are positive."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << longest:
        raise ValueError(f"{n} symbols need more than {longest} bits")
    order = np.argsort(counts, kind="stable")
    coins = counts[order].astype(np.float64)
    levels, weights, leaf = [], coins, np.ones(n, bool)
    for _ in range(longest):
        levels.append(leaf)
        packages = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([coins, packages])
        place = np.argsort(both, kind="stable")
        weights, leaf = both[place], place < n
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        taken = int(leaf[:take].sum())
        lengths[:taken] += 1
        take = 2 * (take - taken)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """The canonical code of ids with given lengths: shorter codes first, then smaller ids."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.longest = int(lengths.max(initial=1))
        steps = np.left_shift(1, self.longest - lengths)
        first = np.cumsum(steps) - steps  # codes, filled up with zeros to the longest
        top = int(ids.max(initial=0)) + 1
        self.codes, self.lengths = np.zeros(top, np.uint64), np.zeros(top, np.int64)
        self.codes[ids], self.lengths[ids] = (first >> (self.longest - lengths)).astype(np.uint64), lengths
        self.table_ids = np.zeros(1 << self.longest, np.uint32)
        self.table_lengths = np.ones(1 << self.longest, np.int64)
        self.table_ids[: steps.sum()], self.table_lengths[: steps.sum()] = np.repeat(ids, steps), np.repeat(lengths, steps)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(payload, bit offsets of the checkpoints)."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = ends - lengths
        word = at >> 5
        bits = self.codes[ids] << (64 - (at & 31) - lengths).astype(np.uint64)
        out = np.zeros((int(ends[-1]) >> 5) + 2 if len(ids) else 0, np.uint64)
        if len(ids):
            new = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[new]] += np.add.reduceat(bits >> np.uint64(32), new)
            out[word[new] + 1] += np.add.reduceat(bits & np.uint64(0xFFFFFFFF), new)
        return out.astype(">u4").tobytes(), at[::STEP]

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        words = np.concatenate([np.frombuffer(payload, ">u4").astype(np.uint64), np.zeros(2 + STEP * self.longest // 32, np.uint64)])
        pairs = words[:-1] << np.uint64(32) | words[1:]
        at, out = checkpoints.astype(np.int64), np.empty((min(STEP, n), len(checkpoints)), np.uint32)
        for k in range(len(out)):
            look = pairs[at >> 5] << (at & 31).astype(np.uint64) >> np.uint64(64 - self.longest)
            out[k] = self.table_ids[look]
            at = at + self.table_lengths[look]
        return out.T.reshape(-1)[:n] if len(out) == STEP else out[:, 0]


@functools.lru_cache(maxsize=2)
def _code(ids: bytes, lengths: bytes) -> Code:
    return Code(np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64))


def _columns(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def id_counts(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n) of all texts' ids with ``end_id`` after each; each task adds up its own before the shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, total = encoder(tokenizer).encode, np.zeros(0, np.int64)
        for batch in batches:
            for _, data, bounds in blocks(batch.column(1)):
                ids, _ = with_end(*encode(data, bounds), end_id)
                got = np.bincount(ids)
                if len(got) > len(total):
                    got, total = total, got
                total[: len(got)] += got
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([int64(ids), int64(total[ids])], names=["id", "n"])

    return _columns(docs, doc_id, text).mapInArrow(rows, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes all texts' ids to ``folder``, each text's followed by ``end_id``.

    Null texts are empty. Documents without an id come first, those of equal ids in the order of their texts. An empty
    table makes an empty set. The counts of the ids, as many as the vocabulary has at most, pass through the driver.
    """
    spark = docs.sparkSession
    counts = id_counts(docs, tokenizer, end_id, doc_id, text).toPandas().sort_values("id")
    ids, n = counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    lengths = code_lengths(n, max(12, (max(len(n), 2) - 1).bit_length() + 2))
    spark.createDataFrame(pa.table({"id": int64(ids), "length": int64(lengths)})).coalesce(1).write.parquet(f"{folder}/codes")
    key = ids.tobytes(), lengths.tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, encode, block, first = TaskContext.get().partitionId(), encoder(tokenizer).encode, 0, 0
        for batch in batches:
            for row, data, bounds in blocks(batch.column(1)):
                tokens, bounds = with_end(*encode(data, bounds), end_id)
                payload, checkpoints = _code(*key).encode(tokens)
                here = np.array([len(bounds) - 1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file], pa.int32()),
                        pa.array([block], pa.int32()),
                        int64(np.array([first])),
                        lists(batch.column(0).slice(row, here[0]), here),
                        lists(int64(np.diff(bounds)), here),
                        lists(int64(checkpoints), np.array([len(checkpoints)])),
                        pa.array([payload], pa.binary()),
                    ],
                    names=["file", "block", "first", "doc_ids", "counts", "checkpoints", "payload"],
                )
                block, first = block + 1, first + len(tokens)

    ordered = _columns(docs, doc_id, text).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(rows, BLOCKS).write.parquet(f"{folder}/blocks")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a written set: doc_id, start (tokens of all documents before it), n_tokens, ids (little-endian
    unsigned 32-bit). The files' totals, one row a file, are the only thing that is summed in one place."""
    codes = spark.read.parquet(f"{folder}/codes").toPandas().sort_values("id")
    key = codes["id"].to_numpy(np.int64).tobytes(), codes["length"].to_numpy(np.int64).tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = {n: batch.column(i)[k] for i, n in enumerate(batch.schema.names)}
                counts = one["counts"].values.to_numpy()
                ends = np.cumsum(counts)
                ids = _code(*key).decode(one["payload"].as_py(), one["checkpoints"].values.to_numpy(), int(ends[-1]))
                cuts = np.concatenate([[0], ends]).astype(np.int32) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(counts), one["file"].as_py(), np.int32)),
                        int64(one["first"].as_py() + ends - counts),
                        one["doc_ids"].values,
                        int64(counts),
                        pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(cuts), pa.py_buffer(ids.astype("<u4"))]),
                    ],
                    names=["file", "at", "doc_id", "n_tokens", "ids"],
                )

    written = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    totals = written.groupBy("file").agg(F.sum(size).alias("total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("begin"))
    tokens = written.mapInArrow(rows, TOKENS).join(F.broadcast(begins), "file")
    return tokens.select("doc_id", (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids")
