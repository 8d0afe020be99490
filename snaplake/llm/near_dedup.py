"""Near-duplicate documents: fast similarity sketches, banding, and verification on whole shingle sets.

A sketch has ``t`` places. In round ``i`` every element is thrown into one place by a hash of that round, and a place
keeps the smallest (round, value); once a round leaves no place empty, later ones can't change anything. From round
``t`` on, round ``i`` throws everything into place ``i - t``, so every place is filled after ``2t`` rounds at the latest.
Two sets agree in a place with the probability of their Jaccard similarity, and the share of equal places is
concentrated around it as it is for ``t`` independent hashes, at the cost of one or two rounds for all but small sets.

Documents with equal sets are one class. Bands of places deal the classes' first documents into buckets. In a bucket
every class is compared with the bucket's first one, so that a group of thousands of near copies makes a link for each
instead of a pair for each two. Classes of a bucket that no links connect then are dealt into buckets once more, by many
bands of more places, which sets a little under the threshold seldom share. Buckets with members in common make regions;
a region's sets are compared across components in blocks, each task of which returns a forest of links, no pairs.
Links are verified on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import blocks, give_back, int64, lists, mix, new_name, shingle_set, small_enough, stored, stream, words
from snaplake.llm.components import components

WIDTH, BANDS, ROWS = 5, 25, 5
FINE_PLACES, FINE_BANDS = 1024, 640
REGION_ROWS, REGION_SHINGLES = 1024, 1 << 21  # of a block
_U = np.uint64


def sketch(elements: np.ndarray, places: int) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes: (round, value) in one number for each place."""
    out = np.full(places, ~_U(0))
    at_once = max(1, -(-6 * places // len(elements)))
    done = 0
    while (out == ~_U(0)).any():
        rounds = np.arange(done, min(done + at_once, 2 * places))
        h = mix(elements[None, :] ^ _SEEDS[rounds, None])
        place = ((h >> _U(32)) * _U(places) >> _U(32)).astype(np.int64)
        late = rounds >= places
        place[late] = (rounds[late] - places)[:, None]
        value = rounds.astype(_U)[:, None] << _U(40) | mix(h) >> _U(24)
        np.minimum.at(out, place.ravel(), value.ravel())
        done += at_once
    return out


_SEEDS = stream(4096, 7)


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    factors = stream(rows, 8) | _U(1)
    return mix((mix(values.reshape(bands, rows)) * factors).sum(1) + stream(bands, 9))


def _sketches(bands: int, rows: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in blocks(batch.column(1)):
                hashes, _, _, first = words(data, bounds)
                sizes, digests, keys = [], [], []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                    s = shingle_set(hashes[a:b], width)
                    sizes.append(len(s))
                    digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    if len(s):
                        keys.append(band_keys(sketch(s, bands * rows), bands, rows))
                n = np.array(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(n)),
                        int64(n),
                        pa.array(digests, pa.binary()),
                        lists(int64(np.concatenate(keys) if keys else np.zeros(0, _U)), np.where(n > 0, bands, 0)),
                    ],
                    names=["doc_id", "n_shingles", "digest", "keys"],
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in blocks(batch.column(1)):
                hashes, _, _, first = words(data, bounds)
                sets = [shingle_set(hashes[a:b], width) for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(sets)), lists(int64(np.concatenate(sets)), np.array([len(s) for s in sets]))],
                    names=["doc_id", "shingles"],
                )

    return run


def near_duplicates(
    docs: DataFrame, percent: int = 85, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """For each document: doc_id, n_shingles, component_id (the smallest id that it reaches by links), kept.

    Two documents are linked if 100 times the number of common shingles is at least ``percent`` times that of all
    theirs. A pair at 0.85 is missed by all 25 bands of 5 rows with a probability below 10^-6, by the finer bands below
    10^-4. Documents without words are linked with nothing, like rows without an id, whose component is null and which
    are kept. Rows of one id are one document: what one of them is linked with, all are. Other columns are left out.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketched = stored(base.mapInArrow(_sketches(bands, rows, width), "doc_id long, n_shingles long, digest binary, keys array<long>"), "sketches")
    known = sketched.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = stored(known.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys")), "classes")
    placed = stored(known.join(classes.select("digest", "node"), "digest").select("doc_id", "n_shingles", "node"), "placed")

    members = _members(classes)
    candidates = stored(members.select(F.col("node").alias("doc_id")).distinct(), "candidates")
    sets = stored(
        base.join(small_enough(candidates), "doc_id", "left_semi").mapInArrow(_sets(width), "doc_id long, shingles array<long>").filter(F.size("shingles") > 0),
        "sets",
    )
    stars = members.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(verified(stars, sets, percent), "links")
    found = stored(components(links), "found")

    # What is not connected in a bucket is dealt anew by finer bands, which far fewer unlike sets share.
    apart = stored(_apart(members, found).select("node").distinct(), "apart")
    again = sets.join(small_enough(apart.select(F.col("node").alias("doc_id"))), "doc_id", "left_semi")
    members = _members(again.mapInArrow(_fine_keys(fine_rows(percent)), "node long, keys array<long>"))
    links = links.unionByName(_across(members, found, sets, percent))
    # Rows of one id whose texts are of several classes.
    ids = placed.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z").select("doc_id", "a")
    same = placed.join(ids, "doc_id").filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    final = components(links.unionByName(same))
    linked = _component_of(placed, final, "component_id").select("doc_id", "n_shingles", "component_id")
    alone = sketched.filter(F.col("digest").isNull() | F.col("doc_id").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _members(keyed: DataFrame) -> DataFrame:
    """(key, node, hub) of the buckets that several nodes share; the hub is the first of them."""
    keys = keyed.select("node", F.explode("keys").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return stored(keys.join(buckets, "key"), "members")


def _across(members: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between the components of ``found``, enough of them to connect all that the buckets' pairs connect.

    Buckets that have members in common make a region, found by a link of each member with its bucket's first. A region
    is dealt into blocks of bounded rows and shingles, a power of two of them; two blocks meet in one task if a bucket has members in both. The
    task compares whole sets across components and returns a forest. So a group of near copies costs a row for each
    member and block, though its pairs, each a little under the threshold, all have to be looked at.
    """
    if "hub" not in members.columns:
        members = members.join(members.groupBy("key").agg(F.min("node").alias("hub")), "key")
    two = stored(_apart(members, found), "apart")
    # Buckets are here whole or not at all, so their first is still the hub that each member came with.
    stars = two.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    region = components(stars).withColumnRenamed("component", "region")
    nodes = stored(two.select("node", "component").distinct().join(region, "node"), "regions")
    sizes = nodes.join(sets.select(F.col("doc_id").alias("node"), F.size("shingles").alias("size")), "node")
    wanted = F.greatest(F.count(F.lit(1)) / REGION_ROWS, F.sum("size") / REGION_SHINGLES)
    n = F.pow(F.lit(2), F.greatest(F.ceil(F.log2(wanted)), F.lit(0))).cast("long").alias("n")
    deals = stored(sizes.groupBy("region").agg(n), "region-blocks")
    most = deals.agg(F.max("n")).first()[0] or 1
    drawn = F.xxhash64("node")
    nodes = stored(nodes.join(small_enough(deals), "region").select("region", "node", "component", "n", F.pmod(drawn, "n").alias("own")), "regions")
    # All numbers of blocks divide the largest. So a bucket's blocks follow from what it holds itself, and only the buckets,
    # not their members, are joined with a node: the first, for its region's number of blocks.
    held = two.groupBy("key").agg(F.min("hub").alias("a"), F.collect_set(F.pmod(drawn, F.lit(most))).alias("drawn"))
    cut = nodes.filter("n > 1").select(F.col("node").alias("a"), "n")
    others = held.join(cut, "a").select("key", F.array_distinct(F.transform("drawn", lambda d: F.pmod(d, F.col("n")))).alias("others"))
    partners = two.select("key", "node").join(others, "key").groupBy("node").agg(F.array_distinct(F.flatten(F.collect_set("others"))).alias("others"))
    met = (
        nodes.join(partners, "node", "left")
        .select("region", "node", "component", "own", F.explode(F.coalesce("others", F.array("own"))).alias("o"))
        .select("region", "node", "component", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), (F.col("own") > F.col("o")).alias("second"))
        .join(sets.withColumnRenamed("doc_id", "node"), "node")
    )

    def compare(group: pa.Table) -> pa.Table:
        give_back()  # what the group before has left
        node, component = group["node"].to_numpy(), group["component"].to_numpy()
        second = group["second"].to_numpy() if group["i"][0] != group["j"][0] else None
        column = group["shingles"].combine_chunks()
        a, b = forest_of_sets(column.flatten().to_numpy(), column.value_lengths().to_numpy(), component, second, percent)
        return pa.table({"a": int64(node[a]), "b": int64(node[b])})

    return stored(met.groupBy("region", "i", "j").applyInArrow(compare, "a long, b long"), "links")


def forest_of_sets(values: np.ndarray, sizes: np.ndarray, component: np.ndarray, second: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): rows whose sets are similar enough and whose components no earlier link of these connects.

    ``values`` are the sets end to end. With ``second``, rows of the one side are compared with those of the other.
    """
    n = len(sizes)
    codes = np.unique(values, return_inverse=True)[1]
    rows, bounds = np.repeat(np.arange(n), sizes), np.concatenate([[0], np.cumsum(sizes)])
    label = np.unique(component, return_inverse=True)[1]
    listed = np.ones(len(rows), bool) if second is None else second[rows]
    order = np.flatnonzero(listed)[np.argsort(codes[listed], kind="stable")]
    holders = rows[order]
    cuts = np.concatenate([[0], np.cumsum(np.bincount(codes[listed], minlength=int(codes.max(initial=-1)) + 1))])
    side = np.ones(n, bool) if second is None else second
    found = []
    for a in range(n) if second is None else np.flatnonzero(~second):
        able = side & (label != label[a]) & (100 * np.minimum(sizes, sizes[a]) >= percent * np.maximum(sizes, sizes[a]))
        if second is None:
            able[: a + 1] = False
        if not able.any():
            continue
        own = codes[bounds[a] : bounds[a + 1]]
        lengths = cuts[own + 1] - cuts[own]
        at = np.repeat(cuts[own] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        common = np.bincount(holders[at], minlength=n)
        for b in np.flatnonzero(able & (100 * common >= percent * (sizes + sizes[a] - common))):
            if label[b] != label[a]:
                found.append((a, b))
                label[label == label[b]] = label[a]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _component_of(nodes: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """``nodes`` with the component of ``node``, itself where no link has it."""
    return nodes.join(found, "node", "left").withColumn(name, F.coalesce("component", "node")).drop("component")


def _apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """(key, node, hub, component) of the buckets that hold several components."""
    placed = _component_of(members, found, "of").withColumnRenamed("of", "component")
    several = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("key")
    return placed.join(several, "key")


def fine_rows(percent: int) -> int:
    """The most places a fine band can have if a pair at the threshold is to share 17.5 of the bands on average."""
    share = min(percent / 100, 0.98)
    return max(1, int(np.log(17.5 / FINE_BANDS) / np.log(share)))


def _fine_keys(rows: int):
    """(node, keys) of (doc_id, shingles): bands of ``rows`` places each, drawn from a longer sketch."""
    drawn = np.argsort(stream(FINE_BANDS * FINE_PLACES, 12).reshape(FINE_BANDS, FINE_PLACES), axis=1)[:, :rows]
    factors, tags = stream(rows, 13) | _U(1), stream(FINE_BANDS, 14)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(1).offsets.to_numpy()
            values = batch.column(1).values.to_numpy().view(np.uint64)
            keys = [mix((mix(sketch(values[x:y], FINE_PLACES))[drawn] * factors).sum(1) + tags) for x, y in zip(at[:-1], at[1:])]
            flat = np.concatenate(keys) if keys else np.zeros(0, _U)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(int64(flat), np.full(len(keys), FINE_BANDS))], names=["node", "keys"])

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    both = (
        pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("t")), "b")
        .join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s")), "a")
        # A pair whose sizes alone rule it out needs no intersection.
        .filter(100 * F.least(F.size("s"), F.size("t")) >= percent * F.greatest(F.size("s"), F.size("t")))
        .select("a", "b", (F.size("s") + F.size("t")).alias("n"), F.size(F.array_intersect("s", "t")).alias("common"))
    )
    return both.filter(100 * F.col("common") >= percent * (F.col("n") - F.col("common"))).select("a", "b")


def drop_near_duplicates(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows and columns of ``docs`` whose document has the smallest id of its component; rows without an id stay.

    At 0.8, 34 bands of 4 rows miss a pair with a probability below 10^-7.
    """
    options = {"bands": 34, "rows": 4} | options
    found = near_duplicates(docs, percent=percent, doc_id=doc_id, text=text, **options)
    name = new_name()
    gone = stored(found.filter("not kept").select(F.col("doc_id").alias(name)).distinct(), "near-duplicates")
    return docs.join(small_enough(gone), docs[doc_id].cast("long") == F.col(name), "left_anti")
