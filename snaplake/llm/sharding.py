"""Shards by a consistent-hash ring with virtual nodes and bounded loads, with DataFrame operations only.

Every shard has ``points`` places on a ring of hashes, its virtual nodes. A key belongs to the first one clockwise from
its own hash. A shard keeps its own keys up to its capacity, in the ring's order; the rest continue clockwise and go to
the first virtual node whose shard has room. With capacities that add up to the rows, all shards end up full: the balance
is exact, and only the keys that overflow lie elsewhere than the ring says. A further shard takes its arcs out of the
others', so few keys move.

Which shard has room is found on the counts of the arcs, as many as there are virtual nodes, however many the rows are:
each arc is given to one shard or to several in turn, so many rows to each. Rows are then numbered within their arc, in
stretches of it that are as many as the rows ask for, and take the shard and the slot of their number. Rows with equal
columns are one row with a count until they have their numbers.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snaplake.llm.common import small_enough, stored

POINTS = 256  # virtual nodes of a shard
BUCKET_BITS = 12  # the ring is cut into so many buckets (as a power of two) to look arcs up
STRETCH_ROWS = 100_000  # rows that are numbered in one window
_TOP = (1 << 63) - 1


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size (bytes of the text and one more) and text_crc32; a null text has no bytes."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(value) + 1).cast("long").alias("size"), F.crc32(value).alias("text_crc32"))


def _place_of(*columns: Column) -> Column:
    """A place on the ring, from 0 to 2**63 - 1."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(_TOP))


def ring(spark: SparkSession, shards: int, points: int = POINTS) -> DataFrame:
    """The virtual nodes (shard, arc, at): ``arc`` counts them clockwise. Two on one place would be in shard order."""
    nodes = spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    placed = nodes.select("shard", "point", _place_of(F.lit("node"), "shard", "point").alias("at"))
    return placed.select("shard", (F.row_number().over(Window.orderBy("at", "shard", "point")) - 1).alias("arc"), "at")


def _arcs(nodes: DataFrame) -> DataFrame:
    """(bucket, low, high, arc): the arcs, cut where buckets of the ring end. An arc ends at its node; what is beyond
    the last node belongs to the first one's arc."""
    width = 1 << (63 - BUCKET_BITS)
    low = F.coalesce(F.lag("at").over(Window.orderBy("arc")) + 1, F.lit(0).cast("long"))
    arcs = nodes.select("arc", low.alias("low"), F.col("at").alias("high")).filter("low <= high")
    beyond = nodes.agg((F.max("at") + 1).alias("low")).select(F.lit(0).alias("arc"), "low", F.lit(_TOP).alias("high")).filter("low > 0")
    cut = arcs.unionByName(beyond).withColumn("bucket", F.explode(F.sequence(_bucket(F.col("low")), _bucket(F.col("high")))))
    first = F.col("bucket") * F.lit(width)
    return cut.select("bucket", F.greatest("low", first).alias("low"), F.least("high", first + (width - 1)).alias("high"), "arc")


def _bucket(at: Column) -> Column:
    return F.shiftright(at, 63 - BUCKET_BITS)


def deal(owners: Sequence[int], counts: Sequence[int], capacities: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
    """Which rows of each arc go where: (arc, first, last + 1, shard, slot of the first), from the arcs' counts.

    ``owners`` are the arcs' shards, clockwise.
    """
    free, dealt, over = list(capacities), [], []
    slots = [0] * len(free)

    def give(arc: int, first: int, shard: int, rows: int) -> None:
        if rows:
            dealt.append((arc, first, first + rows, shard, slots[shard]))
            free[shard] -= rows
            slots[shard] += rows

    for arc, (shard, rows) in enumerate(zip(owners, counts)):
        kept = min(rows, free[shard])
        give(arc, 0, shard, kept)
        if kept < rows:
            over.append((arc, kept, rows))
    for arc, first, rows in over:
        at = arc
        while first < rows:
            at = (at + 1) % len(owners)
            taken = min(rows - first, free[owners[at]])
            give(arc, first, owners[at], taken)
            first += taken
    return dealt


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows that each shard may hold: an equal share, the first ones one more where it doesn't come out even, or so much
    more than that as ``slack`` says."""
    if slack < 0:
        raise ValueError("slack is at least 0")
    more = int(slack * rows / shards)
    return [rows // shards + (k < rows % shards) + more for k in range(shards)]


def place(rows: DataFrame, shards: int, key: str, keep: Sequence[str] = (), points: int = POINTS, slack: float = 0.0) -> DataFrame:
    """Each row's ``key`` and ``keep`` columns with its shard (from 0), its slot (gapless from 0 in each shard) and its
    home, the shard that the ring alone gives it.

    With ``slack`` 0 the shards' rows differ by one at most; with more, a shard holds up to that share beyond the mean,
    and fewer rows lie away from home. Rows of one key are neighbours on the ring and may end up in two shards, if one
    is full. A null key has a place of its own. Rows with equal columns are counted, not collected. An empty table gives
    no rows, and more shards than rows leave some empty.
    """
    if shards < 1 or points < 1:
        raise ValueError("shards and points are at least 1")
    spark = rows.sparkSession
    columns = [key, *keep]
    own = {c: f"c{k}" for k, c in enumerate(columns)}  # so that no name clashes with ours
    nodes = stored(ring(spark, shards, points), "ring")
    named = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()]).withColumn("at", _place_of(F.lit("key"), F.col("c0")))
    distinct = named.groupBy("at", *own.values()).agg(F.count(F.lit(1)).alias("copies"))
    # At most one row for each bucket and for each virtual node.
    arcs = F.broadcast(_arcs(nodes))
    met = distinct.withColumn("bucket", _bucket(F.col("at"))).join(arcs, "bucket").filter(F.col("at").between(F.col("low"), F.col("high")))
    keyed = stored(met.select("arc", "at", *own.values(), "copies"), "keys")

    total = keyed.agg(F.sum("copies")).first()[0] or 0
    stretches = max(1, -(-total // (shards * points * STRETCH_ROWS)))
    # Stretches are taken from a hash of the place: an arc is short, and its places' first bits are all the same.
    keyed = keyed.withColumn("stretch", F.pmod(F.xxhash64("at"), F.lit(stretches)))
    ahead = Window.partitionBy("arc").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored(
        keyed.groupBy("arc", "stretch").agg(F.sum("copies").alias("size")).withColumn("before", F.coalesce(F.sum("size").over(ahead), F.lit(0))), "sizes"
    )
    owners = [r["shard"] for r in nodes.orderBy("arc").collect()]  # shards x points numbers
    counts = [0] * len(owners)
    for r in sizes.groupBy("arc").agg(F.sum("size").alias("size")).collect():
        counts[r["arc"]] = r["size"]
    dealt = _rows(spark, deal(owners, counts, capacities(total, shards, slack)))
    homes = nodes.select("arc", F.col("shard").alias("home"))

    within = Window.partitionBy("arc", "stretch").orderBy("at", *own.values()).rowsBetween(Window.unboundedPreceding, -1)
    numbered = keyed.join(small_enough(sizes.drop("size")), ["arc", "stretch"])
    numbered = numbered.withColumn("number", F.col("before") + F.coalesce(F.sum("copies").over(within), F.lit(0))).drop("before", "stretch", "at")
    each = _copies(numbered, ["arc", "number"])
    # As many rows as virtual nodes, and one more where a shard gets full.
    there = each.join(F.broadcast(dealt.join(homes, "arc")), "arc").filter((F.col("number") >= F.col("first")) & (F.col("number") < F.col("past")))
    slot = F.col("slot") + F.col("number") - F.col("first")
    return there.select(*[F.col(n).alias(c) for c, n in own.items()], "shard", slot.alias("slot"), "home")


def _copies(numbered: DataFrame, at: list[str]) -> DataFrame:
    """One row for each copy, ``number`` counted on; copies are made some at a time, in as many tasks."""
    stretch = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(STRETCH_ROWS).cast("long")))
    many = numbered.filter("copies > 1").withColumn("from", stretch).repartition(*at, "from")
    many = many.withColumn("copy", F.explode(F.sequence("from", F.least(F.col("from") + STRETCH_ROWS, F.col("copies")) - 1)))
    return numbered.filter("copies = 1").drop("copies").unionByName(many.withColumn("number", F.col("number") + F.col("copy")).drop("copies", "copy", "from"))


def _rows(spark: SparkSession, dealt: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """The driver's few rows as a frame: one text, which Spark takes apart."""
    schema = "array<struct<arc: int, first: long, past: long, shard: int, slot: long>>"
    texts = [dict(zip(("arc", "first", "past", "shard", "slot"), row)) for row in dealt]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(texts)), schema)))
