"""A Merkle manifest of a table: a tree of hashes over its rows for each group, and one over the groups' roots.

A row is a leaf, the hash of its fields. Leaves of a group ascend by id, ``arity`` consecutive ones make a run, and a run's
hash is a node of the next level, until a single node is left. Nodes know their place in the level and the level's size,
so everything about a run follows from neighbours: per level, columns of fixed ``lag`` and ``lead`` offsets, masked by the
node's slot in its run and by the run's length, are its siblings, and each run's first child hashes the parent. The way
back down hands each node the siblings of all levels above it.

Places are counted in two steps: ranges of (group, id), and rows inside each range. Windows are cut into blocks of whole
runs. So no task ever holds a group, and a row that is repeated many times is one with a count until it has its places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import small_enough, stored

ARITY = 8
BLOCK_RUNS = 64  # runs of a window
RANGE_ROWS = 10_000, 1_000_000  # rows of a range: at least, while there are no more ranges than shuffle partitions, and at most
COPIES = 100_000  # copies of one row that a task makes

PATH = "array<struct<left: string, right: string>>"


def encoded(field: Column) -> Column:
    """A field's part of a leaf: ``-`` for null, else the bytes of its UTF-8 text, a colon and the text."""
    text = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, and nothing else."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(text, upper, upper.lower())


def folded(hash_: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, hash_, lambda h, level: F.sha2(F.concat(level["left"], h, level["right"]), 256))


def proof(path: Column) -> Column:
    """The hash of all siblings on a path, from the leaf's level up and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), ""), 256)


def placed(rows: DataFrame, tree: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows``, a stored table, with each row's ``place`` in its tree from 0 on and the tree's size ``n``.

    Rows equal in all columns are counted first and take neighbouring places. Ranges of rows are numbered and stored;
    their sizes, a row for each range and tree, are added up; then each range is numbered by itself.
    """
    spark, columns = rows.sparkSession, rows.columns
    total = rows.count()
    least, most = (-(-total // n) for n in RANGE_ROWS)
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), least), most)
    distinct = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    ranged = stored(distinct.repartitionByRange(parts, *tree, *order).withColumn("part", F.spark_partition_id()), "ranges")
    ahead = Window.partitionBy(*tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("part", *tree).agg(F.sum("copies").alias("size"))
    sizes = sizes.select(
        "part", *tree, F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("first"), F.sum("size").over(Window.partitionBy(*tree)).alias("n")
    )
    sizes = small_enough(stored(sizes, "sizes"))
    before = Window.partitionBy("part", *tree).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    begun = ranged.join(sizes, ["part", *tree]).withColumn("place", F.col("first") + F.coalesce(F.sum("copies").over(before), F.lit(0)))
    begun = stored(begun.select(*columns, "place", "n", "copies"), "places")
    once = begun.filter("copies = 1").drop("copies")
    # Copies are made some at a time, in as many tasks.
    stretch = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long")))
    many = begun.filter("copies > 1").withColumn("from", stretch).repartition("place", "from")
    copy = F.explode(F.sequence(F.col("from"), F.least(F.col("from") + COPIES, "copies") - 1))
    many = many.withColumn("copy", copy).select(*columns, (F.col("place") + F.col("copy")).alias("place"), "n")
    return once.unionByName(many)


def _siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with the hashes of the run's others to the left and to the right."""
    block = F.call_function("div", F.col("place"), F.lit(arity * BLOCK_RUNS).cast("long"))
    row = Window.partitionBy("tree", "block").orderBy("place")
    slot = F.col("place") % arity
    length = F.least(F.lit(arity), F.col("n") - F.col("place") + slot)
    left = [F.when(slot >= k, F.lag("hash", k).over(row)) for k in range(arity - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("hash", k).over(row)) for k in range(1, arity)]
    shown = nodes.withColumn("block", block).select("*", F.concat_ws("", *left).alias("left"), F.concat_ws("", *right).alias("right"))
    return shown.drop("block")


def _parent(arity: int) -> Column:
    return F.call_function("div", F.col("place"), F.lit(arity).cast("long"))


def _above(arity: int) -> Column:
    """Nodes of the next level."""
    return F.call_function("div", F.col("n") + (arity - 1), F.lit(arity).cast("long"))


def _levels(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of all trees that have more than one node there, and the roots (tree, hash).

    As many rounds as the largest tree has levels, each over an ``arity``-th of the rows of the one before.
    """
    levels, roots = [], nodes.filter("n = 1").select("tree", "hash")
    while True:
        level = stored(_siblings(nodes.filter("n > 1"), arity), "level")
        if level.isEmpty():
            return levels, roots
        levels.append(level)
        first = level.filter(F.col("place") % arity == 0)
        nodes = first.select("tree", _parent(arity).alias("place"), _above(arity).alias("n"), F.sha2(F.concat("hash", "right"), 256).alias("hash"))
        roots = roots.unionByName(nodes.filter("n = 1").select("tree", "hash"))


def _paths(levels: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """The first level's nodes with ``path``, from the roots down. ``above`` (tree, path, and whatever else is to be
    handed down) is what the roots have; it is met by one node of each tree only."""
    handed = [c for c in above.columns if c not in ("tree", "path")]
    down = None
    for level in reversed(levels):
        parents = above.withColumn("up", F.lit(0).cast("long")).withColumn("of", F.lit(1).cast("long"))
        if down is not None:
            parents = parents.unionByName(down)
        here = F.array(F.struct("left", "right"))
        nodes = level.withColumns({"up": _parent(arity), "of": _above(arity)})
        met = nodes.join(parents, ["tree", "up", "of"]).withColumn("path", F.concat(here, "path"))
        down = met.drop("left", "right", "up", "of")
        if level is not levels[0]:
            down = stored(down.select("tree", F.col("place").alias("up"), F.col("n").alias("of"), "path", *handed), "paths")
    return down


def manifest(rows: DataFrame, group: str, order: Sequence[str], hash_: str, arity: int = ARITY) -> DataFrame:
    """``rows`` with subroot, root and ``path``: for each level from the leaf's up to the root, the hashes of the run's
    others, to the left and to the right.

    ``rows`` is a stored table of a string column ``group`` (null is a group of its own and comes first), sort columns
    ``order`` and the leaves' ``hash_``; other columns are kept. Ties of ``order`` are put in the order of the hashes,
    so equal rows are neighbours. A group of one row has that row's leaf as subroot; a single subroot is the root. An
    empty table has no rows and no root.
    """
    kept = rows.columns
    tree = F.when(F.col(f"`{group}`").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(f"`{group}`")))
    own = {c: f"c{k}" for k, c in enumerate(kept)}  # so that no name clashes with ours
    leaves = rows.select(tree.alias("tree"), *[F.col(f"`{c}`").alias(n) for c, n in own.items()])
    leaves = placed(leaves, ["tree"], [own[c] for c in (*order, hash_)]).withColumn("hash", F.col(own[hash_]))
    leaves = stored(leaves, "leaves")
    levels, roots = _levels(leaves, arity)

    every = stored(roots, "subroots").select(F.lit("").alias("tree"), F.col("tree").alias("of_tree"), "hash")
    top = stored(placed(every, ["tree"], ["of_tree"]), "tops")
    upper, whole = _levels(top, arity)
    # One row, which is met by the nodes of the last run only.
    start = stored(whole.select(F.lit("").alias("tree"), F.array().cast(PATH).alias("path"), F.col("hash").alias("root")), "root")
    paths = _paths(upper, start, arity) if upper else top.join(start, "tree")
    above = stored(paths.select(F.col("of_tree").alias("tree"), "path", F.col("hash").alias("subroot"), "root"), "above")

    lone = leaves.filter("n = 1").join(above, "tree")
    every = _paths(levels, above, arity).unionByName(lone) if levels else lone
    return every.select(*[F.col(n).alias(c) for c, n in own.items()], "subroot", "root", "path")
