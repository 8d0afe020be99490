"""Near-duplicate vectors: an exact metric range join.

On unit vectors, a cosine of at least ``c`` is a distance of at most ``r = sqrt(2 - 2c)``. Pivots partition the vectors:
each has its home in the cell of its nearest pivot. If ``x`` of cell ``i`` and ``y`` of cell ``j`` are within ``r``, the
triangle inequality keeps ``x`` near the border of ``j``: ``d(x, j) - d(x, i) <= 2r``, and in Euclidean space even
``d(x, j)^2 - d(x, i)^2 <= 2 r d(i, j)``. Such vectors are copied into the cells before their own, and cells are joined
independently: every pair of two cells is met once, in the one that comes first.

A cell of any size is cut into blocks of about ``block`` vectors, and two blocks are compared in a task by one matrix
product. Pairs are not written: a task returns how many vectors each one is linked with, and for components only as
many links as connect what is connected. Equal vectors are one row with a weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import int64, lists, stored
from snaplake.llm.components import components

SLACK = 1e-6  # of distances, far above what rounding makes


def _rows(column: pa.Array) -> np.ndarray:
    """A matrix of the vectors of a list column, which are of one length and not zero; each is multiplied by the power
    of two that brings it near 1, so that no product overflows."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cells_of(x: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The home cell of each unit vector, and which earlier cells it is copied into."""
    squared = 2 - 2 * x @ pivots.T
    home = squared.argmin(1)
    own = squared[np.arange(len(x)), home][:, None]
    between = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))[home]
    near = squared - own <= 2 * (radius + SLACK) * between + SLACK
    return home, near & (np.arange(len(pivots)) < home[:, None])


def linked(a: np.ndarray, b: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of a, row of b) of the pairs with a cosine of at least ``least``; without b, pairs i < j of a."""
    other = a if b is None else b
    cosine = (a @ other.T) / np.sqrt((a * a).sum(1))[:, None] / np.sqrt((other * other).sum(1))
    i, j = np.nonzero(cosine >= least)
    keep = i < j if b is None else slice(None)
    return i[keep], j[keep]


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest member of each node's component."""
    root = np.arange(n)
    while True:
        least = root.copy()
        m = np.minimum(root[i], root[j])
        np.minimum.at(least, i, m)
        np.minimum.at(least, j, m)
        least = least[least]
        if (least == root).all():
            return root
        root = least


def vector_links(
    vectors: DataFrame, least: float = 0.93, pivots: int = 256, per_pivot: int = 2000, block: int = 1024,
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """For each vector: vec_id, n_links (others at a cosine of at least ``least`` with the same label), component_id
    (the smallest vec_id that links reach), kept.

    Vectors that are null, zero or have null or non-finite components, and those without a label or id, have no links;
    so have two vectors of different lengths. Rows of equal ids and vectors are linked with each other; rows of one
    id and different vectors have links of their own, and one component, for it is ids that reach each other. At most
    ``pivots`` vectors, one for each ``per_pivot``, are read into the driver as pivots; results don't depend on them.
    """
    every = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    sound = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    classes = stored(
        # Each class has an id of its own: rows of one vec_id may have different vectors.
        every.filter(sound)
        .groupBy("label", "v")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
        .withColumns({"dim": F.size("v"), "node": F.monotonically_increasing_id()}),
        "vectors",
    )
    n = min(pivots, -(-classes.count() // per_pivot))
    chosen: dict[int, np.ndarray] = {}
    for r in classes.select("v", "dim", "rep").orderBy(F.xxhash64("rep", F.lit(17)), "rep").limit(n).collect():
        chosen[r["dim"]] = np.vstack([chosen.get(r["dim"], np.zeros((0, r["dim"]))), _unit(_rows(pa.array([r["v"]])))])
    radius = float(np.sqrt(max(0.0, 2 - 2 * least)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, nodes, vs = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = _unit(_rows(vs.take(pa.array(at))))
                home, near = cells_of(x, chosen[dim], radius) if dim in chosen else (np.zeros(len(at), int), np.zeros((len(at), 1), bool))
                yield pa.RecordBatch.from_arrays(
                    [nodes.take(pa.array(at)), int64(home), lists(int64(np.nonzero(near)[1]), near.sum(1))], names=["node", "home", "copies"]
                )

    placed = classes.select("dim", "node", "v").mapInArrow(place, "node long, home long, copies array<long>")
    rows = stored(classes.join(placed, "node"), "placed")
    cell = ["label", "dim", "cell"]
    homes = rows.select("label", "dim", F.col("home").alias("cell"), "node", "rep", "weight", "v")
    copies = rows.select("label", "dim", F.explode("copies").alias("cell"), "node", "rep", "weight", "v")
    sizes = (
        homes.select(*cell, F.lit(1).alias("h"), F.lit(0).alias("c"))
        .unionByName(copies.select(*cell, F.lit(0).alias("h"), F.lit(1).alias("c")))
        .groupBy(*cell)
        .agg(F.ceil(F.sum("h") / block).cast("long").alias("hs"), F.ceil(F.sum("c") / block).cast("long").alias("cs"))
    )
    of = lambda n: F.pmod(F.xxhash64("node"), n)
    row = [*cell, "node", "rep", "weight", "v"]
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1))
    h = homes.join(sizes, cell).withColumn("own", of(F.col("hs")))
    c = copies.join(sizes, cell).withColumn("own", of(F.col("cs")))
    within = h.select(*row, "own", F.explode(upto(F.col("hs"))).alias("o")).select(
        *row, F.lit(False).alias("copied"), F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), (F.col("own") > F.col("o")).alias("second")
    )
    across = h.select(*row, F.col("own").alias("i"), F.explode(upto(F.col("cs"))).alias("j"), F.lit(False).alias("second")).unionByName(
        c.select(*row, F.explode(upto(F.col("hs"))).alias("i"), F.col("own").alias("j"), F.lit(True).alias("second"))
    )
    units = within.unionByName(across.withColumn("copied", F.lit(True)))

    def compare(group: pa.Table) -> pa.Table:
        second = group["second"].to_numpy()
        copied, i, j = (group[k][0].as_py() for k in ("copied", "i", "j"))
        node, rep, weight = (group[k].to_numpy() for k in ("node", "rep", "weight"))
        x = _rows(group["v"].combine_chunks())
        first, other = np.flatnonzero(~second), np.flatnonzero(second)
        if not copied and i == j:
            a, b = linked(x, None, least)
        else:
            a, b = linked(x[first], x[other], least)
            a, b = first[a], other[b]
        found = np.zeros(len(node), np.int64)
        np.add.at(found, a, weight[b])
        np.add.at(found, b, weight[a])
        root, some = forest(a, b, len(node)), found > 0
        return pa.table({"node": int64(node[some]), "a": int64(rep[some]), "b": int64(rep[root[some]]), "n": int64(found[some])})

    met = stored(units.groupBy(*cell, "copied", "i", "j").applyInArrow(compare, "node long, a long, b long, n long"), "links")
    counts = met.groupBy("node").agg(F.sum("n").alias("n"))
    twins = every.filter(sound).join(classes.select("label", "v", "node", "rep", "weight"), ["label", "v"]).select("vec_id", "node", "rep", "weight")
    twins = stored(twins, "members")
    found = components(met.select("a", "b").unionByName(twins.select(F.col("rep").alias("a"), F.col("vec_id").alias("b"))))
    linked_rows = (
        twins.join(counts, "node", "left")
        .join(found.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    )
    alone = every.filter(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
