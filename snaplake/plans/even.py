"""Slices of about equal rows, whatever the distribution of the key, found by quantile sketches.

A sketch of the keys gives the boundaries, without sorting them. A key that holds so many rows that boundaries fall inside
it is cut by a hash of the other key columns: the sketch takes as many bits of it behind the key's as 63 leave. Boundaries
are few, and are all that reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slices that one sketch's boundaries are found for. More are found in two rounds: wide ranges, then slices in each.
AT_ONCE = 128
#: Error of a boundary's rank, as a share of a slice.
ERROR = 0.01


@dataclass(frozen=True)
class Boundary:
    """Where a slice begins: at a key, or, if the key reaches across, at a hash of the other key columns there."""

    key: int
    tie: int = 0


def size_for(slices: int) -> int:
    """The sketch size at which ranks are off by at most ``ERROR`` of a slice, with the sketch's published error curve."""
    wanted = ERROR / max(1, slices)
    return min(65_535, max(200, math.ceil((2.446 / wanted) ** (1 / 0.9433))))


def tie_bits(lo: int, hi: int) -> int:
    """Bits that the sketch has left for the hash, of a key from ``lo`` to ``hi``: of a key that needs them all, none."""
    return max(0, 63 - max(1, (hi - lo).bit_length()))


def tie_of(others: Sequence[str], bits: int) -> Column:
    """A number of so many bits that tells the rows of one key apart; 0 if nothing does."""
    if not others or not bits:
        return F.lit(0).cast("long")
    return F.shiftrightunsigned(F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in others]), 64 - bits)


def at_or_after(key: Column, tie: Column, b: Boundary) -> Column:
    """Row test; a null key comes before every boundary."""
    test = key >= F.lit(b.key) if b.tie == 0 else (key > F.lit(b.key)) | ((key == F.lit(b.key)) & (tie >= F.lit(b.tie)))
    return F.coalesce(test, F.lit(False))


def in_slice(key: Column, tie: Column, low: Boundary | None, high: Boundary | None) -> Column:
    """Row test of a slice from ``low`` up to ``high``; either is None at the table's ends."""
    test = F.lit(True) if low is None else at_or_after(key, tie, low)
    return test if high is None else test & ~at_or_after(key, tie, high)


def slice_of(key: Column, tie: Column, boundaries: Sequence[Boundary]) -> Column:
    """The number of the slice that takes a row: of boundaries in order, how many it is at or after."""
    keys, ties = _constants([b.key for b in boundaries]), _constants([b.tie for b in boundaries])

    def after(i: Column) -> Column:
        return (key > F.get(keys, i)) | ((key == F.get(keys, i)) & (tie >= F.get(ties, i)))

    return _passed(len(boundaries), after)


def _constants(numbers: Sequence[int]) -> Column:
    """An array of longs, as one literal: a column for each would take the driver kilobytes a number."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")


def _passed(n: int, after: Callable[[Column], Column]) -> Column:
    """Of ``n`` boundaries in order, how many a row is at or after: ``after`` tests one, and halving finds the last."""
    if n == 0:
        return F.lit(0)

    def ahead(at: Column, step: Column) -> Column:
        test = (at + step <= n) & F.coalesce(after(at + step - 1), F.lit(False))
        return F.when(test, at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(1 << s) for s in reversed(range(n.bit_length()))]), F.lit(0), ahead)


def even_boundaries(rows: DataFrame, key: str, lo: int, hi: int, slices: int, others: Sequence[str] = ()) -> list[Boundary]:
    """The boundaries between at most ``slices`` slices, in order; ``key`` is an integer column with values from ``lo`` to
    ``hi``, and any that came later count as those.

    One pass over the key columns, two if there are more than ``AT_ONCE`` slices, each a partial aggregate of sketches: no
    sort, and a shuffle of the sketches only. Without ``others``, a key that alone exceeds a slice stays in one.
    """
    if slices <= 1:
        return []
    bits = tie_bits(lo, hi)
    key_column = F.col("`" + key.replace("`", "``") + "`").cast("long")
    inside = F.least(F.greatest(key_column, F.lit(lo)), F.lit(hi))
    if hi - lo < 1 << 63:
        mixed = F.shiftleft(inside - F.lit(lo), bits).bitwiseOR(tie_of(others, bits))
    else:  # a span of 64 bits: keys as they are
        mixed, lo, bits = inside, 0, 0
    keyed = rows.filter(key_column.isNotNull()).select(mixed.alias("c"))
    wide = math.ceil(slices / AT_ONCE)
    if wide == 1:
        found = _boundaries(keyed, F.lit(0), slices)[0]
    else:  # the first ranges have a slice more, so that there are as many as were asked for
        each, more = divmod(slices, wide)
        outer = _quantiles(keyed, F.lit(0), wide, lambda s: _at(s, [(g * each + min(g, more)) / slices for g in range(1, wide)]))[0]
        edges = _constants(outer)
        passed = _passed(len(outer), lambda i: F.col("c") >= F.get(edges, i))
        found = sorted(set(outer).union(*_boundaries(keyed, passed, each, more).values()))
    return [Boundary((c >> bits) + lo, c & ((1 << bits) - 1)) for c in found]


def _at(sketch: str, ranks: Sequence[float]) -> Column:
    return F.kll_sketch_get_quantile_bigint(sketch, F.array(*[F.lit(r) for r in ranks]))


def _boundaries(keyed: DataFrame, group: Column, slices: int, more: int = 0) -> dict[int, list[int]]:
    """Distinct boundaries inside each group of rows: ``slices`` slices for each, one more for the first ``more`` groups."""
    ranks = [[i / n for i in range(1, n)] for n in (slices + 1, slices)]
    inner = _quantiles(keyed, group, slices + 1, lambda s: F.when(F.col("g") < more, _at(s, ranks[0])).otherwise(_at(s, ranks[1])))
    return {g: sorted(set(c)) for g, c in inner.items()}


def _quantiles(keyed: DataFrame, group: Column, slices: int, of: Callable[[str], Column]) -> dict[int, list[int]]:
    """What ``of`` takes from each group's sketch, in order; of no rows, nothing in group 0."""
    sketch = F.kll_sketch_agg_bigint("c", F.lit(size_for(slices))).alias("s")
    rows = keyed.groupBy(group.alias("g")).agg(sketch).select("g", of("s").alias("c"))
    return {0: []} | {r["g"]: sorted(r["c"]) for r in rows.collect()}
