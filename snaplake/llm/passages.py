"""Repeated passages: compact windows over the min-hashes of word shingles.

For a hash function, the shingle with the smallest hash stands for a passage. All passages of ``t`` shingles or more
that a shingle stands for make a compact window: the shingle's place ``c``, and the widest stretch ``l..r`` around it
without a smaller hash. These are the nodes of the Cartesian tree over the hashes that are wide enough, about
``2n / (t + 1)`` for ``n`` shingles. Two similar passages of two documents are stood for by the same shingle, under
each function, with the probability of their Jaccard similarity.

Windows meet by function and shingle. A task first joins its own with the earliest of them, and only each signature's
earliest window goes on, in packed rows, to the tasks that join them with the earliest of all; so a signature that a
third of all documents have costs one row a task, and as many candidates as it has windows. Candidates of a pair of
documents are joined by their intervals: where windows of enough functions overlap along a diagonal, the passage around
them is read from both texts and verified on its shingles.

The earliest document of a signature may have only a part of the passage that later ones share. So the windows that no
found passage holds meet again without it: all of a signature that are left, and those of them that also agree in the
smallest hash of the shingles before or behind, under ``DRAWS`` functions. Whoever has just a part of the passage, or one of
its lines, has some of those shingles and not others. Each of these groups is joined with its earliest window again, so a
window costs a fixed number of rows and candidates however many share its signature.

Then texts meet by runs, whatever their signatures: of every ``shortest`` words in a row, a run of half as many is drawn by its hash. Around runs
that several documents have, all runs of ``shortest`` words meet. Who has such a run first has the passage itself, in
whichever task it was read. Only those inside an exact repeat of an earlier document are left out, since that one has them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import blocks, few, give_back, int64, lists, mix, new_name, small_enough, stored, stream, words

SHORTEST = 50  # words of a passage
WIDTH = 5
FUNCTIONS, ENOUGH = 4, 2
SIMILAR = 0.8
DRIFT = 32  # words by which a passage may shift against its first occurrence
REACH = (1 << 10) - 1  # shingles on a side of its own within which a window is compared with others again
DRAWS = 2  # functions that draw a shingle on each side of a window's own
CHUNK = 1 << 19  # windows that a task joins among themselves at a time
BUCKET_BYTES = 1 << 27  # of texts, whose windows are less than a third more than that
HOT_ROWS, HOT_KEYS = 1 << 12, 1 << 12  # rows from which a key is hot; keys that are so at most, of any number of rows
PART = 16  # one in so many runs, or rows, says how all are joined
KEPT_PLACES = 1 << 20  # places of a text, over all diagonals, whose matches are kept while its seeds are gone through
_U = np.uint64
WINDOW = np.dtype([("key", "<u8"), ("doc", "<i8"), ("c", "<i4"), ("l", "<i4"), ("r", "<i4"), ("f", "<i4")])
SEED = ("f", "ac", "al", "ar", "c", "l", "r")
PAIR = f"a long, b long, fs long, seeds array<struct<{', '.join(f'{x}: int' for x in SEED)}>>"
AGAIN = "run long, doc long, f int, c int, l int, r int"
FOUND = "doc_id long, text_hash long, start long, length long, words long, first_doc_id long, similarity double, b0 long, b1 long, s0 int, s1 int, same boolean"
RUN = "run long, doc long, c int, open boolean"


def block_shingles(hashes: np.ndarray, first: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The shingle that begins at each word of a block, 0 where the text ends before it does."""
    out = np.zeros(len(hashes), np.uint64)
    n = len(hashes) - width + 1
    if n > 0:
        factors = stream(width, 2) | _U(1)
        for k in range(width):
            out[:n] += hashes[k : k + n] * factors[k]
        out = mix(out) | _U(1)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(hashes))
    out[left < width] = 0
    return out


def _sliding(a: np.ndarray, t: int, op) -> np.ndarray:
    n, span = len(a) - t + 1, 1
    while span * 2 <= t:
        a = op(a[:-span], a[span:])
        span *= 2
    return op(a[:n], a[t - span : t - span + n]) if t > span else a[:n]


def compact_windows(h: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(c, l, r) of the nodes of width ``t`` or more of the Cartesian tree over ``h``; zeros part texts. Of equal
    hashes the first is the upper.

    What cuts a node off on a side belongs to a wider node, so only hashes that are the smallest of some ``t`` in a row
    have to be looked at.
    """
    none = np.zeros(0, np.int64)
    if len(h) < t:
        return none, none, none
    least = np.zeros(len(h) + t - 1, np.uint64)
    least[t - 1 : len(h)] = _sliding(h, t, np.minimum)
    places = np.flatnonzero((_sliding(least, t, np.maximum) == h) | (h == 0))
    values = h[places].tolist()
    c, l, r = [], [], []
    stack: list[tuple[int, int, int]] = []  # value, place, left end
    for place, value in zip(places.tolist(), values):
        while stack and stack[-1][0] > value:
            _, p, left = stack.pop()
            if place - left >= t:
                c.append(p)
                l.append(left)
                r.append(place - 1)
        stack.append((value, place, stack[-1][1] + 1 if stack else 0))
    for value, p, left in stack:
        if value and len(h) - left >= t:
            c.append(p)
            l.append(left)
            r.append(len(h) - 1)
    return np.array(c, np.int64), np.array(l, np.int64), np.array(r, np.int64)


def _group(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the earliest window of each signature, candidates of it and a later document's)."""
    w = w[np.lexsort((w["c"], w["doc"], w["key"]))]
    new = np.ones(len(w), bool)
    new[1:] = w["key"][1:] != w["key"][:-1]
    hub = np.flatnonzero(new)[np.cumsum(new) - 1] if len(w) else np.zeros(0, np.int64)
    later = np.flatnonzero(w["doc"] != w["doc"][hub])
    return w[new], np.stack([w[hub[later]], w[later]], 1) if len(later) else np.zeros((0, 2), WINDOW)


def candidates(docs: DataFrame, shortest: int, width: int, functions: int, buckets: int) -> DataFrame:
    """(a, b, fs, seeds): windows of document b with the signature of a window of the earlier document a, and a bit for
    each of their functions. What a task or a bucket finds for two documents is a row, however many windows they share.
    """
    t = shortest - width + 1
    seeds = stream(functions, 11)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, data, bounds in blocks(batch.column(1)):
                hashes, _, _, first = words(data, bounds)
                shingle = block_shingles(hashes, first, width)
                for f in range(functions):
                    h = mix(shingle ^ seeds[f])
                    h[shingle == 0] = 0
                    c, left, r = compact_windows(h, t)
                    doc = np.searchsorted(first, c, "right") - 1
                    w = np.empty(len(c), WINDOW)
                    w["key"], w["doc"], w["f"] = h[c], ids[row + doc], f
                    w["c"], w["l"], w["r"] = c - first[doc], left - first[doc], r - first[doc]
                    held.append(w)
                    n += len(w)
                if n >= CHUNK:
                    yield packed(np.concatenate(held))
                    held, n = [], 0
        if held:
            yield packed(np.concatenate(held))

    def packed(w: np.ndarray) -> pa.RecordBatch:
        hubs, pairs = _group(w)
        pairs = pairs[np.lexsort((pairs["doc"][:, 1], pairs["doc"][:, 0]))]
        bucket = (hubs["key"] >> _U(33)) % _U(buckets)
        order = np.argsort(bucket, kind="stable")
        hubs, cuts = hubs[order], np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        parts = [(k, hubs[x:y].tobytes(), b"") for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x]
        # What was found here goes to the buckets in even parts, just to come out with the rest. Each chunk begins elsewhere.
        begin = int(hubs["key"][0] % _U(buckets)) if len(hubs) else 0
        parts += [((begin + k) % buckets, b"", p.tobytes()) for k, p in enumerate(np.array_split(pairs, -(-len(pairs) // 4096))) if len(p)] if len(pairs) else []
        ks, hs, ps = zip(*parts) if parts else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array(hs, pa.binary()), pa.array(ps, pa.binary())], names=["bucket", "hubs", "pairs"])

    def merge(group: pa.Table) -> pa.Table:
        give_back()  # what the group before has left
        read = lambda c: np.frombuffer(b"".join(group[c].to_pylist()), WINDOW)
        found = np.concatenate([_group(read("hubs"))[1], read("pairs").reshape(-1, 2)])
        found = found[np.lexsort((found["doc"][:, 1], found["doc"][:, 0]))]
        a, b = found[:, 0], found[:, 1]
        first = np.flatnonzero(np.concatenate([[True], (a["doc"][1:] != a["doc"][:-1]) | (b["doc"][1:] != b["doc"][:-1])])[: len(a)])
        bits = np.bitwise_or.reduceat(1 << a["f"].astype(np.int64), first) if len(a) else np.zeros(0, np.int64)
        ints = [pa.array(np.ascontiguousarray(x)) for x in (a["f"], a["c"], a["l"], a["r"], b["c"], b["l"], b["r"])]
        seeds = lists(pa.StructArray.from_arrays(ints, names=SEED), np.diff(np.append(first, len(a))))
        return pa.table([int64(a["doc"][first]), int64(b["doc"][first]), int64(bits), seeds], names=["a", "b", "fs", "seeds"])

    packed_rows = docs.mapInArrow(windows, "bucket int, hubs binary, pairs binary")
    return packed_rows.groupBy("bucket").applyInArrow(merge, PAIR)


def _index(sa: np.ndarray, sb: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where a has each shingle of b: (places of a by shingle, the same with their shingle's first, first, last + 1)."""
    order = np.argsort(sa, kind="stable")
    ordered = sa[order]
    lo, hi = np.searchsorted(ordered, sb, "left"), np.searchsorted(ordered, sb, "right")
    new = np.ones(len(sa), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(sa) else order
    return order, (first << 32) + order, lo, hi


def _matches(index: tuple[np.ndarray, ...], sb: np.ndarray, diagonal: int) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle of b: does a have it near the diagonal, and where (nearest to it, of two the first)."""
    order, by_shingle, lo, hi = index
    want = np.arange(len(sb)) + diagonal
    at = np.full(len(sb), -(1 << 40))
    single = hi > lo
    at[single] = order[lo[single]]
    k = np.flatnonzero(hi > lo + 1)  # shingles that a has several times
    if len(k):
        place = np.searchsorted(by_shingle, (lo[k] << 32) + np.maximum(want[k], 0))
        before, behind = (order[np.clip(p, lo[k], hi[k] - 1)] for p in (place - 1, place))
        at[k] = np.where(np.abs(before - want[k]) <= np.abs(behind - want[k]), before, behind)
    return (np.abs(at - want) <= DRIFT) & (sb != 0), at


def verified_passages(
    sa: np.ndarray, sb: np.ndarray, seeds: np.ndarray, shortest: int, width: int, enough: int, similar: float, whole: bool = False
) -> list[tuple[int, int, float]]:
    """(first shingle, last shingle, similarity) of the passages of b that a has as well, by shingles of both texts.

    ``seeds`` are (f, ac, al, ar, c, l, r). A shingle that a has near the seed's diagonal counts for a passage, one
    that it hasn't counts four times against it (at 0.8); the passage around a seed that gains most is verified. With ``whole``, a seed is an equal run ``l..r`` of both, and done when a passage has
    all of it.
    """
    t, found = shortest - width + 1, []
    against = similar / (1 - similar) if similar < 1 else float(len(sb) + 1)
    s = np.asarray(seeds, np.int64).reshape(-1, 7)
    s = s[np.lexsort((s[:, 1], s[:, 0], s[:, 4]))]
    f, c, left, right, diagonal = s[:, 0], s[:, 4], s[:, 5], s[:, 6], s[:, 1] - s[:, 4]
    index, bits = _index(sa, sb), 1 << f
    known: dict[int, tuple] = {}
    failed: set[tuple[int, int, int]] = set()
    for k in range(len(s)):
        if any(x <= left[k] and right[k] <= y if whole else x <= c[k] <= y for x, y, _ in found):
            continue
        shared = np.minimum(right, right[k]) - np.maximum(left, left[k]) + 1 >= t
        if not whole and int(np.bitwise_or.reduce(bits[shared & (np.abs(diagonal - diagonal[k]) <= DRIFT)])).bit_count() < enough:
            continue
        d = int(diagonal[k])
        if d not in known:
            if len(known) * len(sb) > KEPT_PLACES:  # long texts with seeds on very many diagonals: looked up again if need be
                known.clear()
            hit, at = _matches(index, sb, d)
            known[d] = hit, at, np.concatenate([[0.0], np.cumsum(np.where(hit, 1.0, -against))]), _breaks(hit, at)
        hit, at, gain, breaks = known[d]
        if not hit[c[k]]:
            continue
        x, y = int(gain[: c[k] + 1].argmin()), int(c[k] + gain[c[k] + 1 :].argmax())
        for second in (False, True):
            if second:
                x, y = _run(breaks, len(hit), int(c[k]))
            if y - x + 1 < t or (d, x, y) in failed or any((x, y) == f[:2] for f in found):
                continue
            own = at[x : y + 1][hit[x : y + 1]]
            one, two = _distinct(sa[own.min() : own.max() + 1]), _distinct(sb[x : y + 1])
            one, two = one[one != 0], two[two != 0]
            common = len(np.intersect1d(one, two, assume_unique=True))
            similarity = common / (len(one) + len(two) - common)
            if similarity >= similar:
                found.append((x, y, similarity))
                break
            failed.add((d, x, y))  # other seeds of the diagonal lead here too
    return found


def _distinct(s: np.ndarray) -> np.ndarray:
    s = np.sort(s)
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    return s[new]


def _breaks(hit: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The shingles that don't follow in both texts the one before."""
    return np.flatnonzero(~hit[1:] | ~hit[:-1] | (at[1:] - at[:-1] != 1)) + 1


def _run(breaks: np.ndarray, n: int, c: int) -> tuple[int, int]:
    """The run of shingles around ``c``, of ``n``, that follow each other in both texts."""
    k = np.searchsorted(breaks, c, "right")
    return (int(breaks[k - 1]) if k else 0), (int(breaks[k]) if k < len(breaks) else n) - 1


def repeated_passages(
    docs: DataFrame, shortest: int = SHORTEST, width: int = WIDTH, functions: int = FUNCTIONS, enough: int = ENOUGH, similar: float = SIMILAR,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """A row for each passage of ``shortest`` words or more that an earlier document has as well: doc_id, text_hash
    (xxhash64 of the text), start and length (characters), words, first_doc_id, similarity (of the shingle sets).

    Earlier is the document with the smaller id that has the passage's signature first. Passages that a document
    repeats within itself don't count. Rows of one id are one document and not compared with each other; the text hash
    says whose passage it is. Rows without an id, null, empty and shorter texts have none. Other columns are left out.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).filter("doc_id is not null and text is not null")
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    met = stored(candidates(base, shortest, width, functions, buckets), "passage-candidates")
    pairs = _pairs(met, enough, F.flatten(F.collect_list("seeds")))
    found = stored(_verified(base, pairs, shortest, width, enough, similar), "passages")
    again = _first_met(stored(_drawn_again(base, met, found, shortest, width, functions), "passage-again"), "l", "r")
    seed = F.struct("f", F.col("hub.c").alias("ac"), F.col("hub.l").alias("al"), F.col("hub.r").alias("ar"), "c", "l", "r")
    again = again.select("a", "b", F.expr("shiftleft(1L, f)").alias("fs"), seed.alias("seed"))
    more = _verified(base, _pairs(again, enough, F.collect_set("seed")), shortest, width, enough, similar)
    found = stored(found.unionByName(more), "passages")

    t, half = shortest - width + 1, max(1, shortest // 2 - width + 1)
    known = stored(found.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(F.collect_set(F.struct("s0", "s1", "same")).alias("known")), "passage-known")
    drawn = _met(stored(_runs(base, known, None, half, t, width), "passage-runs"))
    drawn = stored(drawn, "passage-runs")
    places = drawn.select(F.col("b").alias("doc"), "c").unionByName(drawn.select(F.col("a").alias("doc"), F.col("ac").alias("c")))
    places = stored(places.groupBy("doc").agg(F.collect_set("c").alias("places")), "passage-places")
    whole = _met(stored(_runs(base, known, places, half, t, width), "passage-runs"))
    met = drawn.filter("open").withColumn("size", F.lit(half)).unionByName(whole.withColumn("size", F.lit(t)))
    # Runs that follow each other on a diagonal overlap: one of a stretch stands for all.
    step = F.floor(F.col("c") / max(1, half // 2))
    met = met.groupBy("a", "b", "size", (F.col("ac") - F.col("c")).alias("d"), step.alias("step")).agg(F.min("c").alias("c"), F.max("c").alias("last"))
    seed = [F.lit(0).alias("f"), (F.col("c") + F.col("d")).alias("ac"), F.lit(0).alias("al"), F.lit(0).alias("ar"), "c", F.col("c").alias("l"), (F.col("last") + F.col("size") - 1).alias("r")]
    met = stored(met.groupBy("a", "b").agg(F.collect_list(F.struct(*seed)).alias("seeds")), "passage-pairs")
    more = _verified(base, met, shortest, width, 1, similar, whole=True)
    return found.unionByName(more).drop("s0", "s1", "same").distinct()


def _pairs(met: DataFrame, enough: int, seeds: Column) -> DataFrame:
    """(a, b, seeds) of documents that windows of ``enough`` functions make candidates."""
    pairs = met.groupBy("a", "b").agg(F.bit_or("fs").alias("fs"), seeds.alias("seeds"))
    return stored(pairs.filter(F.bit_count("fs") >= enough).drop("fs"), "passage-pairs")


def _drawn_again(base: DataFrame, met: DataFrame, found: DataFrame, shortest: int, width: int, functions: int) -> DataFrame:
    """Rows of AGAIN: the later windows of ``met`` that no passage of ``found`` holds, once by their signature alone and
    twice for each draw by that and a shingle nearby."""
    t, seeds, draws = shortest - width + 1, stream(functions, 11), stream(2 * DRAWS + 1, 12)
    near = t // 2
    several = base.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("x"), F.max(F.xxhash64("text")).alias("y")).filter("x <> y")
    spans = found.groupBy(F.col("doc_id").alias("b")).agg(F.collect_set(F.struct("s0", "s1")).alias("spans"))
    spans = spans.join(several, F.col("b") == F.col("doc_id"), "left_anti")  # their windows may be another text's
    # A window in one number: place, function, and how far it goes before and behind, if not farther than REACH.
    lean = lambda x: F.least(x, F.lit(REACH))
    number = lambda s: ((s["c"].cast("long") * functions + s["f"]) * (REACH + 1) + lean(s["c"] - s["l"])) * (REACH + 1) + lean(s["r"] - s["c"])
    numbers = met.select("b", F.transform("seeds", number).alias("windows")).groupBy("b").agg(F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows"))
    windows = numbers.join(spans, "b", "left")
    place = lambda w: (w - w % (functions * (REACH + 1) ** 2)) / (functions * (REACH + 1) ** 2)
    is_left = lambda w: ~F.coalesce(F.exists("spans", lambda s: (s["s0"] <= place(w)) & (place(w) <= s["s1"])), F.lit(False))
    left = stored(windows.select("b", F.filter("windows", is_left).alias("windows")).filter(F.size("windows") > 0), "passage-left")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in blocks(batch.column(1)):
                hashes, _, _, first = words(data, bounds)
                shingle = block_shingles(hashes, first, width)
                w, counts = _entries(batch.column(2).slice(row, len(bounds) - 1))
                w, doc = w.to_numpy(), np.repeat(np.arange(len(counts)), counts)
                w, behind = np.divmod(w, REACH + 1)
                w, before = np.divmod(w, REACH + 1)
                c, f = np.divmod(w, functions)
                own = c < np.diff(first)[doc]  # of rows of one id, another one may be longer
                doc, f, c, before, behind = doc[own], f[own], (c + first[doc])[own], before[own], behind[own]
                if not len(c):
                    continue
                left, right = np.maximum(c - before, first[doc]), np.minimum(c + behind, first[doc + 1] - 1)
                rest = [f, *(x - first[doc] for x in (c, left, right))]
                columns = [int64(batch.column(0).to_numpy()[row + doc]), *[pa.array(x.astype(np.int32)) for x in rest]]
                for run in keys(shingle, mix(shingle[c] ^ seeds[f]), c, left, right):
                    yield pa.RecordBatch.from_arrays([int64(run), *columns], names=[x.split()[0] for x in AGAIN.split(", ")])

    def keys(s: np.ndarray, key: np.ndarray, c: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[np.ndarray]:
        yield mix(key + draws[0])
        before = np.stack([np.maximum(left, c - near), c], 1).ravel()
        behind = np.stack([c + 1, np.minimum(right, c + near) + 1], 1).ravel()
        for j in range(DRAWS):
            h = np.append(mix(s ^ draws[1 + j]), np.zeros(2, np.uint64))  # room for what ends with the text
            yield mix(mix(key + draws[1 + j]) + np.minimum.reduceat(h, before)[::2])
            yield mix(mix(key + draws[1 + DRAWS + j]) + np.minimum.reduceat(h, behind)[::2])

    rows = base.join(small_enough(left, "windows"), F.col("doc_id") == F.col("b"))
    return rows.select("doc_id", "text", "windows").mapInArrow(draw, AGAIN)


def _first_met(runs: DataFrame, *more: str) -> DataFrame:
    """The rows of stored ``runs`` but the earliest document's, each with its run's earliest row: a, hub, b and the rest.

    All are joined where their rows are read if the runs of several documents are few; a part of all runs, with all
    rows of each, says whether that can be. Else rows meet by one shuffle, in the order of their documents, but for
    runs that a part of all rows shows to be of very many: those are joined where they are read. There are about
    ``HOT_KEYS`` of them at most. Neither part decides what is met, only how.
    """
    ends = runs.groupBy("run").agg(F.min("doc").alias("a"), F.max("doc").alias("z"), F.count("*").alias("n")).filter("a < z").drop("z")
    hub, rest = F.struct("doc", "c", *more), [c for c in runs.columns if c not in ("run", "doc")]
    if few(ends.filter(F.pmod("run", F.lit(PART)) == 0), PART):
        ends = stored(ends, "passage-ends")
        small = small_enough(ends)
        if small is not ends:  # Only their rows go on.
            shared = stored(runs.join(small, "run"), "passage-shared")
            first = shared.filter("doc = a").groupBy("run").agg(F.min(hub).alias("hub"))
            both = shared.filter("doc <> a").join(F.broadcast(first), "run")  # as many rows as ``ends``
            return both.select("a", F.col("doc").alias("b"), "hub", *rest)
    many = max(HOT_ROWS, runs.count() // HOT_KEYS)
    drawn = runs.filter(F.pmod(F.xxhash64("doc", "c"), F.lit(PART)) == 0).groupBy("run").count()
    hot = stored(drawn.filter(F.col("count") > many // PART).select("run"), "passage-hot")
    in_turn = Window.partitionBy("run").orderBy("doc", "c", *more).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = runs.join(F.broadcast(hot), "run", "left_anti")
    both = both.withColumn("hub", F.struct(*[F.first(c).over(in_turn).alias(c) for c in ("doc", "c", *more)]))  # made behind the shuffle
    if hot.count():
        own = stored(runs.join(F.broadcast(hot), "run"), "passage-shared")
        both = both.unionByName(own.join(F.broadcast(own.groupBy("run").agg(F.min(hub).alias("hub"))), "run"))
    return both.filter("doc <> hub.doc").select(F.col("hub.doc").alias("a"), F.col("doc").alias("b"), "hub", *rest)


def _met(runs: DataFrame) -> DataFrame:
    """(a, b, ac, c, open): runs of document b that the earlier document a has first."""
    return _first_met(runs).select("a", "b", F.col("hub.c").alias("ac"), "c", "open")


def _runs(base: DataFrame, known: DataFrame, places: DataFrame | None, half: int, t: int, width: int) -> DataFrame:
    """Rows of RUN, in shingles: the runs of ``half`` that are the smallest of some ``t`` in a row, or the runs of ``t``
    that hold one at ``places``. ``open`` are those that no known passage has whole."""

    drawing = places is None
    size = half if drawing else t

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, data, bounds in blocks(batch.column(1)):
                hashes, _, _, first = words(data, bounds)
                shingle = block_shingles(hashes, first, width)
                if len(shingle) < t:
                    continue
                # Runs that go beyond their text are 0 and the smallest of any that hold one.
                h, texts = _rolled(shingle, size), slice(row, row + len(bounds) - 1)
                h[(np.repeat(first[1:], np.diff(first)) - np.arange(len(hashes)))[: len(h)] < size + width - 1] = 0
                lo, hi, same = _spans(batch.column(2)[texts], first)
                if drawing:
                    span = t - half + 1
                    least = np.zeros(len(h) + span - 1, np.uint64)
                    least[span - 1 : len(h)] = _sliding(h, span, np.minimum)
                    at = np.flatnonzero((_sliding(least, span, np.maximum) == h) & (h != 0))
                    is_open = ~_starts(lo, hi, half, len(h))[at]
                else:
                    c, counts = _entries(batch.column(3)[texts])
                    c, begin = c.to_numpy().astype(np.int64), np.repeat(first[:-1], counts)
                    inside = _starts(np.maximum(c + half - t, 0) + begin, np.minimum(c + begin, np.repeat(first[1:], counts) - 1) + t - 1, t, len(h))
                    at = np.flatnonzero(inside & (h != 0) & ~_starts(lo[same], hi[same], t, len(h)))
                    is_open = np.ones(len(at), bool)
                doc = np.searchsorted(first, at, "right") - 1
                columns = [int64(h[at]), int64(ids[row + doc]), pa.array((at - first[doc]).astype(np.int32)), pa.array(is_open)]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in RUN.split(", ")])

    rows = base.withColumn("hash", F.xxhash64("text"))
    if places is not None:
        rows = rows.join(small_enough(places, "places"), F.col("doc_id") == F.col("doc"))
    rows = rows.join(small_enough(known, "known"), (F.col("doc_id") == F.col("d")) & (F.col("hash") == F.col("h")), "left")
    return rows.select("doc_id", "text", "known", *(["places"] if places is not None else [])).mapInArrow(run, RUN)


def _entries(column: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """What the lists of a column hold, end to end, and how much each has; null is empty."""
    return column.flatten(), column.value_lengths().fill_null(0).to_numpy()


def _spans(column: pa.ListArray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, same) of the known passages of a block's texts, by places of the block."""
    held, counts = _entries(column)
    lo, hi, same = held.flatten()
    begin = np.repeat(first[:-1], counts)
    return lo.to_numpy().astype(np.int64) + begin, hi.to_numpy().astype(np.int64) + begin, same.to_numpy(zero_copy_only=False).astype(bool)


def _starts(lo: np.ndarray, hi: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` places begin a run of ``size`` that lies within a span."""
    change = np.zeros(n + 1, np.int64)
    some = (hi - lo + 1 >= size) & (lo < n) & (hi - size + 1 >= 0)
    np.add.at(change, np.maximum(lo[some], 0), 1)
    np.add.at(change, np.minimum(hi[some] - size + 2, n), -1)
    return np.cumsum(change[:-1]) > 0


def _rolled(s: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` shingles, doubled up as a power of a fixed factor."""
    n, out, done, factor = len(s) - size + 1, np.zeros(max(0, len(s) - size + 1), np.uint64), 0, _U(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        part, span, power = mix(s), 1, factor
        while True:
            if size & span:
                out = out * power + part[done : done + n]
                done += span
            span *= 2
            if span > size:
                return mix(out + _U(size))
            part, power = part[: -(span // 2)] * power + part[span // 2 :], power * power


def _verified(base: DataFrame, pairs: DataFrame, shortest: int, width: int, enough: int, similar: float, whole: bool = False) -> DataFrame:
    """The passages of stored ``pairs``, as rows of FOUND."""
    roles = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("doc_id"), F.lit(1).alias("role")), F.struct(F.col("b").alias("doc_id"), F.lit(2).alias("role")))).alias("x"))
    ids = stored(roles.groupBy("x.doc_id").agg(F.bit_or("x.role").alias("roles")), "passage-ids")
    texts = stored(base.join(small_enough(ids), "doc_id"), "passage-texts")
    # Most documents are only the earlier or only the later of their pairs: their texts go one way.
    earlier, later = (texts.filter(F.col("roles").bitwiseAND(role) != 0) for role in (1, 2))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sa = (None, None), np.zeros(0, np.uint64)
        for batch in batches:
            out: list[tuple] = []
            ids, bs, hashes_of, pair_seeds, ta, tb = (batch.column(k) for k in range(6))
            for row, data, bounds in blocks(tb):
                hashes, starts, ends, first = words(data, bounds)
                shingle = block_shingles(hashes, first, width)
                for k in range(row, row + len(bounds) - 1):
                    a = ta[k].as_buffer().to_pybytes()
                    if (ids[k].as_py(), a) != last:
                        h, _, _, only = words(np.frombuffer(a, np.uint8), np.array([0, len(a)]))
                        last, sa = (ids[k].as_py(), a), block_shingles(h, only, width)
                    begin, own = bounds[k - row], slice(first[k - row], first[k - row + 1])
                    b, sb = data[begin : bounds[k - row + 1]].tobytes(), shingle[own]
                    if a == b and len(sa) >= shortest:
                        spans = [(0, len(sb) - width, 1.0, True)]
                    else:
                        seeds = np.stack([x.to_numpy() for x in pair_seeds[k].values.flatten()], 1)
                        passed = verified_passages(sa, sb, seeds, shortest, width, enough, similar, whole)
                        spans = [(*p, p[2] == 1 and sb[p[0] : p[1] + 1].tobytes() in sa.tobytes()) for p in passed]
                    for x, y, similarity, same in spans:
                        at, end = int(starts[own][x] - begin), int(ends[own][y + width - 1] - begin)
                        start, length = len(b[:at].decode("utf-8")), len(b[at:end].decode("utf-8"))
                        out.append((bs[k].as_py(), hashes_of[k].as_py(), start, length, y - x + width, ids[k].as_py(), similarity, at, end, x, y, same))
            columns = list(zip(*out)) if out else [[]] * 12
            kinds = [pa.int64()] * 6 + [pa.float64()] + [pa.int64()] * 2 + [pa.int32()] * 2 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in FOUND.split(", ")])
            give_back()

    # A document that very many begin with is dealt to several tasks, with a copy of its text in each.
    many = max(HOT_ROWS, pairs.count() // HOT_KEYS)
    hot = stored(pairs.groupBy("a").count().filter(F.col("count") > many).select("a", F.ceil(F.col("count") / many).cast("int").alias("parts")), "passage-hot")
    dealt = pairs.join(F.broadcast(hot), "a", "left").withColumn("part", F.pmod(F.hash("b"), F.coalesce("parts", F.lit(1)))).drop("parts")
    firsts = earlier.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")).join(F.broadcast(hot), "a", "left")
    firsts = firsts.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    both = dealt.join(later.select(F.col("doc_id").alias("b"), F.xxhash64("text").alias("text_hash"), F.col("text").alias("tb")), "b")
    both = both.join(firsts, ["a", "part"])
    return both.select("a", "b", "text_hash", "seeds", "ta", "tb").mapInArrow(verify, FOUND)


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows and columns of ``docs``, without the passages that an earlier document has: the earliest keeps its own.
    A text that was nothing but such passages becomes empty."""
    found = repeated_passages(docs, doc_id=doc_id, text=text, **options)
    spans = found.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("b0", "b1"))).alias("spans"))
    own_id, own_hash, own_spans = (new_name() for _ in range(3))
    spans = stored(spans.select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash), F.col("spans").alias(own_spans)), "passage-spans")

    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts, spans_of = batch.column(at), batch.column(batch.num_columns - 1)
            new = []
            for t, s in zip(texts, spans_of):
                if s.is_valid:
                    data, kept, done = t.as_py().encode("utf-8"), [], 0
                    for span in s.as_py():
                        if span["b1"] > done:
                            kept.append(data[done : max(done, span["b0"])])
                            done = span["b1"]
                    new.append(b"".join([*kept, data[done:]]).decode("utf-8"))
                else:
                    new.append(t.as_py())
            columns = [pa.array(new, pa.string()) if k == at else batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = docs.join(small_enough(spans, own_spans), (docs[doc_id].cast("long") == F.col(own_id)) & (F.xxhash64(docs[text]) == F.col(own_hash)), "left")
    return joined.select(*[docs[c] for c in docs.columns], own_spans).mapInArrow(cut, docs.schema)
