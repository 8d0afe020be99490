"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

The CGK random walk maps a word sequence to a longer one: at step ``j`` it writes the current word, and a random bit for
(step, word) says whether to go on to the next. Sequences at a small edit distance fall into step again after an edit,
so their embeddings are at a small Hamming distance. Sampling a few places of an embedding makes an LSH key for Hamming
distance; many keys from several walks reach the wanted recall.

Windows of the size of the items are embedded, from every word of a document on, and meet items by their keys. Each
pair met is verified by the edit distance of the item to the best passage around the window. Only windows with an exact
piece of some item can be within the distance, since ``d`` edits leave one of ``d + 1`` pieces intact; others are not
embedded.

Walks fall out of step over many edits, so items of more than ``LONG`` words are found by counting: ``d`` edits spoil at
most ``g * d`` of an item's ``n - g + 1`` runs of ``g`` words, and every stretch that has the rest is verified. Items of
fewer than ``FEWEST`` words may have no edit and are found by themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import _LOWER, _U, blocks, hash_pieces, mix, stream, words

SHARE = 0.2  # words of an item that may be edited
FEWEST = 5  # words of an item that may have edits
LONG = 100  # words beyond which items are found by counting runs, of GRAM words at most
GRAM = 4
WALKS, SAMPLES, PLACES = 12, 8, 3
GROUP_BYTES = 32 << 20  # of items that are looked for in one pass
FOUND = "doc_id long, item_id long, start long, length long, edits int"
_PAD = _U(0x5851F42D4C957F2D)

# Words are runs of letters, digits and bytes beyond ASCII: signs don't tell words apart. Scripts without spaces have a
# word for each character.
_APART = np.ones(256, bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _APART[_a:_b] = False


_ALONE = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FA), (0x30FC, 0x30FF), (0x3100, 0x312F), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_SIGNS = ((0x3000, 0x3004), (0x3008, 0x3020), (0x3030, 0x3030), (0x30FB, 0x30FB), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))


def split(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``words`` of a block, and the characters of Thai, Lao, Burmese, Khmer, kana and Chinese one by one, without the
    signs and full-width signs that are written among them."""
    lead = np.flatnonzero(data >= 0xE0)
    if not len(lead):
        return words(data, bounds, space=_APART)
    pad = np.append(data, np.zeros(3, np.uint8)).astype(np.int64)
    point = np.where(data[lead] < 0xF0, (pad[lead] & 15) << 12 | (pad[lead + 1] & 63) << 6 | pad[lead + 2] & 63, (pad[lead] & 7) << 18 | (pad[lead + 1] & 63) << 12 | (pad[lead + 2] & 63) << 6 | pad[lead + 3] & 63)
    size = np.where(data[lead] < 0xF0, 3, 4)
    among = lambda ranges: np.any([(point >= x) & (point <= y) for x, y in ranges], axis=0)
    alone, sign = among(_ALONE), among(_SIGNS)
    if not (alone | sign).any():
        return words(data, bounds, space=_APART)
    solid = ~_APART[data]
    for k in range(4):
        solid[lead[sign & (size > k)] + k] = False
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = ~solid[1:] | ~solid[:-1]
    cut[bounds] = True
    cut[lead[alone]] = cut[lead[alone] + size[alone]] = True
    starts = np.flatnonzero(solid & cut[:-1])
    ends = np.flatnonzero(solid & cut[1:]) + 1
    return hash_pieces(_LOWER[data][solid], ends - starts), starts, ends, np.searchsorted(starts, bounds)


def walk(symbols: np.ndarray, starts: np.ndarray, steps: np.ndarray, wanted: set[int]) -> dict[int, np.ndarray]:
    """The places where CGK walks from ``starts`` stand at the ``wanted`` steps. ``steps`` holds each step's random
    multiplier, whose product with a word has the bit at its top."""
    at, out = starts.astype(np.int64), {}
    last = len(symbols) - 1
    for j in range(max(wanted) + 1):
        if j in wanted:
            out[j] = at
        at = at + ((symbols[np.minimum(at, last)] * steps[j]) >> _U(63)).astype(np.int64)
    return out


def edit_search(item: list[int], text: list[int]) -> tuple[int, int]:
    """(least edit distance of ``item`` to a passage of ``text``, end of the shortest such passage), by Myers' bit
    vectors over words."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    vp, vn, score = full, 0, n
    best, end = n, 0
    for k, w in enumerate(text, 1):
        eq = masks.get(w, 0)
        xv = eq | vn
        xh = (((eq & vp) + vp) ^ vp) | eq
        hp = vn | ~(xh | vp) & full
        hn = vp & xh
        score += bool(hp & top) - bool(hn & top)
        hp, hn = hp << 1 & full, hn << 1 & full
        vp = hn | ~(xv | hp) & full
        vn = hp & xv
        if score < best:
            best, end = score, k
    return best, end


@dataclass
class Index:
    """Items in size classes, their LSH keys, and the word runs that a near passage of an item must have one of."""

    ids: list[int]
    items: list[np.ndarray]
    share: float = SHARE
    short: list[tuple[int, np.ndarray]] = field(default_factory=list)

    def __post_init__(self) -> None:
        sizes = np.array([len(i) for i in self.items], np.int64)
        edits = np.floor(sizes * self.share + 1e-9).astype(np.int64)
        self.edits = edits
        pieces = sizes // (edits + 1)
        self.long = {int(g): self._postings(np.flatnonzero((sizes > LONG) & (np.minimum(pieces, GRAM) == g)), int(g)) for g in np.unique(np.minimum(pieces, GRAM)[sizes > LONG])}
        self.exact = {}
        for n in sorted({len(i) for _, i in self.short}):
            of: dict[int, list[int]] = {}
            for k, i in self.short:
                if len(i) == n:
                    of.setdefault(int(_grams(i, n)[0]), []).append(k)
            self.exact[n] = np.array(sorted(of), np.uint64), of
        sizes_embedded, pieces = sizes[sizes <= LONG], np.where(sizes <= LONG, pieces, 0)
        self.grams = {
            int(g): np.unique(np.concatenate([_grams(self.items[k], int(g)) for k in np.flatnonzero(pieces == g)])) for g in np.unique(pieces[pieces > 0])
        }
        self.reach = {int(g): int((sizes + edits)[pieces == g].max()) for g in self.grams}
        ladder = [FEWEST]
        while ladder[-1] < sizes_embedded.max(initial=0):
            ladder.append(max(ladder[-1] + 1, ladder[-1] * 6 // 5))
        classes = np.array(ladder)[np.searchsorted(ladder, sizes, "right") - 1]
        self.classes = {int(c): np.flatnonzero(classes == c) for c in np.unique(classes[sizes <= LONG])}
        self.classes = {c: m[sizes[m] <= LONG] for c, m in self.classes.items()}
        self.bits = [stream(2 * int(sizes_embedded.max(initial=1)) + 8, 21 + w) | _U(1) for w in range(WALKS)]
        self.samples, keys, owners = {}, [], []
        for c, members in self.classes.items():
            rng = np.random.default_rng(c)
            self.samples[c] = rng.integers(0, max(1, int(1.6 * c)), (WALKS, SAMPLES, PLACES))
            flat = np.concatenate([np.append(self.items[k][:c], _PAD) for k in members])
            k = self._keys(flat, np.arange(len(members)) * (c + 1), np.arange(len(members)) * (c + 1) + c, [c])
            keys.append(k[c].ravel())
            owners.append(np.tile(members, WALKS * SAMPLES))
        order = np.argsort(np.concatenate(keys), kind="stable") if keys else np.zeros(0, np.int64)
        self.keys = np.concatenate(keys)[order] if keys else np.zeros(0, np.uint64)
        self.owners = np.concatenate(owners)[order] if keys else np.zeros(0, np.int64)

    def _postings(self, members: np.ndarray, g: int) -> tuple[np.ndarray, np.ndarray]:
        """(runs of ``g`` words in order, the item of each)."""
        runs = [np.unique(_grams(self.items[k], g)) for k in members]
        flat, owners = np.concatenate(runs), np.repeat(members, [len(r) for r in runs])
        order = np.argsort(flat, kind="stable")
        return flat[order], owners[order]

    def _counted(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(item, word) of the stretches that have as many runs of a long item as its edits must leave: where a passage
        may begin at the earliest and at the latest."""
        met = [np.zeros((0, 2), np.int64)]
        for g, (runs, owners) in self.long.items():
            grams = _grams(hashes, g)
            some = np.flatnonzero(_member(grams, runs))
            lo, hi = np.searchsorted(runs, grams[some], "left"), np.searchsorted(runs, grams[some], "right")
            n = hi - lo
            item = owners[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            at = np.repeat(some, n)
            order = np.lexsort((at, item))
            item, at = item[order], at[order]
            text = np.searchsorted(first, at, "right") - 1
            for k, x, y in zip(*_stretches(item)):
                size, most = len(self.items[k]), int(self.edits[k])
                left = size - g + 1 - g * most
                p = at[x:y]
                if len(p) < left:
                    continue
                end, begin = p[left - 1 :], p[: len(p) - left + 1]
                fit = (end - begin <= size + most - g) & (text[x + left - 1 : y] == text[x : y - left + 1])
                begin, end, low = begin[fit], end[fit], first[text[x : y - left + 1][fit]]
                starts = np.unique(np.concatenate([np.maximum(low, end + g - size - most), begin]))
                met.append(np.stack([np.full(len(starts), k), starts], 1))
        return np.concatenate(met)

    def _copies(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Rows of ``find`` for the short items."""
        out = []
        for n, (known, of) in self.exact.items():
            grams = _grams(hashes, n)
            for k in np.flatnonzero(_member(grams, known)):
                text = int(np.searchsorted(first, k, "right")) - 1
                if k + n <= first[text + 1]:
                    out += [(text, item, int(starts[k]), int(ends[k + n - 1]), 0) for item in of[int(grams[k])]]
        return out

    def _keys(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, classes: list[int]) -> dict[int, np.ndarray]:
        """For each class, the keys (walk and sample, window) of windows of its size from ``starts`` on, which stop
        before ``ends``."""
        out = {c: np.empty((WALKS * SAMPLES, len(starts)), np.uint64) for c in classes}
        factors = stream(PLACES, 20) | _U(1)
        for w in range(WALKS):
            at = walk(symbols, starts, self.bits[w], {int(j) for c in classes for j in self.samples[c][w].ravel()})
            for c in classes:
                limit = np.minimum(starts + c, ends)
                for s, places in enumerate(self.samples[c][w]):
                    key = np.full(len(starts), mix(np.array([c * 4096 + w * 64 + s], np.uint64))[0])
                    for j, factor in zip(places.tolist(), factors):
                        key += np.where(at[j] < limit, symbols[np.minimum(at[j], len(symbols) - 1)], _PAD) * factor
                    out[c][w * SAMPLES + s] = mix(key)
        return out

    def near(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The words of a block from which a window may begin that is near an item."""
        change = np.zeros(len(hashes) + 1, np.int64)
        for g, known in self.grams.items():
            at = np.flatnonzero(_member(_grams(hashes, g), known))
            np.add.at(change, np.maximum(at - self.reach[g], 0), 1)
            np.add.at(change, at + 1, -1)
        marked = np.flatnonzero(np.cumsum(change[:-1]) > 0)
        return marked

    def find(self, data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word's byte, last word's end byte, edits) of the passages near an item in a block."""
        hashes, starts, ends, first = split(data, bounds)
        windows = self.near(hashes, first) if self.classes and len(hashes) else np.zeros(0, np.int64)
        out = self._verify(self._counted(hashes, first), hashes, first) if self.long else []
        for part in np.array_split(windows, -(-len(windows) // 50_000)) if len(windows) else []:
            text = np.searchsorted(first, part, "right") - 1
            met = []
            for c, keys in self._keys(hashes, part, first[text + 1], list(self.classes)).items():
                flat = keys.ravel()
                lo, hi = np.searchsorted(self.keys, flat, "left"), np.searchsorted(self.keys, flat, "right")
                some = np.flatnonzero(hi > lo)
                n = (hi - lo)[some]
                own = np.repeat(lo[some], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                met.append(np.unique(np.stack([self.owners[own], part[np.repeat(some % len(part), n)]], 1), axis=0))
            met = np.unique(np.concatenate(met), axis=0)
            out += self._verify(met, hashes, first)
        near = {(t, self.ids[k], int(starts[a]), int(ends[b - 1]), d) for t, k, a, b, d in _best(out)}
        return sorted(near | set(self._copies(hashes, starts, ends, first)))

    def _verify(self, met: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, end, edits); windows of an item that lie together are verified at once."""
        out, k = [], 0
        while k < len(met):
            item, a = met[k]
            n, most = len(self.items[item]), int(self.edits[item])
            text = int(np.searchsorted(first, a, "right")) - 1
            last = k
            while last + 1 < len(met) and met[last + 1][0] == item and met[last + 1][1] - met[last][1] <= n and met[last + 1][1] < first[text + 1]:
                last += 1
            x = max(int(a) - most - n // 2, int(first[text]))
            y = min(int(met[last][1]) + n + most + n // 2, int(first[text + 1]))
            wanted = self.items[item].tolist()
            todo = [(x, y)]
            while todo:  # every passage of the stretch, on both sides of the best
                x, y = todo.pop()
                if y - x < n - most:
                    continue
                d, end = edit_search(wanted, hashes[x:y].tolist())
                if d > most:
                    continue
                _, back = edit_search(wanted[::-1], hashes[x : x + end][::-1].tolist())
                out.append((text, int(item), x + end - back, x + end, d))
                todo += [(x, x + end - back), (x + end, y)]
            k = last + 1
        return out


def _stretches(values: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """(value, first place, end) of the runs of equal values."""
    edges = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(values)] if len(edges) else []


def _best(found: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Of an item's passages that overlap, the one with the fewest edits."""
    out: list[tuple[int, int, int, int, int]] = []
    for f in sorted(found, key=lambda f: (f[0], f[1], f[4], f[2])):
        if not any(o[:2] == f[:2] and o[2] < f[3] and f[2] < o[3] for o in out[-64:]):
            out.append(f)
    return out


def _grams(hashes: np.ndarray, g: int) -> np.ndarray:
    n = max(0, len(hashes) - g + 1)
    out, factors = np.zeros(n, np.uint64), stream(max(g, 1), 19) | _U(1)
    for k in range(g):
        out += hashes[k : k + n] * factors[k]
    return mix(out)


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the ascending ``known``: a table of their first 20 bits rules most out."""
    table = np.zeros(1 << 20, bool)
    table[(known >> _U(44)).astype(np.int64)] = True
    out = table[(values >> _U(44)).astype(np.int64)]
    some = np.flatnonzero(out)
    at = np.minimum(np.searchsorted(known, values[some]), len(known) - 1)
    out[some] = known[at] == values[some]
    return out


def indexes(benchmark: DataFrame, share: float = SHARE, item_id: str = "item_id", text: str = "text", group_bytes: int = GROUP_BYTES) -> Iterator[Index]:
    """The items in groups of about ``group_bytes``, one index each; a usual benchmark is one group. Items without
    words or an id are left out."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")).filter("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    for g in range(groups):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).distinct().orderBy("item_id", "text").collect()
        split_rows, short = [], []
        for r in rows:
            data = np.frombuffer(r["text"].encode("utf-8"), np.uint8)
            h, *_ = split(data, np.array([0, len(data)]))
            if len(h) >= FEWEST:
                split_rows.append((r["item_id"], h))
            elif len(h):
                short.append((r["item_id"], h))
        yield Index([k for k, _ in split_rows], [h for _, h in split_rows], share, short)


def benchmark_passages(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each passage of a document that is within the edit distance of an item, a ``share`` of the item's
    words: doc_id, item_id, start and length (characters), edits (words). Words are compared without case and signs; in scripts
    without spaces each character is one. Items of fewer than ``FEWEST`` words count where they stand as they are.

    Null, empty and short texts have none; rows without an id or with equal ids are searched one by one. Of passages
    of one item that overlap, the nearest counts. Empty tables make no rows.
    """
    found = None
    for index in indexes(benchmark, share):

        def rows(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for row, data, bounds in blocks(batch.column(1)):
                    for t, item, a, b, d in index.find(data, bounds):
                        before = len(data[bounds[t] : a].tobytes().decode("utf-8"))
                        out.append((batch.column(0)[row + t].as_py(), item, before, len(data[a:b].tobytes().decode("utf-8")), d))
                columns = list(zip(*out)) if out else [[]] * 5
                kinds = [pa.int64()] * 4 + [pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in FOUND.split(", ")])

        base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        part = base.mapInArrow(rows, FOUND)
        found = part if found is None else found.unionByName(part)
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, without those that hold a passage of an item. Nothing is joined:
    whole rows pass the search."""
    at = docs.columns.index(text)
    for index in indexes(benchmark, share):

        def rows(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, data, bounds in blocks(batch.column(at)):
                    keep[[row + f[0] for f in index.find(data, bounds)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(rows, docs.schema)
    return docs
