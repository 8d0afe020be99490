"""License scans: conditional compression of candidate blocks with each template.

The text around a cue, some thousand characters to either side, is searched over lines and paragraphs, in pieces that
overlap by more than the longest template. Templates are aligned word by word with the stretch of a piece that is most
like them, wherever it begins and ends. A stretch stands if few enough words differ and its names, variants and version
numbers are the template's. Stretches that overlap make a candidate block, which zstandard compresses alone and with each
of their templates as a raw dictionary: the template that saves most wins and is reported with the exact differences; where
savings are close, the closer wording wins.

No template is left out by its rank: only those of which a piece hasn't enough words, a bound on the alignment, are not
aligned. ``SPDX-License-Identifier`` lines are read as what they are, expressions of names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.license_texts import CUES, NAMES, NOTICES, TEXTS

TEMPLATES = {name: [*NOTICES.get(name, []), *TEXTS.get(name, [])] for name in NOTICES | TEXTS}
AROUND = 4096  # characters on either side of a cue
PIECE = 256  # words of a piece in which a stretch may begin
CLOSE = 0.8  # of the best's savings: close enough for the wording to decide

SCHEMA = "doc_id long, start long, length long, license string, template string, saved double, differences int, block string"
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_CUE = re.compile("|".join(map(re.escape, CUES)), re.IGNORECASE)
_VERSION = re.compile(r"v?(\d{1,2}(?:\.\d+)*)")
_END = re.compile(r"[.!?)/\"']*")
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([^\n]*)", re.IGNORECASE)
_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+-]*")


def word_distance(a: list[str], b: list[str]) -> int:
    """Insertions, removals and changes of words that make ``b`` of ``a``."""
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def telling(words: list[str], numbers: bool) -> list[str]:
    """The names, variants and, with ``numbers``, versions among ``words``, in their order."""
    out = []
    for w in words:
        version = _VERSION.fullmatch(w) if numbers else None
        if version or w in NAMES:
            out.append(version[1] if version else w)
    return out


def alignments(wanted: np.ndarray, own: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """(first, end, differences) of stretches of ``own`` that at most ``most`` insertions, removals and changes of words
    part from ``wanted``; of those that overlap the best, of equal ones the first."""
    n = len(own)
    places = np.arange(n + 1)
    cost = np.zeros((len(wanted) + 1, n + 1), np.int32)
    for i, w in enumerate(wanted, 1):
        best = cost[i - 1] + 1
        np.minimum(best[1:], cost[i - 1, :-1] + (own != w), out=best[1:])
        cost[i] = np.minimum.accumulate(best - places) + places
    found: list[tuple[int, int, int]] = []
    ends = np.flatnonzero(cost[-1] <= most)
    for end in ends[np.argsort(cost[-1, ends], kind="stable")].tolist():
        if any(x < end <= y for x, y, _ in found):
            continue
        i, j = len(wanted), end
        while i:
            if j and cost[i, j] == cost[i - 1, j - 1] + (own[j - 1] != wanted[i - 1]):
                i, j = i - 1, j - 1
            elif cost[i, j] == cost[i - 1, j] + 1:
                i -= 1
            else:
                j -= 1
        if j < end and not any(x < end and j < y for x, y, _ in found):
            found.append((j, end, int(cost[-1, end])))
    return found


@dataclass
class Scanner:
    """``most`` is the share of a template's words that may differ."""

    templates: dict[str, list[str]]
    most: float = 0.2

    def __post_init__(self) -> None:
        self.flat, self.given, self.codes = [], [], {}
        for name, texts in self.templates.items():
            for t in texts:
                words = words_of(t)
                numbers = t not in TEXTS.get(name, ())
                coded = np.array([self.codes.setdefault(w, len(self.codes)) for w in words], np.int64)
                self.flat.append((name, t, Counter(words), coded, int(self.most * len(words)), telling(words, numbers), numbers))
                data = zstandard.ZstdCompressionDict(t.lower().encode("utf-8").rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                self.given.append(self._compressor(dict_data=data))
        self.alone = self._compressor()
        self.names = {name.lower(): name for name in self.templates}
        #: More words than any stretch has that a template is confirmed for.
        self.longest = max((len(f[3]) + f[4] for f in self.flat), default=0) + 1

    @staticmethod
    def _compressor(**options) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, write_dict_id=False, **options)

    def _piece(self, words: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(first word, end, differences, template) of each confirmed stretch of a piece."""
        counts, coded = Counter(words), np.array([self.codes.get(w, -1) for w in words], np.int64)
        for k, (_, _, wanted, template, most, keys, numbers) in enumerate(self.flat):
            # A stretch within the limit has all but that many words of the template.
            if sum((wanted - counts).values()) <= most:
                for x, y, d in alignments(template, coded, most):
                    if telling(words[x:y], numbers) == keys:
                        yield x, y, d, k

    def scan(self, text: str) -> Iterator[tuple[int, int, str, str, float, int, str]]:
        """(start, length, license, template, saved, differences, block) of each notice, in the order of the text."""
        rows, a, b = [], 0, -1
        for cue in _CUE.finditer(text):
            if b >= 0 and cue.start() - AROUND > b:
                rows += self._block(text, a, b)
                b = -1
            if b < 0:
                a = max(0, cue.start() - AROUND)
            b = min(len(text), cue.end() + AROUND)
        if b >= 0:
            rows += self._block(text, a, b)
        for line in _SPDX.finditer(text):
            for name in _ID.finditer(re.split(r"\*/|-->", line[1])[0]):
                if name[0].upper() not in ("AND", "OR", "WITH"):
                    plain = re.sub(r"(-only|-or-later|\+)$", "", name[0])
                    start = line.start(1) + name.start()
                    rows.append((start, len(name[0]), self.names.get(plain.lower(), name[0]), "SPDX-License-Identifier", 1.0, 0, line[0].rstrip()))
        yield from sorted(rows)

    def _block(self, text: str, a: int, b: int) -> list[tuple[int, int, str, str, float, int, str]]:
        words = [(m.start(), m.end(), m[0].lower()) for m in _WORD.finditer(text, a, b)]
        found = set()
        for first in range(0, len(words), PIECE):
            piece = [w for _, _, w in words[first : first + PIECE + self.longest]]
            found |= {(first + x, first + y, d, k) for x, y, d, k in self._piece(piece) if x < PIECE}
        groups, end = [], 0
        for f in sorted(found):
            if f[0] >= end:
                groups.append([])
            groups[-1].append(f)
            end = max(end, f[1])
        return [row for g in groups for row in self._winners(text, words, g)]

    def _winners(self, text: str, words: list[tuple[int, int, str]], stretches: list[tuple[int, int, int, int]]) -> Iterator[tuple]:
        """The rows of those of a block's confirmed stretches, which overlap, that win over the others they overlap."""
        data = text[words[stretches[0][0]][0] : words[max(y for _, y, _, _ in stretches) - 1][1]].lower().encode("utf-8")
        size = len(self.alone.compress(data))
        saved = {k: 1 - len(self.given[k].compress(data)) / size for k in {k for _, _, _, k in stretches}}
        left = sorted(stretches, key=lambda f: (-saved[f[3]], f[2], f[0], f[3]))
        while left:
            x, y, _, k = left[0]
            close = min(saved[k], CLOSE * saved[k])
            rivals = [f for f in left if f[0] < y and x < f[1] and saved[f[3]] >= close]
            x, y, d, k = min(rivals, key=lambda f: (2 * f[2] - len(self.flat[f[3]][3]), -saved[f[3]], f[0], f[3]))
            start, end = words[x][0], _END.match(text, words[y - 1][1]).end()
            yield (start, end - start, *self.flat[k][:2], saved[k], d, text[start:end])
            left = [f for f in left if f[0] >= y or f[1] <= x]


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each notice found: doc_id, start and length (characters), license, template, saved (share of the block's
    compressed bytes), differences (words), block (the stretch).

    A notice that has none of the cues, or is spread over more than 4,096 characters on a side of one, isn't looked for.
    Of templates that save and differ alike the first given is named. Documents without a notice, null and empty texts
    make no rows; repeated rows and rows without an id are scanned one by one; other columns, whatever their names, are
    left out. Texts without a cue don't reach Python."""
    given = TEMPLATES if templates is None else templates

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given)
        for batch in batches:
            found = [(k.as_py(), *f) for k, t in zip(batch.column(0), batch.column(1)) for f in scanner.scan(t.as_py())]
            columns = list(zip(*found)) if found else [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in SCHEMA.split(", ")])

    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    lowered = F.lower("text")
    cue = lowered.contains(CUES[0])
    for c in CUES[1:]:
        cue |= lowered.contains(c)
    return base.filter(cue).mapInArrow(rows, SCHEMA)
