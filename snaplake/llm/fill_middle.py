"""Fill-in-the-middle: documents cut in three and put together with the middle last.

A text is cut between units: words of ASCII letters and all other code points one by one, or code points alone. Cuts
are places in its UTF-8 bytes. What they are in code points, and the other way round, follows from a sparse exception
index: only the characters of several bytes are recorded, by their position and by how many bytes each has too many, and
``searchsorted`` tells how many of those bytes lie before a cut. Between exceptions, bytes and code points are the same and
need arithmetic only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import blocks, bound_batches, int64

# The marks that go before the three parts, and the shares of documents of each form.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT_PERCENT, SPM_PERCENT = 90, 20

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_MARK = f"{PREFIX}|{SUFFIX}|{MIDDLE}"
_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True


class Exceptions:
    """The characters of several bytes of a block of texts: where they begin, and the excess bytes up to each."""

    def __init__(self, data: np.ndarray) -> None:
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        self.excess = np.concatenate([[0], np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0))])

    def before(self, places: np.ndarray) -> np.ndarray:
        """Excess bytes before byte places, none of which is inside a character."""
        return self.excess[np.searchsorted(self.at, places)]

    def code_points(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Code points from byte places up to others."""
        return ends - starts - self.before(ends) + self.before(starts)

    def byte_places(self, starts: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Byte places ``points`` code points after the byte places ``starts``."""
        # Where each exception stands if bytes and code points are counted alike.
        at = self.at - self.excess[:-1]
        wanted = starts - self.before(starts) + points
        return wanted + self.excess[np.searchsorted(at, wanted)]


def unit_starts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte places at which the units of a block begin, and the first unit of each text and the total."""
    letter, begins = _LETTER[data], (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[bounds[:-1][bounds[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, bounds)


def draws(doc_id: int | None) -> list[int]:
    """The four numbers that decide a document's cuts and form. A row without an id draws as if the id were no digits."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def _cuts(data: np.ndarray, bounds: np.ndarray, index: Exceptions, h: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """Units of each text, and the byte places of its two cuts in order."""
    if unit == "points":
        n = index.code_points(bounds[:-1], bounds[1:])
        points = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
        return n, np.stack([index.byte_places(bounds[:-1], points[:, k]) for k in (0, 1)], axis=1)
    starts, first = unit_starts(data, bounds)
    n = np.diff(first)
    units = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    # The place of a unit; past the last unit of a text it is the text's end.
    edges = np.concatenate([starts, [len(data)]])
    return n, np.where(units == n[:, None], bounds[1:, None], edges[np.minimum(first[:-1, None] + units, len(starts))])


def _parts(unit: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in blocks(batch.column(1)):
                ids, index = batch.column(0).slice(row, len(bounds) - 1), Exceptions(data)
                h = np.array([draws(x) for x in ids.to_pylist()], np.int64).reshape(-1, 4)
                n, cuts = _cuts(data, bounds, index, h, unit)
                made = [
                    _formed(data[a:b].tobytes(), x - a, y - a, bool(c % 100 >= CUT_PERCENT), bool(d % 100 < SPM_PERCENT))
                    for a, b, x, y, c, d in zip(bounds[:-1].tolist(), bounds[1:].tolist(), *cuts.T.tolist(), *h[:, 2:].T.tolist())
                ]
                plain = np.array([form == "plain" for form, _ in made], bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        int64(n),
                        pa.array([form for form, _ in made], pa.string()),
                        pa.array(index.code_points(bounds[:-1], cuts[:, 0]), pa.int64(), mask=plain),
                        pa.array(index.code_points(cuts[:, 0], cuts[:, 1]), pa.int64(), mask=plain),
                        pa.array([output for _, output in made], pa.binary()).view(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def _formed(text: bytes, x: int, y: int, plain: bool, spm: bool) -> tuple[str, bytes]:
    """The form and the output of a text whose middle goes from byte x to byte y."""
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if plain or not text or p in text or s in text or m in text:
        return "plain", text
    if spm:
        return "spm", s + text[y:] + p + text[:x] + m + text[x:y]
    return "psm", p + text[:x] + s + text[y:] + m + text[x:y]


def fill_in_middle(docs: DataFrame, unit: str = "words", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: doc_id, n (units of the text), form, prefix_chars and middle_chars (code points; null if plain) and
    output, the text as it goes into training. ``unit`` is "words" or "points" (code points).

    The id alone decides which cuts and form a row draws, so rows of one id and text come out alike, wherever they are
    and however often the job runs. Null texts are empty. Empty texts and those that hold one of the three marks stay
    plain, like a tenth of all others. A null id draws like an id without digits. Columns other than the two are left
    out. No shuffle: a scan and one pass over each text, whatever its length.
    """
    if unit not in ("words", "points"):
        raise ValueError(f"unit is words or points, not {unit!r}")
    bound_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(_parts(unit), SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The document's text, from its output and form alone. Documents that hold a mark are plain, so the first of each
    mark is the one that was put in: no part's end and mark make up another one."""
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    joined = lambda parts, form: F.concat(*[F.get(parts, F.lit(k)) for k in order[form]])
    cut = F.transform(F.array(F.split(output, _MARK)), lambda parts: F.when(form == "psm", joined(parts, "psm")).otherwise(joined(parts, "spm")))
    return F.when(form == "plain", output).otherwise(F.get(cut, F.lit(0)))
