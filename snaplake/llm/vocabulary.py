"""Texts to token ids with a public tokenizer file, a block of texts at a time.

A tokenizer of the supported kinds never joins what a letter and a following ASCII sign, or a non-space and a following
space, have between them. Texts are therefore cut there, and each distinct piece is encoded by the ``tokenizers``
library once and remembered; the rest is array work. Texts with other white space than ASCII's, where a cut could fall
inside a run of white space, and texts with the string of an added token are given to the library whole, which reads such
strings as it does by itself: as that token. Pieces are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from snaplake.llm.common import _LOWER, _SPACE, hash_pieces

MAX_SLOTS = 1 << 22

# White space that isn't ASCII's six, and controls that some libraries take for white space.
_ODD_SPACE = "[\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200f}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{2060}\\x{3000}\\x{feff}]"
_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x7F] = True
_SIGN &= ~_LETTER
_SIGN[ord("0") : ord("9") + 1] = False
# Second bytes of the two-byte letters U+00C0 to U+00FF, without the times and division signs.
_SECOND = np.zeros(256, bool)
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker and file, so that what it has learned stays for later tasks."""
    return Encoder(path)


def _byte_letters() -> list[str]:
    """The printable stand-ins that byte-level tokenizers have for bytes: a byte's own sign where it is printable,
    else the next unused one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


class Encoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([_ODD_SPACE, *[f"(?i:{a})" for a in added]])
        self.folds = self.tokenizer.normalizer is not None  # lower case, white space dropped
        self.letters = _byte_letters()
        self._clear(1 << 16)

    def _clear(self, slots: int) -> None:
        self.slots, self.keys, self.values = slots, np.zeros(slots, np.uint64), np.full(slots, -1, np.int32)
        self.n = 0
        self.starts, self.lengths = np.zeros(slots // 2 + 1, np.int64), np.zeros(slots // 2 + 1, np.int32)
        self.ids, self.n_ids = np.zeros(slots * 2, np.uint32), 0

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, and where those of each text begin and the last ones end."""
        odd = self._odd(data, bounds)
        if not odd.any():
            return self._encode(data, bounds)
        parts, counts = [], []
        for k in range(len(bounds) - 1):
            one = data[bounds[k] : bounds[k + 1]]
            if odd[k]:
                ids = np.array(self.tokenizer.encode(one.tobytes().decode("utf-8"), add_special_tokens=False).ids, np.uint32)
            else:
                ids, _ = self._encode(one, np.array([0, len(one)]))
            parts.append(ids)
            counts.append(len(ids))
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(counts)])

    def _odd(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        texts = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        return pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False).astype(bool)

    def _encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        space, letter = _SPACE[data], _LETTER[data]
        letter[1:] |= (data[:-1] == 0xC3) & _SECOND[data[1:]]
        cut = np.zeros(n + 1, bool)
        cut[1:-1] = (space[1:] & ~space[:-1]) | (_SIGN[data[1:]] & letter[:-1])
        if self.folds:
            cut[1:-1] |= space[:-1] & ~space[1:]
        cut[bounds] = True
        cut[n] = True
        edges = np.flatnonzero(cut)
        firsts, lengths = edges[:-1], np.diff(edges)
        if self.folds:
            data = _LOWER[data]
            kept = ~space[firsts]
            solid = data[np.repeat(kept, lengths)]
            firsts, lengths = firsts[kept], lengths[kept]
        else:
            solid = data
        found = self._find(data, firsts, lengths, hash_pieces(solid, lengths))
        sizes = self.lengths[found].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(total[-1]) + np.repeat(self.starts[found] - total[:-1], sizes)
        return self.ids[at], total[np.searchsorted(firsts, bounds)]

    def _slots_of(self, hashes: np.ndarray) -> np.ndarray:
        """Each hash's slot: the one that holds it, or the free one where it belongs."""
        mask = self.slots - 1
        slot = (hashes >> np.uint64(20)).astype(np.int64) & mask
        left = np.flatnonzero((self.keys[slot] != hashes) & (self.values[slot] >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & mask
            at = slot[left]
            left = left[(self.keys[at] != hashes[left]) & (self.values[at] >= 0)]
        return slot

    def _find(self, data: np.ndarray, firsts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        found = self.values[self._slots_of(hashes)]
        if (found < 0).any():
            miss = np.flatnonzero(found < 0)
            _, first = np.unique(hashes[miss], return_index=True)
            new = miss[first]
            while self.n + len(new) > self.slots // 2:
                if self.slots >= MAX_SLOTS and self.n:  # forget, so that memory stays bounded
                    self._clear(self.slots)
                    return self._find(data, firsts, lengths, hashes)
                self._grow()
            self._learn([data[a : a + b].tobytes() for a, b in zip(firsts[new].tolist(), lengths[new].tolist())], hashes[new])
            found = self.values[self._slots_of(hashes)]
        return found

    def _grow(self) -> None:
        used = np.flatnonzero(self.values >= 0)
        keys, values = self.keys[used], self.values[used]
        self.slots *= 2
        self.keys, self.values = np.zeros(self.slots, np.uint64), np.full(self.slots, -1, np.int32)
        self.starts = np.concatenate([self.starts, np.zeros(self.slots // 2 + 1 - len(self.starts), np.int64)])
        self.lengths = np.concatenate([self.lengths, np.zeros(self.slots // 2 + 1 - len(self.lengths), np.int32)])
        self._put(keys, values)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        left = np.arange(len(keys))
        while len(left):
            slot = self._slots_of(keys[left])
            _, first = np.unique(slot, return_index=True)  # one key for each free slot at a time
            self.keys[slot[first]], self.values[slot[first]] = keys[left[first]], values[left[first]]
            left = np.delete(left, first)

    def _learn(self, pieces: list[bytes], hashes: np.ndarray) -> None:
        ids = self._ids(pieces)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for part in ids for x in part), np.uint32, int(sizes.sum()))
        if self.n_ids + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(flat)), np.uint32)])
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        self.starts[self.n : self.n + len(ids)] = self.n_ids + np.cumsum(sizes) - sizes
        self.lengths[self.n : self.n + len(ids)] = sizes
        self._put(hashes, np.arange(self.n, self.n + len(ids), dtype=np.int32))
        self.n, self.n_ids = self.n + len(ids), self.n_ids + len(flat)

    def _ids(self, pieces: list[bytes]) -> list[list[int]]:
        """A word of letters, with a space before it at most, is one piece to the library's model; others go through
        the whole tokenizer."""
        model, letters = self.tokenizer.model, self.letters
        out: list = [None] * len(pieces)
        others = []
        for k, piece in enumerate(pieces):
            text = piece.decode("utf-8")
            core = text[1:] if text[:1] == " " else text
            if core.isalpha() and max(core) < "\u0100":
                if self.folds:
                    piece = core.lower().encode("utf-8")
                out[k] = [t.id for t in model.tokenize("".join([letters[b] for b in piece]))]
            else:
                others.append(k)
        if others:
            texts = [pieces[k].decode("utf-8") for k in others]
            for k, e in zip(others, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                out[k] = e.ids
        return out
