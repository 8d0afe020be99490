"""What verifying passages keeps in memory does not change what it finds."""

import numpy as np

from snaplake.llm import passages


def test_matches_of_few_diagonals_are_kept(monkeypatch):
    rng = np.random.default_rng(3)
    sa = rng.integers(1, 1 << 62, 3_000).astype(np.uint64)
    sb = rng.integers(1, 1 << 62, 3_000).astype(np.uint64)
    seeds = []
    for k in range(20):  # a passage on each of so many diagonals
        to, at = 150 * k, int(rng.integers(0, 2_900))
        sb[to : to + 80] = sa[at : at + 80]
        seeds += [(f, at + 40, at, at + 79, to + 40, to, to + 79) for f in (0, 1)]
    held, looked = [], passages._matches
    monkeypatch.setattr(passages, "_matches", lambda *a: held.append(a[2]) or looked(*a))
    args = sa, sb, np.array(seeds), 50, 5, 2, 0.8
    found = passages.verified_passages(*args)
    assert len(found) >= 15 and len(held) == len(set(held))
    monkeypatch.setattr(passages, "KEPT_PLACES", 3_000)
    assert passages.verified_passages(*args) == found


def test_a_passage_that_failed_is_not_verified_again(monkeypatch):
    rng = np.random.default_rng(4)
    sa = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    sb = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    sb[100:130], sb[130:160] = sa[100:130], sa[160:190]  # a has 30 more in between: 60 of 90 are shared
    seeds = [(f, c, 100, 189, c, 100, 159) for c in range(100, 130) for f in (0, 1)]
    sets, of = [], passages._distinct
    monkeypatch.setattr(passages, "_distinct", lambda s: sets.append(len(s)) or of(s))
    assert passages.verified_passages(sa, sb, np.array(seeds), 50, 5, 2, 0.8) == []
    assert sets == [90, 60]
