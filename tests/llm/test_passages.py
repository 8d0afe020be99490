"""Repeated passages: compact windows against their definition, planted passages, and cuts."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from snaplake.llm import passages
from snaplake.llm.common import table
from snaplake.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=60), st.integers(1, 9))
def test_compact_windows_are_the_wide_nodes(values, t):
    h = np.array(values, np.uint64)
    got = sorted(zip(*(x.tolist() for x in passages.compact_windows(h, t))))
    want = []
    for c, v in enumerate(values):
        if not v:
            continue
        left = c
        while left and values[left - 1] > v:
            left -= 1
        right = c
        while right + 1 < len(values) and values[right + 1] >= v:
            right += 1
        if right - left + 1 >= t:
            want.append((c, left, right))
    assert got == sorted(want)


def word(rng):
    return rng.choice(["the", "of", "and"]) if rng.random() < 0.2 else "".join(rng.choices("abcdefghij", k=6))


def text(rng, n):
    return [word(rng) for _ in range(n)]


def frame(spark, docs):
    return spark.createDataFrame([(k, t, None if t is None else len(t), "s") for k, t in docs], "doc_id long, text string, n_chars int, a string")


def test_planted_passages_are_cut(spark):
    rng = random.Random(6)
    shared = [text(rng, n) for n in (51, 60, 120, 400)]
    docs, parts = [], {}
    for k in range(80):
        before, after = text(rng, rng.randrange(0, 90)), text(rng, rng.randrange(0, 90))
        passage = shared[k % 4]
        if k >= 60:  # near: every 60th word is another
            passage = [word(rng) if i % 60 == 30 else w for i, w in enumerate(passage)]
        docs.append((k, " ".join(before + passage + after)))
        parts[k] = before, passage, after
    docs += [(100 + k, " ".join(text(rng, 300))) for k in range(40)]  # clean
    source = frame(spark, docs)
    out = {r.doc_id: r.text for r in passages.cut_repeats(source).collect()}
    assert len(out) == len(docs)
    for k, t in docs:
        if k in parts and k >= 4 and (k < 60 or k % 4 > 1):
            before, passage, after = parts[k]
            assert len(out[k].split()) <= len(before) + len(after) + (6 if k < 60 else 14), k  # an edit near an end parts a few words from a near passage
            assert out[k].split()[: max(0, len(before) - 5)] == before[: max(0, len(before) - 5)]
            assert after[6:] == out[k].split()[len(out[k].split()) - len(after) + 6 :] or len(after) < 8
        elif k < 4 or k >= 100:
            assert out[k] == t


def test_found_passages_hold(spark):
    """Every passage found on the given documents is one, and no passage of 60 equal words is missed."""
    docs = {r.doc_id: r.text for r in table(spark, DATA, "documents").collect()}
    rows = QUERIES["op8_repeated_passages"](spark, DATA).collect()
    spans = {}
    shingles = lambda t: {tuple(w) for w in zip(*(t.lower().split()[k:] for k in range(5)))}
    for r in rows:
        passage = docs[r.doc_id][r.start : r.start + r.length]
        own = shingles(passage)
        assert r.first_doc_id < r.doc_id and len(passage.split()) == r.words >= 50
        assert len(own & shingles(docs[r.first_doc_id])) >= 0.8 * len(own)
        spans.setdefault(r.doc_id, []).append((r.start, r.start + r.length))
    seen, missed, checked = {}, [], 0
    for k in sorted(docs):
        w, at, positions = docs[k].lower().split(), 0, []
        for x in docs[k].split():
            at = docs[k].index(x, at)
            positions.append(at)
            at += len(x)
        own = {}
        for i in range(len(w) - 59):
            h = hash(tuple(w[i : i + 60]))
            if seen.get(h, k) != k:
                checked += 1
                mid = positions[i + 30]
                if not any(a <= mid < b for a, b in spans.get(k, [])):
                    missed.append((k, i))
            own.setdefault(h, k)
        for h in own:
            seen.setdefault(h, k)
    assert checked > 100 and len(missed) <= 0.001 * checked


def test_hot_passage_and_hot_line(spark, monkeypatch):
    """A passage and a line of very many documents, over tasks that join their windows in small parts."""
    rng = random.Random(7)
    hot, line = text(rng, 70), text(rng, 12)
    docs = [(k, " ".join(text(rng, 40) + line + text(rng, 20) + hot + text(rng, 30))) for k in range(300)]
    source = frame(spark, docs).repartition(7)
    found = passages.repeated_passages(source).collect()
    assert {r.doc_id for r in found} == set(range(1, 300))
    assert all(abs(r.words - 70) <= 10 for r in found)


def test_odd_rows(spark):
    rng = random.Random(8)
    passage, other = " ".join(text(rng, 80)), " ".join(text(rng, 80))
    docs = [(None, passage), (1, None), (2, ""), (3, passage), (3, passage), (4, "é " + passage.upper() + " ü"), (5, "a b"), (3, other), (6, other), (7, passage + "\n" + passage)]
    out = passages.cut_repeats(frame(spark, docs))
    assert out.columns == ["doc_id", "text", "n_chars", "a"]
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    want = [(None, passage), (1, None), (2, ""), (3, passage), (3, passage), (4, "é  ü"), (5, "a b"), (3, other), (6, ""), (7, "\n")]
    assert [x for x in got if x[0] != 7] == sorted([x for x in want if x[0] != 7], key=str)
    assert len([x for x in got if x[0] == 7][0][1].split()) <= 80
    assert passages.cut_repeats(frame(spark, docs).limit(0)).count() == 0


def shared_behind_a_part(rng, n):
    """Ids 3i have the middle of a passage, 3i + 1 and 3i + 2 all of it."""
    docs = []
    for k in range(n):
        passage = text(rng, 60)
        for j, part in enumerate((passage[10:50], passage, passage)):
            docs.append((3 * k + j, " ".join(text(rng, 70) + part + text(rng, 70))))
    return docs


def test_a_document_with_a_part_of_a_passage_hides_no_repeat(spark):
    docs = shared_behind_a_part(random.Random(9), 150)
    found = {(r.doc_id, r.first_doc_id) for r in passages.repeated_passages(frame(spark, docs)).collect() if r.words >= 60}
    assert {(3 * k + 2, 3 * k + 1) for k in range(150)} <= found
    assert all(b % 3 == 2 and a == b - 1 for b, a in found)


def test_repeats_are_found_over_tasks(spark):
    """The first document is in one task, one with a part of its passage and one with all of it are in another."""
    rng = random.Random(10)
    docs = shared_behind_a_part(rng, 60)
    order = {0: 1, 1: 0, 2: 2}  # the whole passage comes first
    docs = [(k - k % 3 + order[k % 3], t) for k, t in docs]
    firsts, rest = [d for d in docs if d[0] % 3 == 0], [d for d in docs if d[0] % 3]
    want = {3 * k + 2 for k in range(60)}
    for source in (frame(spark, firsts).coalesce(1).union(frame(spark, rest).coalesce(1)), frame(spark, docs).coalesce(1), frame(spark, docs).repartition(13)):
        assert {r.doc_id for r in passages.repeated_passages(source).collect() if r.words >= 60} == want


def shared_behind_halves(rng, n):
    """Ids 4i and 4i + 1 have a half of a passage each, 4i + 2 and 4i + 3 all of it but for one word."""
    docs = []
    for k in range(n):
        passage = text(rng, 70)
        edited = passage[:35] + [word(rng) + "x"] + passage[36:]
        for j, part in enumerate((passage[:35], passage[36:], passage, edited)):
            docs.append((4 * k + j, " ".join(text(rng, 70) + part + text(rng, 70))))
    return docs


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_near_copies_meet_behind_documents_with_their_halves(spark, parts):
    docs = shared_behind_halves(random.Random(11), 200)
    found = passages.repeated_passages(frame(spark, docs).repartition(parts)).collect()
    assert all(r.doc_id % 4 == 3 and r.first_doc_id == r.doc_id - 1 for r in found)
    assert len({r.doc_id for r in found}) >= 198


def near_pairs(docs, shortest=50, width=5, similar=0.8):
    """(later, earlier) documents whose texts have passages of ``shortest`` words or more on one diagonal that are
    as similar as asked, by trying every one."""
    sets = {k: [tuple(w[i : i + width]) for i in range(len(w) - width + 1)] for k, w in ((k, t.lower().split()) for k, t in docs)}
    places = {}
    for k, own in sets.items():
        for i, x in enumerate(own):
            places.setdefault(x, []).append((k, i))
    out, t = set(), shortest - width + 1
    diagonals = Counter((b, a, j - i) for b, own in sets.items() for i, x in enumerate(own) for a, j in places[x] if a < b)
    for (b, a, d), n in diagonals.items():
        ends = [(i, j) for i in range(max(0, -d), len(sets[b])) for j in range(i + t, min(len(sets[b]), len(sets[a]) - d) + 1)]
        for i, j in ends if n >= similar * t else ():
            one, two = set(sets[a][i + d : j + d]), set(sets[b][i:j])
            if len(one & two) >= similar * len(one | two):
                out.add((b, a))
                break
    return out


def test_near_passages_against_brute_force(spark):
    """Groups of passages with one word in 60 changed: every document that has one of an earlier one is found, no other."""
    rng, docs = random.Random(12), []
    for k in range(150):
        passage = text(rng, rng.randrange(60, 140)) if k % 3 == 0 else passage
        edited = [word(rng) + "x" if i % 60 == 30 + k % 3 else w for i, w in enumerate(passage)]
        docs.append((k, " ".join(text(rng, 50) + edited + text(rng, 50))))
    want = near_pairs(docs)
    got = {(r.doc_id, r.first_doc_id) for r in passages.repeated_passages(frame(spark, docs)).collect()}
    later = {b for b, _ in want}
    assert len(later) >= 80 and got <= want
    assert len({b for b, _ in got} & later) >= 0.97 * len(later)


def test_hot_runs_and_documents_are_dealt(spark, monkeypatch):
    """Keys of more rows than a task takes give what they give otherwise."""
    rng = random.Random(13)
    hot = text(rng, 70)
    docs = [(k, " ".join(text(rng, 20) + hot + text(rng, 20))) for k in range(60)]
    want = sorted(passages.repeated_passages(frame(spark, docs)).collect())
    monkeypatch.setattr(passages, "HOT_ROWS", 7)
    assert sorted(passages.repeated_passages(frame(spark, docs)).collect()) == want and {r.doc_id for r in want} == set(range(1, 60))
