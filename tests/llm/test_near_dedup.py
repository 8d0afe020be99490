"""Near-duplicate documents against all pairs of whole shingle sets."""

import random
import re

import numpy as np

from snaplake.llm import near_dedup
from snaplake.llm.common import mix
from snaplake.llm.components import components
from snaplake.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def shingles(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}


def brute(docs, percent=85):
    sets, ids = [shingles(t) for _, t in docs], [k for k, _ in docs]
    by, links = {}, []
    for n, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(n)
    for n, s in enumerate(sets):
        common = {}
        for x in s:
            for m in by[x]:
                if m > n:
                    common[m] = common.get(m, 0) + 1
        links += [(n, m) for m, c in common.items() if 100 * c >= percent * (len(s) + len(sets[m]) - c)]
    root = list(range(len(ids)))

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        if ids[a] < ids[b]:
            root[b] = a
        else:
            root[a] = b
    return sorted((ids[n], len(sets[n]), ids[top(n)], ids[n] == ids[top(n)]) for n in range(len(ids)))


def rows(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_op9_on_all_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert rows(QUERIES["op9_near_duplicates"](spark, DATA)) == sorted(brute(docs), key=str)


def test_chains_and_copies(spark):
    """Links of a chain whose ends aren't similar, a group of near copies, exact copies, short and empty texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    text = [word() for _ in range(120)]
    docs, at = [], 100
    for _ in range(12):  # each differs from the one before by a word at its end
        docs.append((at, " ".join(text)))
        text = text[6:] + [word() for _ in range(6)]
        at -= 1
    base = [word() for _ in range(80)]
    for k in range(60):
        base_k = list(base)
        base_k[rng.randrange(80)] = word()
        docs.append((200 + k, " ".join(base_k)))
    docs += [(300 + k, docs[0][1].upper()) for k in range(5)]
    docs += [(400, "a b"), (401, "A  b\n"), (402, ""), (403, None), (404, " \t"), (405, "a b c d e"), (406, "a b c d"), (407, "é"), (408, "É")]
    frame = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, keys int")
    assert rows(near_dedup.near_duplicates(frame)) == sorted(brute(docs), key=str)


def test_empty_table_null_ids_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert near_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows_ = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (4, "x"), (9, "x")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows_, schema)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(4, 4, True)] * 3 + [(9, 4, False)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2


def test_sketch_estimates_similarity():
    values = mix(np.arange(3000, dtype=np.uint64))
    for a, b in ((500, 400), (40, 30), (1, 1), (3, 2), (2000, 1700)):
        near = np.mean([(near_dedup.sketch(values[s : s + a], 200) == near_dedup.sketch(values[s : s + b], 200)).mean() for s in range(20)])
        assert abs(near - b / a) < 0.06
    assert (near_dedup.sketch(values[:1], 50) < 1 << 63).all()


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(k, k + 1) for k in range(1000, 1200)] + [(5000, 6000 + k) for k in range(300)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    least = {k: k for pair in links for k in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    assert {k: got.get(k, k) for k in least} == least
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_of_sets_connects_what_all_pairs_do():
    rng = np.random.default_rng(4)
    for trial in range(30):
        sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30))) for _ in range(25)]
        sets += [np.unique(np.append(sets[k][1:], 99)) for k in range(10)]
        n = len(sets)
        component = rng.integers(0, 30, n) * 7
        second = rng.random(n) < 0.5 if trial % 2 else None
        got = near_dedup.forest_of_sets(np.concatenate(sets), np.array([len(s) for s in sets]), component, second, 70)

        def classes(links):
            label = list(component)
            for a, b in links:
                label = [label[a] if x == label[b] else x for x in label]
            return {frozenset(k for k in range(n) if label[k] == x) for x in label}

        want = []
        for a in range(n):
            for b in range(a + 1, n):
                common = len(np.intersect1d(sets[a], sets[b]))
                if (second is None or second[a] != second[b]) and 100 * common >= 70 * (len(sets[a]) + len(sets[b]) - common):
                    want.append((a, b))
        links = list(zip(*(x.tolist() for x in got)))
        assert classes(links) == classes(want) and set(map(frozenset, links)) <= set(map(frozenset, want))
        assert len(links) < len(set(component))


def test_groups_a_little_under_the_threshold(spark, monkeypatch):
    """Copies of one text that differ from each other by more than the threshold, some pairs of which don't, in regions
    of several blocks."""
    monkeypatch.setattr(near_dedup, "REGION_ROWS", 16)
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base, docs = [word() for _ in range(200)], []
    for k in range(120):
        text = list(base)
        for at in rng.sample(range(200), 3 if k % 3 else 1):
            text[at] = word()
        docs.append((k, " ".join(text)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(near_dedup.near_duplicates(frame)) == sorted(brute(docs), key=str)
    assert rows(near_dedup.near_duplicates(frame, percent=93)) == sorted(brute(docs, 93), key=str)


def test_dealing_regions_joins_no_bucket_member_with_its_node(spark, monkeypatch):
    """Members of fine buckets are very many for each node; only the buckets meet nodes. ``cut`` blocks or one: same links."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 400)
    sets = []
    for d in range(60):
        own = base.copy()
        own[rng.choice(400, 12, replace=False)] = rng.integers(0, 1 << 62, 12)
        sets.append((d, sorted(own.tolist())))
    frame = spark.createDataFrame(sets, "doc_id long, shingles array<long>")
    keyed = frame.mapInArrow(near_dedup._fine_keys(near_dedup.fine_rows(85)), "node long, keys array<long>")
    found = spark.createDataFrame([], "node long, component long")
    plans, kept = {}, near_dedup.stored
    monkeypatch.setattr(near_dedup, "stored", lambda f, name: plans.update({name: f._jdf.queryExecution().optimizedPlan().toString()}) or kept(f, name))
    members = near_dedup._members(keyed).drop("hub")
    results = []
    for rows in (1_024, 8):
        monkeypatch.setattr(near_dedup, "REGION_ROWS", rows)
        links = near_dedup._across(members, found, frame, 85).collect()
        results.append(near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect())
        assert plans["links"].count("Join Inner, (node") <= 1  # the sets
    assert sorted(results[0]) == sorted(results[1]) and len(results[0]) > 0


def test_regions_need_no_join_of_members_with_their_bucket(spark, monkeypatch):
    """Each member of a fine bucket comes with the bucket's first, so the links that make regions follow by a filter."""
    rng = random.Random(14)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base, docs = [word() for _ in range(200)], []
    for k in range(80):
        text = list(base)
        for at in rng.sample(range(200), 3 if k % 3 else 1):
            text[at] = word()
        docs.append((k, " ".join(text)))
    plans, of = [], near_dedup.components
    monkeypatch.setattr(near_dedup, "components", lambda f: plans.append(f._jdf.queryExecution().optimizedPlan().toString()) or of(f))
    got = rows(near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == sorted(brute(docs), key=str)
    assert len(plans) == 3 and "hub" in plans[1] and "Join" not in plans[1]
