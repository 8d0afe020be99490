"""Benchmark passages: LSH against an edit-distance search of every item in every text."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from snaplake.llm import decontaminate
from snaplake.llm.common import table
from snaplake.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def split(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def search(item, text):
    """The least edit distance of ``item`` to a passage of ``text``."""
    last = list(range(len(item) + 1))
    best = last[-1]
    for w in text:
        row = [0]
        for i, x in enumerate(item, 1):
            row.append(min(last[i] + 1, row[-1] + 1, last[i - 1] + (x != w)))
        last = row
        best = min(best, last[-1])
    return best


def test_edit_search_is_the_plain_one():
    rng = random.Random(2)
    for _ in range(300):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 12))]
        text = [rng.randrange(4) for _ in range(rng.randrange(0, 30))]
        d, end = decontaminate.edit_search(item, text)
        assert d == search(item, text)
        assert search(item, text[:end]) == d and (end == 0 or search(item, text[: end - 1]) > d)


def planted(n=240, edits=0.2, seed=4):
    """Texts with an item each that has ``edits`` of its words changed, put in or left out."""
    rng = random.Random(seed)
    common = ["the", "of", "and", "to", "in", "a"]
    word = lambda: rng.choice(common) if rng.random() < 0.3 else "".join(rng.choices("abcdefghij", k=6))
    items = [[word() for _ in range(rng.randrange(15, 60))] for _ in range(40)]
    texts = []
    for k in range(n):
        item = list(items[k % 40])
        for _ in range(int(edits * len(item) + 1e-9)):
            at = rng.randrange(len(item))
            what = rng.randrange(3)
            if what == 0:
                item[at] = word()
            elif what == 1:
                item.insert(at, word())
            else:
                del item[at]
        text = [word() for _ in range(rng.randrange(0, 200))] + item + [word() for _ in range(rng.randrange(0, 200))]
        texts.append(" ".join(text))
    return [" ".join(i) for i in items], texts


def frames(spark, items, texts):
    return (
        spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, item_id string"),
        spark.createDataFrame(list(enumerate(items)), "item_id long, text string"),
    )


def test_recall_of_edited_items(spark):
    for edits, least in ((0.0, 1.0), (0.1, 0.99), (0.2, 0.9)):
        items, texts = planted(edits=edits)
        got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.benchmark_passages(*frames(spark, items, texts)).collect()}
        want = {(k, k % 40): search(split(items[k % 40]), split(t)) for k, t in enumerate(texts)}
        want = {k: d for k, d in want.items() if d <= int(0.2 * len(split(items[k[1]])) + 1e-9)}
        assert len(want & got.keys()) >= least * len(want)
        assert all(got[k] == want[k] for k in want.keys() & got.keys())
        assert got.keys() <= want.keys()


def test_op4_on_all_documents(spark):
    got = QUERIES["op4_decontamination"](spark, DATA).collect()
    items = {r.item_id: split(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    want = set()
    for d, text in docs.items():
        own = split(text)
        bag = set(own)
        for k, item in items.items():
            most = int(0.2 * len(item) + 1e-9)
            if sum(w not in bag for w in item) <= most and search(item, own) <= most:
                want.add((d, k))
    assert {(r.doc_id, r.item_id) for r in got} == want and want
    for r in got:
        passage = split(docs[r.doc_id][r.start : r.start + r.length])
        assert search(items[r.item_id], passage) == r.edits and abs(len(passage) - len(items[r.item_id])) <= r.edits


def test_clean_documents_keeps_the_rest_whole(spark):
    docs, benchmark = table(spark, DATA, "documents"), table(spark, DATA, "benchmark")
    gone = {r.doc_id for r in QUERIES["op4_decontamination"](spark, DATA).select("doc_id").collect()}
    kept = decontaminate.clean_documents(docs, benchmark)
    assert kept.schema == docs.schema
    want = docs.filter(~F.col("doc_id").isin(list(gone)))
    assert kept.exceptAll(want).count() == 0 and want.exceptAll(kept).count() == 0


def test_odd_rows_and_groups_of_items(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, None), (2, ""), (None, f"x {item.upper()}, y"), (4, f"{item} and {item}."), (4, item), (5, "one two"), (6, "é uno dos tres cuatro " + item.replace("five", "5"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(10, item), (10, item), (11, "a b"), (12, None), (None, item), (13, ""), (14, "é, uno dos tres cuatro")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.start, r.edits) for r in decontaminate.benchmark_passages(docs, benchmark).collect()), key=str)
    at = len(item) + 5
    assert got == sorted([(None, 10, 2, 0), (4, 10, 0, 0), (4, 10, at, 0), (4, 10, 0, 0), (6, 10, 22, 1), (6, 14, 0, 0)], key=str)
    assert len(list(decontaminate.indexes(benchmark, group_bytes=40))) > 1
    parts = list(decontaminate.indexes(benchmark, group_bytes=40))
    assert sorted(k for p in parts for k in p.ids) == [10, 14]
    assert decontaminate.benchmark_passages(docs.limit(0), benchmark).count() == 0
    assert decontaminate.benchmark_passages(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.clean_documents(docs, benchmark.limit(0)).count() == len(rows)


def test_walks_of_equal_windows_are_equal():
    rng = np.random.default_rng(0)
    a = rng.integers(1, 1 << 62, 50).astype(np.uint64)
    index = decontaminate.Index([1], [a[5:35]])
    keys = index._keys(a, np.array([5]), np.array([50]), list(index.classes))
    for c, k in keys.items():
        assert set(k[:, 0].tolist()) <= set(index.keys.tolist())


def index_of(items):
    cut = lambda t: decontaminate.split(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]
    hashes = [cut(t) for t in items]
    long = [k for k, h in enumerate(hashes) if len(h) >= decontaminate.FEWEST]
    return decontaminate.Index(long, [hashes[k] for k in long], short=[(k, h) for k, h in enumerate(hashes) if len(h) < decontaminate.FEWEST])


def found_in(index, texts):
    data = [t.encode() for t in texts]
    got = index.find(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    return {(t, k, b"".join(data)[a:b].decode(), d) for t, k, a, b, d in got}


def test_long_items_with_all_their_edits_are_found():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    for n in (200, 500, 800, 1000):
        items = [[word() for _ in range(n)] for _ in range(10)]
        texts = []
        for k in range(40):
            item = list(items[k % 10])
            for _ in range(n // 5):
                at, what = rng.randrange(len(item)), rng.randrange(3)
                item[at : at + (what != 1)] = [word()] if what < 2 else []
            texts.append(" ".join([*(word() for _ in range(60)), *item, *(word() for _ in range(60))]))
        got = found_in(index_of([" ".join(i) for i in items]), texts)
        assert {(t, k) for t, k, _, _ in got} == {(k, k % 10) for k in range(40)} and all(d <= n // 5 for *_, d in got)


def test_short_items_and_scripts_without_spaces():
    items = ["What now?", "我们今天去公园散步，然后回家。", "東京", "สวัสดีครับ"]
    texts = ["So what, NOW then; whatnow", "他说：我们今天去公园跑步，然后回家！好", "京東 東京", "x สวัสดีครับ y", "what", "now"]
    got = found_in(index_of(items), texts)
    assert got == {(0, 0, "what, NOW", 0), (1, 1, "我们今天去公园跑步，然后回家", 1), (2, 2, "東京", 0), (3, 3, "สวัสดีครับ", 0)}


def test_an_edited_copy_before_a_better_one_has_its_row():
    item = " ".join(f"w{k}" for k in range(20))
    edited = item.replace("w9 ", "other ")
    got = found_in(index_of([item]), [f"x y {edited} {item} z {edited}"])
    assert got == {(0, 0, edited, 1), (0, 0, item, 0)} and len(index_of([item]).find(*block(f"x y {edited} {item} z {edited}"))) == 3


def block(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)])
