"""The Merkle manifest against plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from snaplake.llm import merkle, queries
from snaplake.llm.common import stored

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, path string, hash string, tree long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def levels(hashes, arity=8):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][k : k + arity]) for k in range(0, len(out[-1]), arity)])
    return out


def siblings(tree, k, arity=8):
    found = []
    for level in tree[:-1]:
        run = k - k % arity
        found.append(("".join(level[run:k]), "".join(level[k + 1 : run + arity])))
        k //= arity
    return found


def expected(rows, arity=8):
    groups = {}
    for r in rows:
        groups.setdefault("" if r[2] is None else "=" + r[2], []).append(r)
    trees = {}
    for g, members in groups.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in members], arity)
    order = sorted(groups, key=lambda g: g.encode())
    top = levels([trees[g][-1][0] for g in order], arity)
    out = []
    for i, g in enumerate(order):
        for k, r in enumerate(groups[g]):
            path = siblings(trees[g], k, arity) + siblings(top, i, arity)
            seen = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                seen = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            h = leaf(seen)
            for left, right in path:
                h = H(left, h, right)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], H(*[a + b for a, b in path]), h, h == top[-1][0]))
    return sorted(out, key=str)


def run(spark, frame, arity=8):
    docs = frame
    own, changed = (merkle.leaf(*[docs[c] for c in ("doc_id", "source", "lang", "n_chars")], t) for t in (docs["text"], merkle.lower_ascii(docs["text"])))
    tampered = F.crc32(docs["doc_id"].cast("string")) % 3 == 0
    leaves = stored(docs.select("doc_id", "lang", own.alias("leaf"), F.when(tampered, changed).otherwise(own).alias("seen")), "leaves")
    built = merkle.manifest(leaves, group="lang", order=["doc_id"], hash_="leaf", arity=arity)
    got = built.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("p"), merkle.folded(F.col("seen"), F.col("path")).alias("f"))
    return sorted((tuple(r) for r in got.withColumn("v", F.col("f") == F.col("root")).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "h", 1) for r in rows], SCHEMA)


def made(sizes, seed=1):
    rng = random.Random(seed)
    ids = rng.sample(range(100_000), sum(sizes.values()))
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((ids.pop(), rng.choice(["web", None, ""]), lang, rng.choice([None, 5]), rng.choice([None, "", "Ä Text", "A", "lower", "x" * 50])))
    return rows


@pytest.mark.parametrize("sizes", [{"en": 600, "de": 65, None: 8, "": 1, "fr": 9}, {"en": 1}, {"en": 20}, {f"l{k}": 1 + k % 2 for k in range(75)}])
def test_rows_equal_brute_force(spark, sizes):
    rows = made(sizes)
    assert run(spark, frame(spark, rows).repartition(5)) == expected(rows)


def test_repeated_rows_ties_and_rows_without_an_id(spark):
    rows = made({"en": 30})
    rows += [rows[0]] * 20 + [(None, "web", "en", 1, "no id"), (None, "web", "en", 1, "No id"), (rows[1][0], "other", "en", 2, "Same id")]
    assert run(spark, frame(spark, rows)) == expected(rows)


def test_many_copies_are_made_in_parts(spark, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 7)
    rows = made({"en": 3, "de": 2})
    rows += [rows[0]] * 40
    assert run(spark, frame(spark, rows)) == expected(rows)


def test_windows_end_between_runs(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_RUNS", 2)
    monkeypatch.setattr(merkle, "RANGE_ROWS", (10, 20))
    rows = made({"en": 150, "de": 40})
    assert run(spark, frame(spark, rows), arity=4) == expected(rows, arity=4)


def test_an_empty_table(spark):
    assert run(spark, frame(spark, [])) == []


def test_a_change_is_seen_and_nothing_else(spark):
    got = queries.QUERIES["op13_manifest"](spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        text = docs[r["doc_id"]]["text"]
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in text or "")
        assert r["verified"] == (not changed)


def test_the_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    for name in ("op12_fill_in_middle", "op13_manifest"):
        got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        sql = con.execute(queries.ORACLES[name])
        columns = [d[0] for d in sql.description]
        assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, sql.fetchall()))
