"""Vector links against all pairs in double precision."""

import numpy as np
import pytest

from snaplake.llm import vector_join
from snaplake.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def brute(rows, least=0.93):
    """rows: (vec_id, embedding, label)."""
    def sound(r):
        return r[0] is not None and r[2] is not None and r[1] is not None and None not in r[1] and np.isfinite(r[1]).all() and np.any(np.array(r[1]) != 0)

    n = [0] * len(rows)
    root = {r[0]: r[0] for r in rows}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    good = [k for k, r in enumerate(rows) if sound(r)]
    for x, i in enumerate(good):
        a = np.array(rows[i][1], float)
        for j in good[x + 1 :]:
            b = np.array(rows[j][1], float)
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= least:
                n[i] += 1
                n[j] += 1
                p, q = sorted((top(rows[i][0]), top(rows[j][0])))
                root[q] = p
    return sorted(((r[0], n[k], top(r[0]), top(r[0]) == r[0]) if r[0] is not None else (None, 0, None, True) for k, r in enumerate(rows)), key=str)


def result(frame):
    return sorted((tuple(r) for r in frame.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def test_op3_on_all_vectors(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    assert result(QUERIES["op3_vector_links"](spark, DATA)) == brute(rows)


@pytest.mark.parametrize(("pivots", "per_pivot", "block"), [(256, 20, 16), (3, 10, 7), (0, 10, 1000)])
def test_pivots_and_blocks_do_not_change_results(spark, pivots, per_pivot, block):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 6))
    rows = [(k, (centers[k % 12] + rng.normal(size=6) * 0.35).tolist(), k % 3) for k in range(240)]
    rows += [(1000 + k, rows[0][1], 0) for k in range(30)]  # many equal ones
    rows += [(2000 + k, (np.array(rows[1][1]) * (k + 1)).tolist(), 1) for k in range(5)]  # of one direction
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, node int")
    assert result(vector_join.vector_links(frame, pivots=pivots, per_pivot=per_pivot, block=block)) == brute(rows)


def test_vectors_without_links(spark):
    one, nan = [1.0, 0.0], float("nan")
    rows = [
        (1, one, 0), (2, one, None), (3, None, 0), (4, [0.0, 0.0], 0), (5, [1.0, None], 0), (6, [1.0, nan], 0), (7, [float("inf"), 1.0], 0), (8, [], 0),
        (9, [1.0, 0.0, 0.0], 0), (10, [1e300, 0.0], 0), (None, one, 0), (11, [-1.0, 0.0], 0), (12, [1e-320, 0.0], 0),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r[0]: r for r in result(vector_join.vector_links(frame))}
    assert got[1] == (1, 2, 1, True) and got[10] == (10, 2, 1, False) and got[12] == (12, 2, 1, False)
    assert all(got[k] == (k, 0, k, True) for k in (2, 3, 4, 5, 6, 7, 8, 9, 11)) and got[None] == (None, 0, None, True)
    assert vector_join.vector_links(frame.limit(0)).count() == 0


def test_repeated_rows(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.1], 0)], "vec_id long, embedding array<double>, label int")
    assert result(vector_join.vector_links(frame)) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


def test_one_id_with_several_vectors(spark):
    rows = [(5, [1.0, 0.0], 0), (5, [0.0, 1.0], 0), (6, [1.0, 0.01], 0), (7, [1.0, 0.02], 0), (8, [0.01, 1.0], 0), (5, [1.0, 0.0], 1), (4, [1.0, 0.1], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = result(vector_join.vector_links(frame))
    assert got == brute(rows)
    assert sorted(r[1] for r in got if r[0] == 5) == [1, 1, 2] and [r[1] for r in got if r[0] == 6] == [2]
