"""Fill-in-the-middle against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from snaplake.llm import fill_middle, queries
from snaplake.llm.fill_middle import Exceptions, fill_in_middle, restored

TEXTS = [
    None, "", "a", "<P>", "one <S> two", "<M", "two words", "ä", "日本語のテキスト", "a😀b😀", "\n\t x ", "Wörter, die mehrere Bytes haben",
    "<<S>>", "a<", "word " * 40_000, "é" * 30_000, "same text", "same text",
]


def expected(doc_id, text, unit):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text) if unit == "words" else list(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    output = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), "spm" if h[3] % 100 < 20 else "psm", len(p), len(m), output


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    alphabet = "abcXYZ  ,.é日😀\n<>PSM"
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(300)]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(None, "no id", "x"), (16, "same text", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, output string").repartition(3)


@pytest.mark.parametrize("unit", ["words", "points"])
def test_rows_equal_brute_force(docs, unit):
    made = fill_in_middle(docs, unit=unit)
    back = made.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    given = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
    assert sorted((tuple(r)[:-1] for r in back), key=str) == sorted((expected(i, t, unit) for i, t in given), key=str)
    assert {r["form"] for r in back} == {"plain", "psm", "spm"}
    assert sorted((str(r["doc_id"]), r["back"]) for r in back) == sorted((str(i), t or "") for i, t in given)


def test_an_empty_table_and_an_unknown_unit(spark, docs):
    assert fill_in_middle(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fill_in_middle(docs, unit="bytes")


def test_exceptions_convert_both_ways():
    rng = random.Random(1)
    for _ in range(50):
        text = "".join(rng.choices("ab é日😀", k=rng.randint(1, 80)))
        index = Exceptions(np.frombuffer(text.encode(), np.uint8))
        points = np.arange(len(text) + 1)
        places = np.array([len(text[:k].encode()) for k in points])
        assert (index.byte_places(np.zeros_like(points), points) == places).all()
        assert (index.code_points(np.zeros_like(places), places) == points).all()
        half = len(text) // 2
        assert (index.byte_places(np.full(len(points) - half, places[half]), points[half:] - half) == places[half:]).all()


def test_the_index_holds_only_characters_of_several_bytes():
    assert len(Exceptions(np.frombuffer(b"plain ASCII only", np.uint8)).at) == 0


def test_the_query_has_its_columns(spark):
    got = queries.QUERIES["op12_fill_in_middle"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
