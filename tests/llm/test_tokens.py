"""Token ids: encoder, Huffman files and packing against the library itself and exact round trips."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snaplake.llm import huffman, packing
from snaplake.llm.common import blocks
from snaplake.llm.queries import QUERIES
from snaplake.llm.vocabulary import Encoder, encoder
from snaplake.workspace import shared_dir

DATA = "/root/testdata/sf0.001"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "", " ", "  a", "a  ", "a  \nb c", "don't I'll we've 'tis it 's x''s 'S DON'T", "“quoted”, ‘x’ — y…", "\n\n a \t\tb\r\n",
    "12,345.67% x2y,z3.", "é, É. ñ! ß? Ünï×, a÷b, ×. ª º µ", "cómo ́x", "日本語, テキスト。 ok", "😀, a😀,b", "<|endoftext|> <|startoftext|>x",
    "a_b-c/d@e.f", "x" * 5000 + "," + "ab " * 3, "ΣΑΣ, ς", "a\x1cb \x85 c", "İ, İ", "a  \nb", "a\n　 b",
]


def library(path):
    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def encoded(e, texts):
    out = []
    for _, data, bounds in blocks(pa.array(texts), 1 << 12):
        ids, at = e.encode(data, bounds)
        out += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    return out


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_is_the_library(path):
    one = library(path)
    assert encoded(encoder(path), HARD) == [one(t) for t in HARD]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_strings_of_added_tokens(path):
    one = library(path)
    added = [t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()]
    texts = [f for a in added for f in (a, f"hello {a} world", f"x{a}y {a}{a}", f"{a[:-1]} {a.upper()} é{a}", "x " * 3000 + a)] + ["plain one"]
    assert encoded(encoder(path), texts) == [one(t) for t in texts] and any(len(one(a)) == 1 for a in added)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab ,.'s\nt1é×  Á")), max_size=30), min_size=1, max_size=8))
def test_encoder_on_any_text(texts):
    for path in (BYTES, WORDS):
        assert encoded(encoder(path), texts) == list(map(library(path), texts))


def test_encoder_forgets_when_full(monkeypatch):
    monkeypatch.setattr("snaplake.llm.vocabulary.MAX_SLOTS", 1 << 17)
    e, one = Encoder(BYTES), library(BYTES)
    e._clear(64)
    monkeypatch.setattr("snaplake.llm.vocabulary.MAX_SLOTS", 128)
    texts = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)} next" for k in range(300)]
    for t in texts:
        assert encoded(e, [t]) == [one(t)]
    assert e.slots == 128


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=300), st.integers(9, 14))
def test_code_is_limited_and_round_trips(counts, longest):
    lengths = huffman.code_lengths(np.array(counts), longest)
    assert lengths.max() <= longest and (2.0 ** -lengths).sum() <= 1
    code = huffman.Code(np.arange(len(counts)) * 3, lengths)
    ids = np.random.default_rng(len(counts)).integers(0, len(counts), 1000).astype(np.uint32) * 3
    for n in (0, 1, 255, 256, 257, 1000):
        payload, checkpoints = code.encode(ids[:n])
        if n:
            assert (code.decode(payload, checkpoints, n) == ids[:n]).all()


def test_code_lengths_are_the_best():
    assert huffman.code_lengths(np.array([1, 1, 2, 4, 8]), 12).tolist() == [4, 4, 3, 2, 1]
    cost = lambda longest: (huffman.code_lengths(np.array([1, 1, 2, 4, 8]), longest) * [1, 1, 2, 4, 8]).sum()
    assert cost(12) <= cost(4) <= cost(3)
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9), 3)


def small(spark):
    rows = [(3, "the and of", 9), (1, None, 1), (2, "", 2), (None, "no id", 5), (3, "a twin of three", 5), (7, "long word " * 3000, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids int")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_round_trip(spark):
    folder = shared_dir(spark)
    huffman.write_ids(small(spark), folder, BYTES)
    got = [tuple(r) for r in huffman.read_ids(spark, folder).orderBy("start").collect()]
    one, at, want = library(BYTES), 0, []
    for k, t, _ in sorted(small(spark).collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = one(t or "") + [2]
        want.append((k, at, len(ids), bytearray(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_empty_table(spark):
    folder = shared_dir(spark)
    none = spark.createDataFrame([], "doc_id long, text string")
    huffman.write_ids(none, folder, BYTES)
    assert huffman.read_ids(spark, folder).count() == 0
    assert packing.pack(none, WORDS).count() == 0


def test_op5_on_all_documents(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op5_token_files"](spark, DATA).collect()}
    one, at = library(BYTES), 0
    for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect():
        ids = one(r.text or "") + [2]
        assert got.pop(r.doc_id) == (at, len(ids), crc(ids))
        at += len(ids)
    assert not got


def packed_well(rows, docs, size=4096):
    one, seqs, pieces = library(WORDS), {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for k, text in docs:
        ids = one(text or "") + [1]
        own = sorted(pieces.pop(k), key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in own] == [(i, s, min(size, len(ids) - s)) for i, s in enumerate(range(0, len(ids), size))]
        assert all(r["ids_crc32"] == crc(ids[r["start"] : r["start"] + r["length"]]) for r in own)
    assert not pieces
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= size
    return len(seqs)


def test_op6_on_all_documents(spark):
    rows = [r.asDict() for r in QUERIES["op6_packing"](spark, DATA).collect()]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    n = packed_well(rows, docs)
    assert n <= sum(r["length"] for r in rows) / 4096 * 1.05 + 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 6))
def test_best_fit_never_overfills(lengths, open_bins):
    fit, used = packing.BestFit(50, open_bins), {}
    for n in lengths:
        number, offset = fit.place(n)
        assert offset == used.get(number, 0) and offset + n <= 50
        used[number] = offset + n
        assert fit.open == sum(map(len, fit.by_space.values())) <= open_bins
    assert fit.made == len(used)


def test_the_fullest_closes_first():
    fit = packing.BestFit(10, 2)
    assert fit.place(6) == (0, 0) and fit.place(7) == (1, 0)
    assert fit.place(8) == (2, 0)  # the one with 7 closes
    assert fit.place(3) == (0, 6) and fit.place(2) == (2, 8)


def test_pack_handles_odd_rows(spark):
    from pyspark.sql import functions as F

    rows = packing.pack(small(spark), WORDS).withColumn("ids_crc32", F.crc32("ids")).drop("ids").collect()
    assert sorted((r.doc_id, r.length) for r in rows if r.doc_id in (1, 2)) == [(1, 1), (2, 1)]
    assert sum(r.doc_id is None for r in rows) == 1 and sum(r.doc_id == 3 for r in rows) == 2
