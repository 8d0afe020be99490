"""Token counts against plain sums, license scans against planted notices."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from snaplake.llm import licenses, token_counts
from snaplake.llm.common import table
from snaplake.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_op2_on_all_documents(spark):
    one = Tokenizer.from_file(BYTES)
    docs = table(spark, DATA, "documents").collect()
    by = {None: []}
    for r in docs:
        n = len(one.encode(r.text or "", add_special_tokens=False).ids)
        by[None].append(n)
        by.setdefault(r.lang or "", []).append(n)
    rows = QUERIES["op2_token_counts"](spark, DATA).collect()
    limits = {512, 1024, 2048, 4096, 8192, 32768, 131072}
    assert {(r.part, r.length) for r in rows} == {(k, n) for k, v in by.items() for n in limits | set(v)}
    assert len(rows) == len({(r.part, r.length) for r in rows})
    for r in rows:
        v = np.array(by[r.part])
        assert (r.documents, r.tokens) == ((v == r.length).sum(), v[v == r.length].sum())
        assert (r.documents_from, r.tokens_from) == ((v >= r.length).sum(), v[v >= r.length].sum())
        assert r.cut_total == np.minimum(v, r.length).sum() and abs(r.share_to - (v <= r.length).mean()) < 1e-12


def test_counts_of_odd_rows(spark):
    rows = [(None, "a", 1), ("", "b", 2), ("x y", None, 3), ("x y", None, 3)]
    docs = spark.createDataFrame(rows, "text string, lang string, length int")
    got = {(r.part, r.length): r.documents for r in token_counts.length_histogram(docs, BYTES, group="lang").collect()}
    assert got == {(None, 0): 2, (None, 2): 2, ("", 2): 2, ("a", 0): 1, ("b", 0): 1}
    assert token_counts.length_histogram(docs, BYTES).filter("part is not null").count() == 0
    assert token_counts.length_histogram(docs.limit(0), BYTES, limits=[5]).count() == 0


def scan(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    return sorted((tuple(r)[:4] + (r.differences,) for r in licenses.scan_licenses(docs).collect()), key=str)


def test_every_template_is_found_and_told_apart(spark):
    rows, want = [], []
    for name, texts in licenses.TEMPLATES.items():
        for t in texts:
            k = len(rows)
            rows.append((k, f"Some line.\n{t}\nAnother", None))
            want.append((k, 11, len(t), name, 0))
    assert scan(spark, rows) == sorted(want, key=str)


def test_notices_in_sentences_with_differences_and_none(spark):
    rows = [
        (1, "We wrote this. Licensed under the Apache License, Version 2.0. Use it.", "x"),
        (2, "released under THE mit licence!", None),
        (3, "They licensed under the counter, with rights to nothing of it.", None),
        (4, None, None), (5, "", None), (None, "Released under the MIT License.", None),
        (7, "Released under the MIT License.\n" * 2, None), (8, "word " * 20_000 + "\nLicensed under CC BY-NC 4.0.", None),
        (9, "Subject to the terms and public domain copyright creative commons", None),
    ]
    got = scan(spark, rows)
    assert [(g[0], g[3], g[4]) for g in got] == sorted(
        [(1, "Apache-2.0", 0), (2, "MIT", 1), (None, "MIT", 0), (7, "MIT", 0), (7, "MIT", 0), (8, "CC-BY-NC-4.0", 0)], key=lambda g: str(g)
    )
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_op7_finds_every_line_with_a_license(spark):
    got = {(r.doc_id, r.block.strip()) for r in QUERIES["op7_license_scan"](spark, "/root/testdata/sf0.1").collect()}
    want = set()
    for r in table(spark, "/root/testdata/sf0.1", "documents").collect():
        want |= {(r.doc_id, line.strip()) for line in (r.text or "").split("\n") if ("icense" in line or line == "All rights reserved.") and len(line) < 90}
    assert got == want and want


def test_word_distance():
    assert licenses.word_distance("a b c".split(), "a x c d".split()) == 2
    assert licenses.word_distance([], ["a"]) == 1


def names(text):
    return [f[2] for f in licenses.Scanner(licenses.TEMPLATES).scan(text)]


def test_notices_as_they_stand_in_corpora():
    mit = licenses.TEXTS["MIT"][0]
    assert names('Licensed under the Apache License, Version 2.0 (the "License");') == ["Apache-2.0"]
    assert names("This file is licensed under the MIT License.") == ["MIT"]
    assert names("Copyright 2024 Foo, all rights reserved.") == ["Proprietary"]
    assert names("SPDX-License-Identifier: MIT") == ["MIT"]
    assert names("/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note OR (mit AND Foo-1.1) */") == ["GPL-2.0", "Linux-syscall-note", "MIT", "Foo-1.1"]
    assert names(mit[:700]) == [] and names("x\n" + mit) == ["MIT"]
    assert names("# This work is licensed under the GNU General\n#   Public License, version 3.\nfoo()") == ["GPL-3.0"]
    assert names("Released under the Zlib License.") == ["Zlib"]
    for other in ("Released under the Foo License.", "Released under the Artistic License.", "Licensed under the Apache License, Version 1.1.",
                  "Licensed under the GNU Library General Public License, version 2.", "Licensed under CC BY-NC 3.0.", "He has a license, and all of it is his right."):
        assert names(other) == [], other


def test_whole_texts_wrapped_commented_and_changed():
    for name, texts in licenses.TEXTS.items():
        for t in texts:
            w = t.split()
            lines = ["// " + " ".join(w[k : k + 11]) for k in range(0, len(w), 11)]
            assert names("code();\n" + "\n".join(lines) + "\nmore();") == [name]
            changed = ["other" if k % 12 == 7 else x for k, x in enumerate(w)]
            assert names("word " * 300 + " ".join(changed) + " word" * 300) == [name]
    both = licenses.TEXTS["BSD-2-Clause"][0] + "\n\n" + licenses.TEXTS["BSD-3-Clause"][0] + "\nReleased under the MIT License."
    assert names(both) == ["BSD-2-Clause", "BSD-3-Clause", "MIT"]


def test_many_notices_over_pieces():
    notices = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "All rights reserved."] * 150
    got = list(licenses.Scanner(licenses.TEMPLATES).scan("\n".join(notices)))
    assert [g[6] for g in got] == notices and all(g[5] == 0 for g in got)


def test_alignments_are_those_of_all_stretches():
    rng = np.random.default_rng(3)
    for _ in range(60):
        wanted, own = rng.integers(0, 4, rng.integers(1, 6)), rng.integers(0, 4, rng.integers(0, 14))
        d = {(x, y): licenses.word_distance(list(wanted), list(own[x:y])) for x in range(len(own)) for y in range(x + 1, len(own) + 1)}
        for most in range(len(wanted)):
            got = licenses.alignments(wanted, own, most)
            assert all(d[x, y] == k <= most for x, y, k in got)
            assert min((k for _, _, k in got), default=None) == min((k for k in d.values() if k <= most), default=None)
            assert all(y <= u or v <= x for n, (x, y, _) in enumerate(got) for u, v, _ in got[n + 1 :])


def test_op7_leaves_out_no_template_that_all_stretches_confirm(spark):
    """Each cue line of the given documents against every template by plain word distance over all its stretches."""
    got = {}
    for r in QUERIES["op7_license_scan"](spark, DATA).collect():
        got.setdefault(r.doc_id, []).append(r)
    flat = [(n, licenses.words_of(t), t) for n, texts in licenses.NOTICES.items() for t in texts if len(t) < 90]
    checked = 0
    for r in table(spark, DATA, "documents").collect():
        for line in (r.text or "").split("\n"):
            if not licenses._CUE.search(line) or len(line) > 120:
                continue
            own, best = licenses.words_of(line), None
            for name, wanted, _ in flat:
                for x in range(len(own)):
                    for y in range(x + 1, len(own) + 1):
                        d = licenses.word_distance(wanted, own[x:y])
                        if d <= int(0.2 * len(wanted)) and licenses.telling(own[x:y], True) == licenses.telling(wanted, True):
                            best = min(best or (9, ""), (d, name))
            if best:
                checked += 1
                assert best[1] in {g.license for g in got[r.doc_id] if g.block in line}
            else:
                assert not any(g.block in line for g in got.get(r.doc_id, ()))
    assert checked


def test_clashing_columns_and_ties(spark):
    docs = spark.createDataFrame([(1, "Released under the MIT License.", "x", "y", 3)], "doc_id long, text string, license string, block string, saved int")
    assert [tuple(r)[:4] for r in licenses.scan_licenses(docs).collect()] == [(1, 0, 31, "MIT")]
    twice = {"A": ["Given under these terms of license."], "B": ["Given under these terms of license."]}
    assert [f[2] for f in licenses.Scanner(twice).scan("Given under these terms of license.")] == ["A"]
