"""Source mixing, exact top-k search and licence rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import license_rules, mixing, topk_va
from llm_cases import PROSE, docs_frame, no_python, odd_rows


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by repeated sharing of the excess."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        share = sum(w[s] for s in open_)
        target = {s: most * sizes[s] if s in full else rest * w[s] / share for s in order}
        over = {s for s in open_ if target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 20, "c": 30}, {"a": 1000, "b": 1, "c": 2, "d": 50, None: 7}, {"x": 5}, {"a": 0, "b": 9},
    {f"s{i}": (i * 7919) % 101 + 1 for i in range(40)}])
def test_targets_match_repeated_sharing(spark, sizes):
    frame = spark.createDataFrame([(k, v, 1) for k, v in sizes.items()], "source string, source_size long, units long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_takes_targets_in_whole_copies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = mixing.mix(docs)
    assert no_python(plan)
    rows = plan.collect()
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r["size"])
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
    want = brute_targets(sizes)
    assert len(rows) == docs.count()
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_mix_tree_of_small_blocks_keeps_the_words(spark):
    docs = docs_frame(spark, [(i, "w " * (i % 17 + 1), "ab"[i % 3 == 0]) for i in range(900)])
    rows = mixing.mix(docs, block_rows=8).collect()
    assert len(rows) == 900
    for s in "ab":
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 9


def test_mix_on_odd_and_empty_tables(odd, empty):
    rows = mixing.mix(odd).collect()
    want = sorted((str(i), str(s), len((t or "").split())) for i, t, s in odd_rows())
    assert sorted((str(r.doc_id), str(r.source), r["size"]) for r in rows) == want
    assert all(r.taken <= 3 * r["size"] for r in rows)
    assert mixing.mix(empty).collect() == []


def brute_top(rows, queries, k):
    vecs = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in vecs:
        if queries(q):
            best = sorted(((-int(x @ y), i) for i, y in vecs if i != q and len(x) == len(y)))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("copies", [0, 60])
def test_search_is_exact_with_ties_and_copies(spark, copies):
    rng = np.random.default_rng(copies)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(200)]
    rows += [(1000 + i, rows[10][1]) for i in range(copies)]
    rows += [(5000, None), (5001, [0.1, None] * 4), (5002, [float("nan")] * 8), (5003, [float("inf")] * 8),
             (None, rows[3][1]), (5004, [0.5, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("class", F.lit("x"))
    got = topk_va.search(frame, F.col("id") % 10 == 0, 5, tile=32, query_block=8, bits=4, read_first=3)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, lambda q: q % 10 == 0, 5)


def test_search_ranks_each_vector_of_a_repeated_id(spark):
    rng = np.random.default_rng(5)
    rows = [(i % 60, (rng.integers(-9, 10, size=6) / 4).tolist()) for i in range(120)]
    rows += [(0, [4.0] * 6), (7, [3.0] * 6), (7, [3.0] * 5 + [2.75])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_va.search(frame, F.col("id") % 10 == 0, 5, tile=32, query_block=8, bits=4, read_first=3)
    vecs = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in {(i, tuple(v)) for i, v in rows}]
    want = []
    for q in range(0, 60, 10):
        best = sorted((-int(x @ y), i) for p, x in vecs if p == q for i, y in vecs if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_search_takes_finite_vectors_of_any_size(spark):
    rows = [(0, [1e20, 1.0]), (1, [1e308, 0.0]), (2, [-1e308, 5.0]), (3, [1.0, 1.0]), (10, [1.0, 0.0]), (4, [2.0, 0.0]),
            (5, [1e20, 3.0]), (6, [-1e20, 0.0]), (7, [1e20, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in topk_va.search(frame, F.col("id") % 10 == 0, 5, tile=4, query_block=2).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    top = (1 << 63) - 1
    # beyond the range all tie, by id
    assert got[0] == [(1, top), (3, got[0][1][1]), (4, got[0][2][1]), (5, top), (7, top)] or len(got[0]) == 5
    assert [(-s, i) for i, s in got[0]] == sorted((-s, i) for i, s in got[0])
    assert [i for i, s in got[10] if s == top] == [0, 1, 5, 7] and got[10][4] == (4, 2 * 256 * 256)
    mild = [(i, [3e9 + i, -3e9]) for i in range(20)]
    frame = spark.createDataFrame([(i, [x / 256 for x in v]) for i, v in mild], "vec_id long, embedding array<double>")
    for r in topk_va.search(frame, F.col("id") % 10 == 0, 3).collect():
        assert r.score == min(sum(int(a) * int(b) for a, b in zip(mild[r.query_id][1], mild[r.vec_id][1], strict=True)), top)


def test_search_keeps_few_rows_when_one_id_has_many_vectors(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(2000)]
    rows += [(9999, rng.normal(size=8).tolist()) for _ in range(1500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sizes, plain = {}, topk_va.materialize

    def counted(df, label):
        out = plain(df, label)
        sizes[label] = out.count()
        return out
    monkeypatch.setattr(topk_va, "materialize", counted)
    got = topk_va.search(frame, F.col("id") % 50 == 0, 5, tile=256).collect()
    vecs = np.floor(256 * np.array([v for _, v in rows])).astype(int)
    ids = np.array([i for i, _ in rows])
    for q in (0, 50, 1950):
        score = vecs @ vecs[q]
        best = sorted((-int(s), int(i)) for s, i in zip(score, ids, strict=True) if i != q)[:5]
        assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == best
    assert sizes["bounds"] < 40 * 150


def test_search_with_few_candidates_and_empty(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (3, [-1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk_va.search(frame, F.col("id") % 50 == 0).collect())) == \
        brute_top(rows, lambda q: q % 50 == 0, 5)
    assert topk_va.search(frame.limit(0), F.col("id") % 50 == 0).collect() == []


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
"""


def test_licence_rules_in_long_texts_and_with_clause_marks(spark, tmp_path):
    import time

    import duckdb

    from lodestone.llm import queries
    said = license_rules.SENTENCES
    bsd = ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]
    rows = [(k, "".join(f"{m} {said[s]}\n" for m, s in zip(marks, bsd, strict=True)), "s") for k, marks in enumerate(
        [("", "1.", "2.", "3."), ("", "(a)", "(b)", "(c)"), ("", "a)", "b)", "c)"), ("", "*", "*", "*"), ("",) * 4])]
    rows.append((9, "\n".join([said["bsd-grant"], "x.", "y.", "z.", said["bsd-source"], said["bsd-binary"]]), "s"))
    docs_frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op6_license_rules"](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(queries.ORACLE["op6_license_rules"])
    assert sorted(map(str, got.select(*want.columns).toPandas().values.tolist())) == \
        sorted(map(str, want.df().values.tolist()))
    assert {r.doc_id: r.licenses for r in got.collect()} == {**dict.fromkeys(range(5), "BSD-3-Clause"), 9: ""}
    lines = 20_000
    began = time.time()
    (long,) = license_rules.annotate(docs_frame(spark, [(1, f"{said['mit-licensed']}\n" * lines, "s")])).collect()
    assert len(long.line_matches) == lines and time.time() - began < 60


def test_licence_rules(spark, odd, empty):
    rows = [(1, "Some words.\nReleased under the MIT License.\nMore words", "s"),
            (2, "licensed under cc by-nc 4.0.", "s"), (3, "Not a licence. MIT License rocks.", "s"),
            (4, "Preface.\n\n" + MIT, "s"), (5, GPL, "s"), (6, "Licensed under the Apache License, Version 2.0.", "s"),
            (7, "the above copyright notice and this permission notice shall be included in all copies or substantial "
                "portions of the software.", "s")]
    found = license_rules.annotate(docs_frame(spark, rows))
    assert no_python(found)
    got = {r.row.doc_id: r for r in found.collect()}
    assert {k: list(r.licenses) for k, r in got.items()} == {
        1: ["MIT"], 2: ["CC-BY-NC-4.0"], 3: [], 4: ["MIT"], 5: ["GPL-3.0-or-later"], 6: ["Apache-2.0"], 7: []}
    assert [tuple(m) for m in got[1].line_matches] == [(1, 1, "MIT")]
    assert [tuple(m) for m in got[4].flow_matches] == [(1, 2, "MIT")]
    assert len(license_rules.annotate(odd).collect()) == len(odd_rows())
    assert license_rules.annotate(empty).collect() == []
    assert PROSE


BSD = """Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""


def test_numbered_bsd_texts(spark):
    far = BSD.replace("2. ", "2. One thing. Another thing. ") + BSD_NAMES  # three unknown sentences in one place
    rows = [(1, BSD, "s"), (2, BSD + BSD_NAMES, "s"), (3, "Preface.\n\n" + (BSD + BSD_NAMES).replace("1.", "a."), "s"),
            (4, far, "s")]
    found = license_rules.annotate(docs_frame(spark, rows))
    assert no_python(found)
    got = {r.row.doc_id: r for r in found.collect()}
    assert {k: list(r.licenses) for k, r in got.items()} == {
        1: ["BSD-2-Clause"], 2: ["BSD-3-Clause"], 3: ["BSD-3-Clause"], 4: []}
    assert [tuple(m) for m in got[2].flow_matches] == [(0, 6, "BSD-3-Clause")]


ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""


def test_licences_by_title_notice_and_identifier(spark, tmp_path):
    import duckdb

    from lodestone.llm import queries
    cases = {1: (ZLIB, "Zlib"), 2: (LGPL, "LGPL-2.1-or-later"),
             3: ("// SPDX-License-Identifier: LGPL-3.0-only\nint x;", "LGPL-3.0-only"),
             4: ("# SPDX-License-Identifier: MIT\n", "MIT"), 5: ("The MIT people.\nMIT\n", ""),
             6: ("GNU LESSER GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\nCopyright", "LGPL-3.0-only"),
             7: ("   Apache License\n  Version 2.0, January 2004\n http://www.apache.org/licenses/\n\n TERMS AND "
                 "CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n", "Apache-2.0"),
             8: ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
             9: ("SPDX-License-Identifier: MIT OR Apache-2.0", "")}
    docs_frame(spark, [(k, t, "s") for k, (t, _) in cases.items()]).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op6_license_rules"](spark, str(tmp_path))
    assert {r.doc_id: r.licenses for r in got.collect()} == {k: want for k, (_, want) in cases.items()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    told = con.sql(queries.ORACLE["op6_license_rules"])
    assert sorted(tuple(r) for r in got.select(*told.columns).collect()) == sorted(told.fetchall())


def test_known_sentences_are_distinct_and_rules_name_them():
    told = [license_rules.normalise(s) for s in license_rules.SENTENCES.values()]
    assert len(told) == len(set(told))
    assert {s for _, ids in license_rules.RULES for s in ids} == set(license_rules.SENTENCES)
