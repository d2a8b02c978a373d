"""Small cases and plain versions of the training-data operators.

Brute force, round trips and held-out accuracy where SQL can't express one.
"""
import collections
import itertools
import os
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aerostar.llm import (exact_dedup, license_rules, line_dedup, mixing, ngram_join, packing, passages, registry,
                          topk, toxicity, url_filter)
from aerostar.llm.components import components

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, TEXT2 string, size long, n long, h string"


def frame(spark, rows):
    """(doc_id, text[, source]) with extra columns whose names the operators use themselves."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 1, 2, "h") for r in rows]
    return spark.createDataFrame(full, DOC).withColumnRenamed("TEXT2", "Text")


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b c"), (6, "a  b\tc"), (None, "a b c"),
       (7, "w " * 30000), (7, "w " * 30000), (8, "ünï 漢字 x" * 9), (9, None, None)]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = registry.queries()[name](spark, SMALL)
    cols = sorted(got.columns)
    rows = sorted(map(repr, map(tuple, got.select(*cols).collect())))
    want = sorted(map(repr, con.sql(f"SELECT {', '.join(cols)} FROM ({registry.oracle_sql()[name]})").fetchall()))
    assert rows == want


def test_odd_rows_and_empty_tables_pass_every_document_operator(spark):
    labels = spark.createDataFrame([(4, 1), (8, 0), (None, 1)], "doc_id long, toxic int")
    runs = [packing.pack, lambda d: toxicity.score(d, labels), license_rules.scan_licenses, mixing.copies,
            line_dedup.dedup_lines, ngram_join.near_components, exact_dedup.exact_classes]
    for run in runs:
        assert run(frame(spark, ODD)).count() == len(ODD)
        assert run(frame(spark, [])).count() == 0
    assert passages.repeated_passages(frame(spark, [])).count() == 0
    passages.repeated_passages(frame(spark, ODD)).count()


def test_packing_bounds_are_optimal():
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = np.unique(rng.integers(0, 40, 9))
        counts = rng.integers(1, 9, len(lengths))
        k = int(rng.integers(1, 5))

        def padded(ends):
            return sum(c * min(e for e in ends if e >= x) for x, c in zip(lengths, counts))

        best = min(padded((*c, lengths[-1])) for n in range(min(k, len(lengths)))
                   for c in itertools.combinations(lengths[:-1], n))
        got = packing.best_bounds(lengths, counts, k)
        assert len(got) <= k and padded(got) == best


def test_packing_batches_keep_the_budget(spark):
    rows = packing.pack(spark.read.parquet(f"{SMALL}/documents.parquet"), 4, 2000).collect()
    groups = collections.defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.padded_len
        groups[r.bucket, r.batch].append(r)
    for (bucket, batch), g in groups.items():
        assert sorted(r.slot for r in g) == list(range(len(g)))
        assert len(g) * g[0].padded_len <= 2000 or len(g) == 1
        if (bucket, batch + 1) in groups:
            assert len(g) == max(1, 2000 // max(1, g[0].padded_len))


def test_nnpu_separates_and_corrects_for_the_prior():
    rng = np.random.default_rng(2)
    n_pos, n_un, prior = 200, 800, 0.2
    hidden = rng.random(n_un) < prior
    toxic = np.concatenate([np.ones(n_pos, bool), hidden])
    bits = np.where(toxic[:, None], rng.random((n_pos + n_un, 12)) < 0.7, rng.random((n_pos + n_un, 12)) < 0.1)
    rows, cols = np.nonzero(bits)
    w, b = toxicity.train_nnpu(rows, cols, n_pos, n_pos + n_un, 12, prior)
    guess = bits[n_pos:] @ w + b > 0
    assert (guess == hidden).mean() > 0.95


def test_toxicity_ignores_labels_of_held_out_rows(spark):
    docs = frame(spark, [(i, ("vile rot " if i % 5 == 0 else "calm day ") + f"w{i % 7} w{i % 11}") for i in range(400)])
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    b = {r.doc_id: r for r in toxicity.score(docs, turned).collect()}
    assert all(a[i].score == b[i].score for i in a)
    assert all(r.predicted == (i % 5 == 0) for i, r in a.items() if r.held_out)
    assert {r.doc_id for r in toxicity.without_toxic(docs, labels).collect()} == {i for i in a if not a[i].predicted}


def test_license_sentences_hold_a_clue_and_full_texts_match(spark):
    for wordings in license_rules.SENTENCES.values():
        for w in wordings:
            assert re.search(license_rules.CLUES.replace("(?i)", ""), w, re.I) or "cc" in w or w.startswith(
                ("you may", "see the", "this program")), w
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and "
           "associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including "
           "without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n"
           "copies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the "
           "following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\n"
           "copies or substantial portions of the Software.\n")
    rows = {r.doc_id: r for r in license_rules.scan_licenses(frame(spark, [
        (1, "Prose.\n" + mit), (2, "Licensed under the Apache License, Version 2.0.\nAll rights reserved."),
        (3, "All rights reserved."), (4, "A licence of some kind."),
        (5, "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: nothing.")])).collect()}
    assert rows[1].licenses == "MIT" and rows[1].n_left == 0
    assert rows[2].licenses == "All-Rights-Reserved,Apache-2.0"
    assert (rows[3].verdict, rows[4].verdict, rows[5].verdict) == ("reserved", "none", "unknown")


GPL = """This program is free software%s you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation%s either version %d of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""


def test_license_headers_and_tags_as_they_are_written(spark):
    headers = [(GPL % (":", ",", 3), "GPL-3.0-or-later"), (GPL % (";", ";", 2), "GPL-2.0-or-later"),
               (GPL % (";", ",", 2), "GPL-2.0-or-later"), (GPL % (":", ";", 3), "GPL-3.0-or-later"),
               (MPL, "MPL-2.0"), (APACHE, "Apache-2.0")]
    tags = [(f"{a}SPDX-License-Identifier:{gap}{tag}{b}", name) for a, b in (("// ", "\nint x;"), ("/* ", " */\n"), ("", ""))
            for gap in (" ", "") for tag, name in (
                ("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("GPL-3.0-only", "GPL-3.0"), ("GPL-3.0", "GPL-3.0"),
                ("GPL-3.0-or-later", "GPL-3.0"), ("BSD-3-Clause", "BSD-3-Clause"))]
    cases = headers + tags
    rows = {r.doc_id: r for r in license_rules.scan_licenses(frame(spark, [(i, t) for i, (t, _) in enumerate(cases)])).collect()}
    assert [rows[i].licenses for i in range(len(cases))] == [name for _, name in cases]
    assert all(r.verdict == "licensed" and r.n_left == 0 for r in rows.values())


def test_mix_is_near_its_targets_and_within_three_copies(spark):
    docs = frame(spark, [(i, "w " * (1 + i * i % 97), "abc"[min(i % 9, 2)]) for i in range(3000)]
                 + [(9000, "w", None), (9001, None, "z")])
    rows = mixing.copies(docs).collect()
    assert len(rows) == 3002 and all(0 <= r.copies <= 3 for r in rows)
    total = sum(r["size"] for r in rows)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    assert abs(sum(g[0].target for g in by.values()) - total) < 1e-6 * total
    for g in by.values():
        assert g[0].target <= 3 * g[0].source_size
        assert abs(sum(r.copies * r["size"] for r in g) - g[0].target) <= max(100, 0.01 * g[0].target)
    again = {(r.doc_id, r.copies) for r in mixing.copies(docs).collect()}
    assert again == {(r.doc_id, r.copies) for r in rows}
    assert mixing.mixed(docs).count() == sum(r.copies for r in rows)
    assert mixing.mixed(docs).columns == docs.columns


def test_line_dedup_finds_every_repeated_run(spark):
    rng = np.random.default_rng(3)
    texts = ["\n".join(f"line {x}" for x in rng.integers(0, 6, rng.integers(0, 14))) for _ in range(80)]
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(frame(spark, list(enumerate(texts)))).collect()}
    seen3, seen2 = set(), set()
    for i, t in enumerate(texts):
        lines = [x for x in t.split("\n") if x]
        must, may = set(), set()
        for j in range(len(lines)):
            for n, seen, out in ((3, seen3, must), (2, seen2, may)):
                if j + n <= len(lines):
                    if tuple(lines[j:j + n]) in seen:
                        out.update(range(j, j + n))
                    seen.add(tuple(lines[j:j + n]))
        kept = [x for x in rows[i].text.split("\n") if x]
        assert len(lines) - len(may) <= len(kept) <= len(lines) - len(must)
        assert rows[i].n_lines == len(lines) and rows[i].n_removed == len(lines) - len(kept)


def test_pipeline_line_dedup_takes_long_runs_of_one_or_two_lines(spark):
    rng = np.random.default_rng(12)
    line = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**9, n))
    one, a, b, short, c, d = line(60), line(25), line(30), line(49), line(20), line(20)
    rows = [(1, one), (2, "x\n" + a + "\n\n" + b), (3, short), (4, c + "\n" + d), (5, "y\n" + one), (6, one),
            (7, a + "\n" + b), (8, a + "\nz\n" + b + "\n" + short), (9, c + "\n" + d + "\nv"),
            (10, "p\n" + one + "\nq\n" + one), (None, one), (11, " " + one + "\t\nu")]
    docs = frame(spark, rows).withColumn("n_removed", F.lit(7)).withColumn("n_lines", F.lit("own"))
    out = dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, SMALL)
    assert out.columns == docs.columns
    kept = out.collect()
    assert {(r.n_removed, r.n_lines, r.Text) for r in kept} == {(7, "own", "x")}
    got = {r.doc_id: r.text for r in kept}
    assert {r.doc_id: r.n_chars for r in kept} == {i: len(t) for i, t in got.items()}
    want = dict(rows) | {5: "y", 10: "p\nq", 11: "u"}
    assert got == {i: t for i, t in want.items() if i not in (6, 7)}
    assert line_dedup.dedup_lines(frame(spark, rows)).filter("n_removed > 0").count() == 0


def test_url_rules_and_learned_verdicts(spark):
    urls = [f"http://h{i}.{d}/{p}/{i}" for i in range(60) for d, p in (
        ("example.net", "de"), ("EXAMPLE.net", "en"), ("x.org", "fr"), ("example.com", "de"), ("other.io", "q"))]
    odd = [None, "", "no scheme", "http://net", "http://net/", "http://a.net?x=1", "ftp://b.org/fr/?q#f", "://c.example.com/de/"]
    pages = spark.createDataFrame(list(enumerate([*urls, *odd])), "page_id long, url string")
    rows = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(rows) == len(urls) + len(odd)
    by = [(rows[len(urls) + i].host, rows[len(urls) + i].path, rows[len(urls) + i].rule) for i in range(len(odd))]
    assert by == [("", "", None)] * 3 + [("net", "", None), ("net", "/", "net/"), ("a.net", "", None),
                                         ("b.org", "/fr/", "org/fr/"), ("c.example.com", "/de/", "example.com/de/")]
    assert (rows[0].verdict, rows[1].verdict, rows[1].rule) == ("block", "allow", "example.net/en/")
    labelled = [r for r in rows.values() if r.rule]
    assert np.mean([(r.score >= 0.5) == (r.verdict == "block") for r in labelled]) > 0.9
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_top_k_handles_odd_vectors_and_ties(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=5) * (1 + i % 3)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 5), (303, []), (None, [1.0] * 5),
             (304, rows[7][1]), (305, rows[7][1]), (350, [1e200] * 5), (400, [float("inf")])]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in topk.top_k(data, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    ok = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    stop = lambda x: max(-2**63, min(2**63 - 1, x))
    for q in (i for i in ok if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q)[:5]
        if q != 350:
            assert got[q] == [(i, stop(-s)) for s, i in scores]
    assert len(got[350]) == 5


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (3, 2), (9, 8), (8, 7), (5, 9), (4, 4)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (7, 5), (8, 5), (9, 5)}


def test_every_linked_pair_shares_a_probing_key():
    rng = np.random.default_rng(5)
    for n in [5, 6, 7, 9, 12, 20, 31, 60, 150, 400]:
        for _ in range(40):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            t = int(rng.integers(0, ngram_join.most_apart(2 * len(a)) + 1))
            drop = int(rng.integers(0, t + 1))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, t - drop).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if not len(b) or 100 * both < 85 * len(np.union1d(a, b)) or np.array_equal(a, b):
                continue
            (x, nx), (y, ny) = ngram_join.signatures(a), ngram_join.signatures(b)
            assert set(x[:nx]) & set(y) or set(y[:ny]) & set(x)


def _components_by_hand(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = frozenset(zip(w, w[1:], w[2:], w[3:])) if len(w) > 3 else frozenset([tuple(w)] if w else [])
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        i = len(sets[a] & sets[b])
        if i and 100 * i >= 85 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def test_ngram_join_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rng = np.random.default_rng(6)
    base = [f"t{x}" for x in rng.integers(0, 9999, 120)]
    near = []
    for i in range(60):
        w = list(base)
        for j in rng.integers(0, 120, rng.integers(0, 6)):
            w[j] = f"z{i}{j}"
        near.append((10_000 + i, " ".join(w)))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + near
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_components(frame(spark, rows)).collect()}
    assert got == _components_by_hand(rows)


def test_ngram_join_links_every_text_of_a_repeated_id(spark):
    rng = np.random.default_rng(13)
    rows, want = [], {}
    for k in range(0, 40, 4):
        one, two = ([f"t{x}" for x in rng.integers(0, 10**9, 80)] for _ in range(2))
        near = [w[:40] + ["changed"] + w[41:] for w in (one, two)]
        rows += [(k, " ".join(one)), (k, " ".join(two)), (k, " ".join(two)), (k + 1, " ".join(near[0])), (k + 2, " ".join(near[1])),
                 (k + 3, " ".join(reversed(one)))]
        want |= {k: k, k + 1: k, k + 2: k, k + 3: k + 3}
    found = ngram_join.near_components(frame(spark, rows)).collect()
    assert len(found) == len(rows) and {r.doc_id: r.component_id for r in found} == want
    assert {r.doc_id for r in ngram_join.one_of_each(frame(spark, rows)).collect()} == {i for i, c in want.items() if i == c}


def test_ngram_join_makes_few_rows_of_pairs_that_do_not_link(spark, monkeypatch):
    rng = np.random.default_rng(17)
    base = [f"t{x}" for x in rng.integers(0, 10**9, 1200)]
    rows = []
    for i in range(24):
        w = list(base)
        for j in rng.choice(1200, 30, replace=False):
            w[j] = f"z{i}x{j}"
        rows.append((i, " ".join(w)))
    w = rows[5][1].split()
    rows.append((99, " ".join(w[:300] + ["changed"] + w[301:])))
    made, links = [], ngram_join._links
    monkeypatch.setattr(ngram_join, "_links", lambda pairs, *rest: made.append(pairs.count()) or links(pairs, *rest))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_components(frame(spark, rows)).collect()}
    assert got == _components_by_hand(rows) and got[99][1] == 5
    assert sum(made) < 100


def test_ngram_join_keeps_one_of_the_keys_with_the_same_members(spark):
    members = spark.createDataFrame(
        [(k, n, n == 1) for k in (10, 11, 12) for n in (1, 2, 3)] + [(13, 1, True), (13, 2, False), (14, 1, True), (14, 2, True),
                                                                     (15, 5, True), (15, 6, True)], "key long, node long, probe boolean")
    labels = spark.createDataFrame([(5, 5), (6, 5)], "node long, root long")
    left = ngram_join._open(members, labels)
    assert {(r.key, r.node, r.probe, r.root) for r in left.collect()} == {
        (10, 1, True, 1), (10, 2, False, 2), (10, 3, False, 3), (13, 1, True, 1), (13, 2, False, 2), (14, 1, True, 1), (14, 2, True, 2)}


def test_pipeline_near_duplicates_by_five_words_at_080(spark):
    rng = np.random.default_rng(11)
    rows = []
    for k in range(120):
        w = [f"t{x}" for x in rng.integers(0, 10**9, int(rng.integers(60, 260)) if k % 2 else 150)]
        near = list(w)
        # Of 150 words, three changes leave 131/161 of the five-word shingles and 135/159 of the four-word ones.
        for at in (rng.integers(0, len(w), rng.integers(1, 8)) if k % 2 else (30, 70, 110)):
            near[at] = f"z{k}"
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(near))]
    grams = {d: {tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for d, t in rows}
    gone = {d + 1 for d in grams if d % 2 == 0
            and 100 * len(grams[d] & grams[d + 1]) >= 80 * len(grams[d] | grams[d + 1])}
    assert 60 < len(gone) < 120
    got = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, frame(spark, rows), SMALL)
    assert {r.doc_id for r in got.collect()} == set(grams) - gone


def test_passages_are_found_and_clean_documents_left_alone(spark):
    rng = np.random.default_rng(7)
    text = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    shared = text(60)
    fuzzy = list(shared)
    fuzzy[20], fuzzy[41] = "changed", "too"
    rows = [(1, text(80) + shared + text(30)), (2, text(200)), (3, text(10) + shared + text(5)),
            (4, text(50) + fuzzy), (5, text(40) + shared[:30])]
    got = passages.repeated_passages(frame(spark, [(i, " ".join(w)) for i, w in rows])).collect()
    assert {(r.doc_id, r.source_id, r.start, r.end) for r in got} == {(3, 1, 10, 70), (4, 1, 50, 110)}
    assert {r.matched for r in got} == {60, 58}


def test_passages_of_every_text_of_a_repeated_id(spark):
    rng = np.random.default_rng(14)
    text = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    a, b = text(80), text(90)
    first, second, third = text(30) + a, text(5) + a + text(9), text(20) + b
    rows = [(1, " ".join(first)), (2, " ".join(text(100))), (2, " ".join(second)), (2, " ".join(second)), (3, " ".join(text(60))),
            (3, " ".join(third)), (4, " ".join(text(7) + b))]
    docs = frame(spark, rows)
    got = passages.repeated_passages(docs)
    assert {(r.doc_id, r.start, r.end, r.source_id, tuple(r.source_ids)) for r in got.collect()} == {
        (2, 5, 85, 1, (1,)), (4, 7, 97, 3, (3,))}
    cut = collections.Counter((r.doc_id, r.text) for r in passages.cut_passages(docs, got).collect())
    want = collections.Counter(rows)
    want = collections.Counter({(i, " ".join(second[:5] + second[85:]) if t == " ".join(second) else
                                 " ".join(t.split()[:7]) if i == 4 else t): n for (i, t), n in want.items()})
    assert cut == want


def test_chains_of_a_batch_are_those_of_its_groups():
    import pyarrow as pa
    rng = np.random.default_rng(15)
    docs = [[{"source_id": int(rng.integers(0, 4)), "x": int(rng.integers(0, 90)), "y": int(rng.integers(0, 90))}
             for _ in range(rng.integers(0, 30))] if k % 3 else
            [{"source_id": 1, "x": 5 * j, "y": 7 * j + 2} for j in range(k)] for k in range(40)]
    kind = pa.list_(pa.struct([("source_id", pa.int64()), ("x", pa.int32()), ("y", pa.int32())]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(100, 140), pa.int64()), pa.array(docs, kind)], names=["doc_id", "hits"])
    want = []
    for i, hits in enumerate(docs):
        for s in {h["source_id"] for h in hits}:
            at = sorted((h["x"], h["y"]) for h in hits if h["source_id"] == s)
            xs, ys = (np.array(v) for v in zip(*at))
            want += [(100 + i, xs[p].tolist(), ys[p].tolist(), s) for p in map(np.array, passages.chain(xs, ys))]
    for some in (batch, batch.slice(7, 20)):
        got = [tuple(r.values()) for out in passages._chains([some]) for r in out.to_pylist()]
        assert sorted(got) == sorted(w for w in want if w[0] in some.column(0).to_pylist())


def _planted(rng, n, kept):
    """(words, the same with words changed inside, both ends unchanged)."""
    clean = [f"w{x}" for x in rng.integers(0, 10**9, n)]
    fuzzy = list(clean)
    for at in rng.choice(np.arange(1, n - 1), n - int(np.ceil(n * kept)), replace=False):
        fuzzy[at] = f"z{rng.integers(0, 10**9)}"
    return clean, fuzzy


def test_fuzzy_passages_that_share_a_seed_are_found(spark):
    rng = np.random.default_rng(8)
    rows, planted = [], {}
    text = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    for k in range(400):
        clean, fuzzy = _planted(rng, int(rng.integers(50, 101)), rng.uniform(0.8, 0.95))
        if k % 8 == 0:  # three changes near each end
            clean = text(60)
            fuzzy = list(clean)
            for at in (4, 9, 14, 45, 50, 55):
                fuzzy[at] = f"z{k}"
        a, b = text(40) + clean + text(40), text(30) + fuzzy + text(30)
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
        seeds = [passages.seeds_of(passages.direct_hashes([x.encode() for x in w]))[0] for w in (a, b)]
        if len(np.intersect1d(*seeds)):
            planted[2 * k + 1] = (30, 30 + len(fuzzy))
    assert len(planted) > 300
    got = collections.defaultdict(set)
    for r in passages.repeated_passages(frame(spark, rows)).collect():
        assert r.doc_id % 2 == 1 and r.source_id == r.doc_id - 1
        got[r.doc_id].update(range(r.start, r.end))
    covered = [len(got[d] & set(range(lo, hi))) / (hi - lo) for d, (lo, hi) in planted.items()]
    assert np.mean([c > 0 for c in covered]) > 0.97 and np.mean(covered) > 0.95


def test_every_window_that_occurred_before_is_covered(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: passages.words(r.text) for r in docs.collect()}
    seen, must, n = set(), collections.defaultdict(set), passages.MIN_WORDS
    for d in sorted(texts):
        for i in range(len(texts[d]) - n + 1):
            window = tuple(texts[d][i:i + n])
            if window in seen:
                must[d].update(range(i, i + n))
            seen.add(window)
    got = collections.defaultdict(set)
    for r in passages.repeated_passages(docs).collect():
        got[r.doc_id].update(range(r.start, r.end))
        assert r.end - r.start >= n and r.matched >= passages.IDENTITY * (r.end - r.start)
    assert must and all(must[d] <= got[d] for d in must)


def test_exact_passage_beside_a_sparsely_shared_region_is_found(spark):
    rng = np.random.default_rng(9)
    text = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    rows, places = [], {}
    for k in range(60):
        a, b = text(60), text(0)
        b += a
        for _ in range(1 + k % 6):  # a form: 12 changed words, 12 fixed ones
            fixed = text(12)
            a, b = a + text(12) + fixed, b + text(12) + fixed
        if k % 2:
            a, b = a[::-1], b[::-1]
        rows += [(2 * k, " ".join(text(20) + a + text(20))), (2 * k + 1, " ".join(text(30) + b + text(30)))]
        places[2 * k + 1] = (30 + len(b) - 60, 30 + len(b)) if k % 2 else (30, 90)
    got = collections.defaultdict(set)
    for r in passages.repeated_passages(frame(spark, rows)).collect():
        assert r.end - r.start >= passages.MIN_WORDS and r.matched >= passages.IDENTITY * (r.end - r.start)
        got[r.doc_id].update(range(r.start, r.end))
    assert all(set(range(lo, hi)) <= got[d] for d, (lo, hi) in places.items())


def test_longest_stretches_that_agree():
    rng = np.random.default_rng(10)
    for _ in range(300):
        same = (rng.random(rng.integers(0, 40)) < 0.7).astype(np.int64)
        size = np.ones_like(same)
        good = [(i, j) for i in range(len(same)) for j in range(i + 6, len(same) + 1)
                if same[i] and same[j - 1] and 10 * same[i:j].sum() >= 8 * (j - i)]
        got = passages.stretches(same, size, 6)
        assert set(got) <= set(good) and all(b <= c for (_, b), (c, _) in zip(got, got[1:]))
        assert bool(got) == bool(good)


def test_chain_prefers_the_collinear_anchors():
    xs, ys = np.array([0, 6, 12, 13, 18]), np.array([100, 106, 7, 112, 118])
    assert sorted(len(p) for p in passages.chain(xs, ys)) == [1, 4]


def test_exact_dedup_divides_colliding_groups(spark):
    docs = frame(spark, [(i, f"text  {i % 5}") for i in range(40)])
    whole = {tuple(r) for r in exact_dedup.exact_classes(docs).collect()}
    clash = exact_dedup.exact_classes(docs, lambda t: F.unhex(F.substring(F.md5(t.cast("binary")), 1, 2)).substr(1, 0))
    assert {tuple(r) for r in clash.collect()} == whole
    assert {(r[1], r[2]) for r in whole} == {(k, 8) for k in range(5)}


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "source_mix", "packing"]
    columns, step = docs.columns, dict(corpus_pipeline.STAGES)
    near = step["near_duplicates"](spark, docs, SMALL)
    want = _components_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert near.columns == columns
    assert {r.doc_id for r in near.collect()} == {d for d, (_, c) in want.items() if c == d}
    lines = step["line_dedup"](spark, docs, SMALL)
    assert lines.columns == columns and lines.count() < docs.count()
    out = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "n_tokens", "batch"} <= set(out.columns) and out.count() > 0
    assert os.path.exists(corpus_pipeline.__file__)
