"""The training-data operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import itertools
import json
import math
import os
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import chat, components, decontamination, licenses, line_dedup, lm_scoring, media, mixing, near_dedup, quality, registry, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LINE = "This line is long enough to be counted as a repeated one."


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, and a column that clashes with internal names."""
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, None, "en", None, 0), (3, "word", "en", "a", 4), (3, "word", "en", "a", 4), (4, "x " * 30000, "de", "b", 60000), (5, " \n\t\n ", None, "b", 5), (None, "lost words here", "en", "c", 15), (6, "ÀÉ \U0001f600 ß", "fr", "", 6)]
    return spark.createDataFrame(rows, DOCS).withColumn("id", F.lit("clash")).withColumn("band", F.lit(1)).withColumn("size", F.lit(None).cast("string"))


def norm(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("name", registry.ORACLES)
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = registry.QUERIES[name](spark, SF).toPandas(), con.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    clean = lambda f: norm(f[columns].astype(object).where(f[columns].notna(), None).itertuples(index=False, name=None))
    assert clean(got) == clean(want)


# -- lines -------------------------------------------------------------------------------------------------------------


def drop_lines(rows, min_docs=5, min_chars=40):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(-1 if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == (-1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_line_dedup(spark, batches):
    rng = random.Random(1)
    lines = [LINE, LINE.upper() + " \t", "  " + LINE, "short", "", "Another line that is also longer than forty characters, é."]
    rows = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 6)))) for k in range(40)] + [(None, LINE), (7, LINE), (39, LINE + "\n" + LINE)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_lines", F.lit("clash")), batches=batches)
    assert norm((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()) == norm(drop_lines(rows))


def test_line_dedup_odd(spark):
    got = line_dedup.dedup_lines(odd_documents(spark)).collect()
    assert len(got) == 9 and {(r.n_lines, r.n_dropped) for r in got if r.doc_id == 2} == {(1, 0)} and got[0].id == "clash"
    assert line_dedup.dedup_lines(odd_documents(spark).limit(0)).count() == 0


def test_line_dedup_of_wide_ids(spark):
    wide = 2**63 - 1
    rows = [(i, f"{LINE}\nown {i}") for i in (-wide, -wide + 1, -5, 0, 3, wide - 1, wide)] + [(k, f"a line of forty characters and more {k % 2}") for k in range(10, 30)]
    for batches in (1, 4):
        got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), batches=batches)
        assert norm((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()) == norm(drop_lines(rows))


# -- licences ----------------------------------------------------------------------------------------------------------


def scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    base = [(i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    flat, hits = "".join(" " + w for w in words), []
    for k, rule in enumerate(licenses.default_rules()):
        for m in re.finditer(f" (?:{rule.expression})(?= |\\Z)", flat):
            first = flat[: m.start()].count(" ")
            hits.append((first, first + m[0].count(" "), rule.priority, k, rule))
    kept = [h for h in hits if h[4].base or not any(g is not h and g[0] <= h[0] and g[1] >= h[1] and g[2] <= h[2] and (g[:3] != h[:3] or g[3] < h[3]) for g in hits)]
    return (len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted({h[4].label for h in kept})), max((h[4].confidence for h in hits), default=0.0))


def test_licenses(spark):
    assert len(licenses.default_rules()) > 200
    texts = ["Licensed under the MIT License.", "under the mit license under the mit license", "Apache License, Version 2.0; see the Apache License version 2.0 for details", "CC-BY-NC 4.0 and cc by nc", "SPDX-License-Identifier: GPL-3.0-or-later", "Released under the terms of the Mozilla Public License 2.0. All rights reserved.", "mitt license", "", "no", "ÉMIT license", "under the mit license\u0085", "under the mit license\u2028", "under the mit license\u2029 x", "apache license version 2\n", "submit permit limit license", "miscellaneous license"] * 2
    rows = [(k, t) for k, t in enumerate(texts)] + [tuple(r) for r in documents(spark).select("doc_id", "text").collect()]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_norm", F.lit(1))
    got = {}
    for r in licenses.scan(frame).collect():
        base = [d for d in r.detections if d.base]
        got.setdefault(r.doc_id, []).append((r.n_words, len(base), min((d.first for d in base), default=None), max((d.first for d in base), default=None), ",".join(sorted({d.label for d in base})), ",".join(sorted({d.label for d in r.detections})), max((d.confidence for d in r.detections), default=0.0)))
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(scan(t))
    assert {k: norm(v) for k, v in got.items()} == {k: norm(v) for k, v in want.items()}


def wordings(expression):
    """All texts that an expression of groups, alternatives, classes and bounded repeats matches; of a class of more than
    three characters only the first."""

    def every(nodes):
        out = [""]
        for op, value in nodes:
            kind = str(op)
            if kind == "LITERAL":
                some = [chr(value)]
            elif kind == "IN":
                some = [chr(c) for k, v in value for c in ([v] if str(k) == "LITERAL" else range(v[0], min(v[1], v[0]) + 1))]
            elif kind == "SUBPATTERN":
                some = every(value[3])
            elif kind == "BRANCH":
                some = [x for branch in value[1] for x in every(branch)]
            elif kind == "MAX_REPEAT":
                each = every(value[2])
                some = [x for n in range(value[0], value[1] + 1) for x in map("".join, itertools.product(each, repeat=n))]
            else:
                raise ValueError(kind)
            out = [a + b for a in out for b in some]
        return out

    return every(re._parser.parse(expression))


def test_keywords_are_in_all_that_rules_match():
    missing = {(r.keyword, r.expression) for r in licenses.default_rules() if not all(re.fullmatch(r.expression, x) and f" {r.keyword} " in f" {x} " for x in wordings(r.expression))}
    assert missing == set()


def test_base_phrases_end_with_their_words(spark):
    texts = ["under the mit license" + c for c in ("\u0085", "\u2028", "\u2029", "\n", "\r\n", ".", "")]
    got = {r.doc_id: sum(d.base for d in r.detections) for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: 1}
    rules = tuple(licenses.Rule(w, w, w, k, 0.5) for k, w in enumerate("abcdef"))
    found = licenses.scan(spark.createDataFrame([(1, "f e d c b a")], "doc_id bigint, text string"), rules).first()
    assert [d.priority for d in found.detections] == [5, 4, 3, 2, 1, 0]


def test_license_tags_alone(spark):
    texts = [(k, f"SPDX-License-Identifier: {wordings(spdx)[0]}", label) for k, (label, _, _, spdx) in enumerate(licenses.NAMES)]
    got = {r.doc_id: {d.label for d in r.detections} for r in licenses.scan(spark.createDataFrame(texts, "doc_id bigint, text string, label string")).collect()}
    assert all(label in got[k] for k, _, label in texts)


def test_licenses_odd(spark):
    got = licenses.scan(odd_documents(spark)).collect()
    assert len(got) == 9 and all(r.detections == [] for r in got)
    assert licenses.scan(odd_documents(spark).limit(0)).count() == 0


# -- quality -----------------------------------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels)).join(labels.select("doc_id", "quality"), "doc_id").where(quality.held_out(F.col("doc_id")))
    right = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")), F.avg(F.when(F.col("quality") == 1, F.col("predicted")))).first()
    assert right[0] > 0.97 and right[1] > 0.98


def test_quality_odd(spark):
    labels = spark.createDataFrame([(3, 1), (4, 0), (None, 1), (5, None), (3, 1)], "doc_id bigint, quality int")
    docs = odd_documents(spark).withColumn("score", F.lit("clash"))
    for model in (quality.train(docs, labels), quality.train(docs, labels.limit(0)), quality.RuleModel(0.0, ())):
        got = quality.score(docs, model).collect()
        assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)


def test_lasso_learns_a_conjunction_sparsely():
    rng = np.random.default_rng(0)
    draw = lambda n: rng.random((n, len(quality.STATISTICS)))
    truth = lambda x: ((x[:, 3] > 0.5) & (x[:, 5] <= 0.7)).astype(int)
    x, fresh = draw(3000), draw(3000)
    model, sparse = quality.fit_rules(x, truth(x)), quality.fit_rules(x, truth(x), penalty=0.01)
    assert 0 < len(sparse.rules) < len(model.rules)
    for m in (model, sparse):
        column = {k: fresh[:, j] for j, k in enumerate(quality.STATISTICS)}
        total = m.bias + sum(r.weight * np.all([(column[n] > b) == above for n, above, b in r.tests], axis=0) for r in m.rules)
        assert ((total > 0) == truth(fresh)).mean() > 0.97


def test_compiled_score_is_the_models(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    assert model.rules
    rows = quality.with_statistics(docs.select("doc_id", "text")).withColumn("p", model.score()).select("doc_id", "p", "_s.*").collect()
    for r in rows:
        total = model.bias + sum(rule.weight for rule in model.rules if all((r[name] > bound) == above for name, above, bound in rule.tests))
        assert r.p == pytest.approx(1 / (1 + math.exp(-total)))


# -- near copies -------------------------------------------------------------------------------------------------------


def groups(rows, width, percent=80):
    sets, parent = {}, {}
    for i, t in rows:
        w = [x for x in re.split("[ \t\n\x0b\f\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if x]
        sets.setdefault(i, []).append(frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else []))
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if i is not None)
    for a in ids:
        for b in ids:
            if a < b and any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]) and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("width", [2, 5])
def test_near_copies(spark, width):
    rng = random.Random(width)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(base if rng.random() < 0.3 else [w if rng.random() > 0.05 else f"n{rng.random()}" for w in base])) for k in range(60)]
    rows += [(100 + k, " ".join(f"u{rng.random()}" for _ in range(40))) for k in range(20)] + [(200, ""), (201, None), (202, "One Two"), (203, "one  two"), (204, "two"), (204, "one\ttwo")]
    got = {}
    for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("band", F.lit(1)), width=width).collect():
        got.setdefault(r.doc_id, set()).add(r.component_id)
        assert r.kept == (r.doc_id == r.component_id)
    assert got == {k: {v} for k, v in groups(rows, width).items()}


@pytest.mark.parametrize("width", [2, 5])
def test_near_copies_of_the_table_against_all_pairs(spark, width):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    sets = {}
    for i, t in rows:
        w = [x for x in re.split("[ \t\n\x0b\f\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if x]
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    number = {s: k for k, s in enumerate({s for held in sets.values() for s in held})}
    ids = sorted(sets)
    bits = {i: sum(1 << number[s] for s in sets[i]) for i in ids}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and small * 100 >= large * 80 and find(a) != find(b):
                both = (bits[a] & bits[b]).bit_count()
                if both * 100 >= (small + large - both) * 80:
                    parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, width=width).collect()}
    assert got == {i: find(i) for i in ids}


def test_near_copies_odd(spark):
    got = near_dedup.near_duplicates(odd_documents(spark)).collect()
    assert len(got) == 9 and all(r.component_id == r.doc_id and r.kept for r in got)
    assert near_dedup.near_duplicates(odd_documents(spark).limit(0)).count() == 0


def test_bitmaps_never_drop_a_link():
    rng = np.random.default_rng(2)
    for n in (1, 3, 15, 16, 17, 64, 300):
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            b = np.unique(np.concatenate([a[: int(len(a) * 0.9) + 1], rng.integers(0, 1 << 63, n // 10 + 1).astype(np.uint64)]))
            x, y = near_dedup._bits(a).view(np.uint64), near_dedup._bits(b).view(np.uint64)
            while len(x) != len(y):
                x, y = (x[: len(x) // 2] | x[len(x) // 2 :], y) if len(x) > len(y) else (x, y[: len(y) // 2] | y[len(y) // 2 :])
            count = lambda v: int(np.unpackbits(v.view(np.uint8)).sum())
            assert np.intersect1d(a, b).size <= count(x & y) + min(len(a) - count(x), len(b) - count(y))


def test_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(50)] + [(1000, 1000 + k) for k in range(1, 200)] + [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(80)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if find(a) != find(b):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert components.connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# -- benchmark leaks ---------------------------------------------------------------------------------------------------


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def test_lcs():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert decontamination.lcs_length(a, b) == lcs(a, b)


def test_leaks(spark):
    rng = random.Random(4)
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(150).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [(k, t) for k, t in enumerate(docs) if not any(x in t for _, x in items)]
    planted = []
    for k, (item, t) in enumerate(items):
        words = t.split()
        if k % 3 == 1:  # a word in twelve is another one
            words = [w if j % 12 else "zzz" for j, w in enumerate(words)]
        if k % 3 == 2:
            words = [w.upper() + "," for w in words]
        planted.append((1000 + item, f"{rng.choice(docs)[:900]}\n{' '.join(words)}\n{rng.choice(docs)[:500]}"))
    frame = spark.createDataFrame([*clean, *planted, (None, items[0][1]), (9999, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([*items, (None, "x"), (777, None), (778, "too short")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(frame, bench).collect()}
    assert {(1000 + item, item) for item, _ in items} <= got
    assert {d for d, _ in got if d is not None and d < 1000} == set()
    kept = decontamination.decontaminate(frame, bench)
    assert {r.doc_id for r in kept.collect()} >= {k for k, _ in clean} and kept.where("doc_id >= 1000 AND doc_id < 9999 OR doc_id IS NULL").count() == 0
    assert decontamination.contaminated(frame, bench.limit(0)).count() == 0
    assert decontamination.contaminated(frame.limit(0), bench).count() == 0


@pytest.mark.parametrize("every", [10**6, 6])
def test_leaks_of_a_large_benchmark(spark, every):
    """Spans of documents as a benchmark of far more items than the rank, planted as they are or with words replaced:
    what is found is what the LCS of every window finds."""
    rng = random.Random(8)
    frame = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").where("doc_id < 4000")
    docs = [r.text.split() for r in frame.orderBy("doc_id").collect() if r.text and len(r.text.split()) > 120]
    items = []
    for k in range(1000):
        words = docs[k % len(docs)]
        low = rng.randrange(len(words) - 40)
        items.append((k, " ".join(words[low : low + 40])))
    planted = []
    for k in range(0, 1000, 3):
        host = docs[rng.randrange(len(docs))][:60]
        planted.append((k, " ".join([*host[:30], *(w if j % every != 3 else f"zz{rng.random()}" for j, w in enumerate(items[k][1].split())), *host[30:]])))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    (index,) = decontamination.build_indexes(frame, bench)
    cell, answer_of = decontamination.CELL_WORDS, {p.item_id: p for p in index.passages}
    want = set()
    for k, text in planted:
        words = decontamination._word_list(text)
        for p in answer_of.values():
            if len(set(words) & set(p.words)) < 0.5 * len(set(p.words)):
                continue
            for low in range(0, len(words), cell):
                region = words[max(0, low - cell) : low + 5 * cell]
                share = decontamination.lcs_length(p.words, region) / len(p.words)
                if share >= 0.8 or share >= 0.7 and decontamination.lcs_length(p.answer, region) >= 0.8 * len(p.answer):
                    want.add((k, p.item_id))
    got = {(k, item) for (k, _), hits in zip(planted, index.search([t.encode() for _, t in planted])) for item in hits}
    assert len(want) >= len(planted)
    assert want == got


def test_leaks_of_short_items_and_scripts_without_spaces(spark):
    items = [(1, "Why is grass green?"), (2, "为什么天空是蓝色的？请说明主要的原因。"), (3, "水的沸点"), (4, "ทำไมท้องฟ้าจึงเป็นสีฟ้า"), (5, "Zyzzyva"), (6, "なぜ、空は青いのですか。"), (7, "?!"), (8, "two words")]
    rows = [
        (10, "He asked: why is GRASS green, and left."), (20, "她问道，为什么天空是蓝色的？请说明主要的原因。谢谢你们大家。"), (21, "她问道，为什么天空是蓝色的？请告诉主要的原因。谢谢你们大家。"), (30, "请问水的沸点是多少"), (40, "เขาถามว่าทำไมท้องฟ้าจึงเป็นสีฟ้าครับ"), (50, "a zyzzyva"),
        (60, "彼は「なぜ空は青いのですか」と聞いた"), (None, "two  words"), (90, "why is green grass; two"), (91, "words 点沸的水"), (92, "是蓝的 天空"), (93, "two other words"), (94, ""), (95, None),
    ]
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()}
    assert got == {(10, 1), (20, 2), (21, 2), (30, 3), (40, 4), (50, 5), (60, 6), (None, 8)}
    assert {r.doc_id for r in decontamination.decontaminate(docs, bench).collect()} == {90, 91, 92, 93, 94, 95}
    assert {(r.doc_id, r.lcs, r.answer) for r in decontamination.contaminated(docs, bench.where("item_id = 1").withColumn("answer", F.lit("left"))).collect()} == {(10, 1.0, 1.0)}


# -- WARC --------------------------------------------------------------------------------------------------------------


def test_warc_round_trip_odd(spark, tmp_path):
    big = "é" * 600
    rows = [(1, "http://a/\nb", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (None, "u", big), (5, "u", None), (2, "v", big), (6, "u", "WARC/1.1\r\nfake: 1\r\n\r\n")]
    warc.write_warc(spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1)), str(tmp_path / "w"))
    got = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert all(r.gap_reason is None for r in got) and len(got) == 8
    kinds = Counter((r.record_id, r.warc_type, r.refers_to) for r in got)
    assert kinds[("<urn:page:2>", "response", None)] == 2 and kinds[("<urn:page:1>", "revisit", "<urn:page:2>")] == 1 and kinds[("<urn:page:none>", "revisit", "<urn:page:2>")] == 1
    assert all(r.payload_digest == hashlib.sha1(big.encode()).hexdigest() and r.payload_bytes == 1200 for r in got if r.record_id in ("<urn:page:1>", "<urn:page:2>"))
    warc.write_warc(spark.createDataFrame([], "page_id bigint, url string, html string"), str(tmp_path / "e"))
    assert warc.read_warc(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    rng = random.Random(6)
    records = [warc.record_bytes(k, "http://x/", rng.randbytes(rng.randint(0, 900)), None, revisit=False) for k in range(30)]
    parts = [warc.member(r) if packed else r for r in records]
    starts = np.cumsum([0, *map(len, parts)])
    damaged = bytearray(b"".join(parts))
    for k in (3, 4, 17):
        at = int(starts[k]) + 20
        damaged[at : at + 8] = b"\xff" * 8
    cut = bytes(damaged[: int(starts[29]) + 30])
    items = list(warc.salvage(cut))
    found = [i.headers["warc-record-id"] for i in items if i.reason is None]
    assert found == [f"<urn:page:{k}>" for k in range(29) if k not in (3, 4, 17)]
    gaps = [(i.offset, i.offset + i.length) for i in items if i.reason is not None]
    assert gaps == [(starts[3], starts[5]), (starts[17], starts[18]), (starts[29], len(cut))]
    assert list(warc.salvage(b"")) == [] and [i.reason for i in warc.salvage(b"junk")] == ["no record"]


def test_salvage_inside_members(spark, tmp_path):
    records = [warc.record_bytes(k, "http://x/", random.Random(k).randbytes(500), None, revisit=False) for k in range(30)]
    names = lambda items: [i.headers["warc-record-id"] for i in items if i.reason is None]
    page = lambda *ks: [f"<urn:page:{k}>" for k in ks]
    whole = bytearray(b"".join(records))
    at = len(b"".join(records[:7])) + 20
    whole[at : at + 6] = b"\xff" * 6
    for data in (bytes(whole), warc.member(bytes(whole))):
        items = list(warc.salvage(data))
        assert names(items) == page(*(k for k in range(30) if k != 7)) and sum(i.reason is not None for i in items) == 1
    good, last = warc.member(b"".join(records)), warc.member(records[3])
    broken = bytearray(good)
    broken[len(good) * 3 // 4] ^= 0x55
    for data in (bytes(broken) + last, good[: len(good) * 3 // 4] + last):
        items = list(warc.salvage(data))
        found = names(items)
        assert found[-1:] == page(3) and len(found) > 20 and found[:-1] == [x for x in page(*range(30)) if x in found[:-1]]
        assert sum(i.reason is not None for i in items) == 1
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc.gz").write_bytes(bytes(broken) + last)
    rows = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert sum(r.gap_reason is not None for r in rows) == 1 and len(rows) > 21


# -- language model ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("order", "block"), [(1, 10**6), (2, 300), (3, 10**6), (3, 300)])
def test_lm_scores(spark, order, block):
    rows = [tuple(r) for r in documents(spark).select("doc_id", "text").limit(60).collect()] + [(900, ""), (901, None), (None, "the the the"), (902, "the")]
    words = [re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for _, t in rows]
    count = Counter(tuple(w[k : k + n]) for w in words for n in range(1, order + 1) for k in range(len(w) - n + 1))
    total = sum(map(len, words))

    def score(w):
        out = 0.0
        for k in range(len(w)):
            for n in range(min(order, k + 1), 0, -1):
                c = count[tuple(w[k - n + 1 : k + 1])]
                if n == 1 or c >= 2:
                    out += math.log(c / (count[tuple(w[k - n + 1 : k])] if n > 1 else total))
                    break
                out += math.log(0.4)
        return out

    got = {(r.doc_id, r.n_words): r.log_prob for r in lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), order=order, block_tokens=block).collect()}
    want = {(i, len(w)): score(w) for (i, _), w in zip(rows, words)}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert lm_scoring.score_documents(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_lm_answers_grow_with_the_blocks_alone(spark, monkeypatch):
    """A packed row per block, order and slice, however many tasks have counted its n-grams."""
    stored, real = [], lm_scoring.materialise
    monkeypatch.setattr(lm_scoring, "materialise", lambda df, label, **k: stored.append((label, real(df, label, **k))) or stored[-1][1])
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        lm_scoring.score_documents(documents(spark).repartition(3, "doc_id"), block_tokens=2000)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    answers = [df.select("block").collect() for label, df in stored if label.startswith("lm-answers")]
    assert len(answers) == lm_scoring.ORDER * lm_scoring.SLICES and max(map(len, answers)) > 1
    assert all(len(rows) == len(set(rows)) for rows in answers)


def test_lm_shuffles_go_before_the_next(spark, monkeypatch):
    """When a slice begins, the rows of the one before are no longer on the disk."""
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        files = [x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x and os.path.exists(x)]
        return {x: os.path.getsize(x) for x in files}

    others, left, most, real = set(shuffled()), [], [], lm_scoring.materialise

    def size():
        return sum(n for x, n in shuffled().items() if x not in others)

    def watched(df, label, **k):
        until = time.monotonic() + 5  # the cleaner runs beside
        while size() > 5_000 and time.monotonic() < until:
            time.sleep(0.1)
        left.append(size())
        out = real(df, label, **k)
        most.append(size())
        return out

    monkeypatch.setattr(lm_scoring, "materialise", watched)
    lm_scoring.score_documents(documents(spark).limit(200))
    assert max(most) > 50_000 and max(left) <= 5_000


# -- chats -------------------------------------------------------------------------------------------------------------


def test_tool_calls(spark):
    schema = {"add": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer"}, "y": {"type": ["number", "null"]}, "z": {"type": "array", "items": {"enum": [1, 2]}}}, "additionalProperties": False}}
    assert chat.violations({"x": 1, "y": None, "z": [1, 3], "q": 0}, schema["add"]) == ["$.z[1]: not in enum", "$: q is unknown"]
    call = lambda *calls: json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})
    result = lambda i, **more: json.dumps({"tool_call_id": i, "content": "r", **more})
    rows = [
        (1, 0, "user", "q"), (1, 1, "tool", result("a")), (1, 2, "assistant", call(("a", "add", {"y": 1.5, "x": 1}), ("b", "nope", '{"k": 1}'))), (1, 3, "tool", result("b", tool_calls=[{"id": "c", "name": "add", "arguments": {}}])), (1, 3, "tool", result("c")),
        (1, 9, "tool", result("zz")), (2, 0, "tool", result("s", tool_calls=[{"id": "s", "name": "add", "arguments": {"x": "1"}}])), (None, 0, "assistant", '{"a": NaN}'), (None, None, None, None), (3, 1, "assistant", "{}"), (3, 1, "assistant", "{}"),
    ]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("message", F.lit(1)), schema).collect()
    assert len(got) == len(rows)
    links = {(r.conv_id, r.turn, r.link, r.order_turn, r.order_depth) for r in got if r.link}
    assert links == {(1, 1, "linked", 2, 1), (1, 3, "linked", 3, 1), (1, 3, "linked", 3, 2), (1, 9, "orphan", 9, 0), (2, 0, "cycle", 0, 0)}
    calls = {c.id: (c.check, c.answered) for r in got for c in r.calls}
    assert calls == {"a": ("valid", True), "b": ("unknown tool", True), "c": ("$: x is missing", True), "s": ("$.x: not of type integer", True)}
    for r in got:
        assert r.message == json.dumps(json.loads(r.message), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert '{"arguments":{"x":1,"y":1.5},"id":"a","name":"add"}' in next(r.message for r in got if r.turn == 2)
    assert chat.format_chats(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_tool_calls_after_white_space(spark):
    call, result = json.dumps({"tool_calls": [{"id": "a", "name": "f", "arguments": {}}]}), json.dumps({"tool_call_id": "a", "content": "r"})
    tools = json.dumps({"tools": [{"name": "f"}]})
    spaces = ["", " ", "\t", "\n", "\r", "\r\n \t"]
    rows = [(k, turn, role, space + text) for k, space in enumerate(spaces) for turn, (role, text) in enumerate((("system", tools), ("assistant", call), ("tool", result)))]
    rows += [(99, 0, "assistant", "\x0b" + call), (99, 1, "assistant", "\u00a0" + call)]
    got = {(r.conv_id, r.turn): (r.link, [(c.check, c.answered) for c in r.calls]) for r in chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert all(got[k, 1] == (None, [("valid", True)]) and got[k, 2] == ("linked", []) for k in range(len(spaces)))
    assert got[99, 0] == got[99, 1] == (None, [])


def test_chats_that_have_no_canonical_form(spark):
    texts = ['{"tool_call_id":"a","content":1e999}', '{"tool_call_id":"a","content":"\\ud800"}', '{"tool_call_id":"a","content":NaN}', '{"tool_call_id":"a","content":1e308}', "[" * 100000, '{"a":' * 5000]
    rows = [(1, k, "tool", t) for k, t in enumerate(texts)] + [(1, 9, "assistant", '{"tool_calls":[{"id":"a","name":"f","arguments":{"x":-1e999}},{"id":"b","name":"g","arguments":{}}]}')]
    rows += [(1, 10, "assistant", '{"tool_calls":[{"id":"b","name":"g","arguments":{"x":[1]}}]}')]
    got = {r.turn: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), {"g": {"properties": {"x": {"type": "nope"}}}}).collect()}
    assert {k: got[k].link for k in range(6)} == {0: None, 1: None, 2: None, 3: "orphan", 4: None, 5: None} and got[9].calls == []
    assert all(json.loads(got[k].message)["content"] == texts[k] for k in (0, 1, 2, 4, 5))
    assert [c.check for c in got[10].calls] == ["malformed schema"]


def test_registered_chat_queries_with_tool_traffic(spark, tmp_path):
    adder = {"name": "add", "parameters": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer"}}}}
    call = lambda i, name, **a: {"id": i, "name": name, "arguments": a}
    rows = [
        (1, 0, "system", json.dumps({"tools": [adder, {"type": "function", "function": {"name": "odd", "parameters": {"type": "nope"}}}, 7]})), (1, 1, "assistant", json.dumps({"tool_calls": [call("a", "add", x=1), call("b", "add", x="1")]})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "2"})), (1, 3, "assistant", json.dumps({"tool_calls": [call("c", "odd"), call("d", "sub")]})), (2, 0, "assistant", json.dumps({"tool_calls": [call("a", "add", x=1)]})),
        (None, 0, "system", json.dumps({"tools": [{"name": "free"}]})), (None, 1, "assistant", json.dumps({"tool_calls": [call("a", "free", y=0)]})),
    ]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {(r.conv_id, r.turn, r.pos, r.id, r.name, r.check, r.answered) for r in registry.QUERIES["op8_chat_calls"](spark, str(tmp_path)).collect()}
    assert got == {
        (1, 1, 0, "a", "add", "valid", True), (1, 1, 1, "b", "add", "$.x: not of type integer", False), (1, 3, 0, "c", "odd", "malformed schema", False), (1, 3, 1, "d", "sub", "unknown tool", False),
        (2, 0, 0, "a", "add", "unknown tool", False), (None, 1, 0, "a", "free", "valid", False),
    }
    chats = {(r.conv_id, r.turn): (r.link, r.order_turn, r.order_depth, r.n_calls) for r in registry.QUERIES["op8_chat"](spark, str(tmp_path)).collect()}
    assert len(chats) == len(rows) and chats[1, 2] == ("linked", 2, 1, 0) and chats[1, 1] == (None, 1, 0, 2)


# -- mixing ------------------------------------------------------------------------------------------------------------


def fill(sizes, share=1.5, cap=2.0):
    """Targets by re-sharing the excess until none is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, rest = dict.fromkeys(order, 0.0), share * sum(sizes.values())
    open_ = [s for s in order if sizes[s]]
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += rest * weight[s] / total
        rest = sum(max(0.0, target[s] - cap * sizes[s]) for s in order)
        target = {s: min(target[s], cap * sizes[s]) for s in order}
        open_ = [s for s in open_ if target[s] < cap * sizes[s]]
    return target


def test_mixing(spark):
    rng = random.Random(8)
    rows = [(k, "w " * rng.choice([0, 1, 5, 30, 400]), rng.choice(["hot"] * 8 + ["b", "Z", "é", None, "c"])) for k in range(900)] + [(None, "a b", "b"), (5, "w", "hot"), (5, "w", "hot"), (6, None, "empty")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("n", F.lit(1)).withColumn("k", F.lit(2))
    got = mixing.mix(frame, fan_in=7).collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    want = fill(size)
    by_source = {x: (t, s) for s, t in want.items() for x in [(size[s], round(t, 6))]}
    taken = Counter()
    for r in got:
        assert (r.source_size, round(r.target, 6)) in by_source and r.taken == r.copies * r.size and r.taken <= 2 * r.size
        taken[by_source[(r.source_size, round(r.target, 6))][1]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 400 for s in want)
    again = mixing.mix(frame.repartition(5), fan_in=7).collect()
    assert norm(map(tuple, got)) == norm(map(tuple, again))
    assert mixing.mix(frame.limit(0)).count() == 0


def test_mixing_is_unbiased(spark):
    rows = [(k, "w " * (1 + k % 4), "ab"[k % 2]) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    runs = [mixing.mix(frame, seed=s, fan_in=8).groupBy().agg(F.sum(F.when(F.col("doc_id") < 10, F.col("copies")))).first()[0] for s in range(6)]
    assert abs(np.mean(runs) - 15) < 3


# -- media -------------------------------------------------------------------------------------------------------------


def test_jpeg_round_trips():
    rng = random.Random(9)
    for data in (b"", b"a", b"\xff" * 64, bytes(64), bytes(range(256)) * 3, rng.randbytes(64 * 8200), "é😀".encode() * 40):
        padded = media.padded(data)
        assert len(padded) % 64 == 0 and len(padded) >= 64 and padded[: len(data)] == data and len(padded) - len(data) < 65
        coded = media.encode(padded)
        header = media.parse_header(coded)
        coefficients = media.decode_many([(header, coded)])[0]
        assert media.stored_bytes(header, coefficients) == padded
        thumb = media.thumbnail(header, coefficients)
        assert thumb.size == header.blocks and len(media.average_hash(thumb)) == 16


def test_a_foreign_jpeg_is_read():
    """16x8 samples in two blocks of one interval, DC 40 and then 40 - 24 at a quantiser of 2: codes 00 size 0, 01 size 5, 10 size 6; 0 end of block."""
    dc, ac = bytes([0, 3] + [0] * 14) + bytes([0, 5, 6]), bytes([1] + [0] * 15) + bytes([0])
    bits = "10" + "101000" + "0" + "01" + "00111" + "0"
    scan = int(bits.ljust(24, "1"), 2).to_bytes(3, "big")
    seg = media._segment
    raw = b"\xff\xd8" + seg(0xDB, b"\0" + b"\x02" * 64) + seg(0xC0, bytes([8, 0, 8, 0, 16, 1, 1, 0x11, 0])) + seg(0xC4, b"\0" + dc) + seg(0xC4, b"\x10" + ac) + seg(0xDA, bytes([1, 1, 0, 0, 63, 0])) + scan + b"\xff\xd9"
    header = media.parse_header(raw)
    coefficients = media.decode_many([(header, raw)])[0]
    assert coefficients[:, 0].tolist() == [40, 16] and not coefficients[:, 1:].any()
    assert media.thumbnail(header, coefficients).tolist() == [[138, 132]]


def colour_jpeg(width, height, sampling, interval, values, *, scan_order=(0, 1, 2), alone=False, adobe=None):
    """A baseline JPEG of three components with the given DC values, per component an array of (rows, columns) of
    blocks, written bit by bit. Luminance codes DC sizes in 4 bits, colour in 5 and with an AC coefficient in each."""
    dc = [bytes([0] * (n - 1) + [9] + [0] * (16 - n)) + bytes(range(9)) for n in (4, 5)]
    ac = [bytes([1] + [0] * 15) + b"\0", bytes([0, 2] + [0] * 14) + b"\0\x01"]
    most = max(h for h, _ in sampling), max(v for _, v in sampling)
    ways = [0] if alone else list(scan_order)
    if alone:
        h, v = sampling[0]
        units = [[(0, y, x)] for y in range(-(-height * v // (8 * most[1]))) for x in range(-(-width * h // (8 * most[0])))]
    else:
        units = [
            [(c, my * sampling[c][1] + y, mx * sampling[c][0] + x) for c in ways for y in range(sampling[c][1]) for x in range(sampling[c][0])]
            for my in range(-(-height // (8 * most[1]))) for mx in range(-(-width // (8 * most[0])))
        ]
    step, scan = interval or len(units), []
    for low in range(0, len(units), step):
        bits, last = "", [0, 0, 0]
        for c, y, x in (b for unit in units[low : low + step] for b in unit):
            d = int(values[c][y][x]) - last[c]
            last[c] += d
            size = abs(d).bit_length()
            bits += f"{size:0{4 + (c > 0)}b}" + (f"{d if d > 0 else d + (1 << size) - 1:0{size}b}" if size else "") + ("01" "1" "00" if c else "0")
        bits += "1" * (-len(bits) % 8)
        scan.append(int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\0"))
    coded = b"".join(x + (bytes([0xFF, 0xD0 + k % 8]) if k < len(scan) - 1 else b"") for k, x in enumerate(scan))
    seg = media._segment
    frame = bytes([8]) + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([3]) + b"".join(bytes([c + 1, h * 16 + v, 0]) for c, (h, v) in enumerate(sampling))
    names = bytes([len(ways)]) + b"".join(bytes([c + 1, 0x11 if c else 0]) for c in ways) + bytes([0, 63, 0])
    parts = [seg(0xDB, b"\0" + b"\x02" * 64), seg(0xC0, frame), seg(0xC4, b"\0" + dc[0] + b"\x10" + ac[0] + b"\1" + dc[1] + b"\x11" + ac[1]), seg(0xDD, interval.to_bytes(2, "big"))]
    if adobe is not None:
        parts.insert(0, seg(0xEE, b"Adobe\0\x64\0\0\0\0" + bytes([adobe])))
    return b"\xff\xd8" + b"".join(parts) + seg(0xDA, names) + coded + b"\xff\xd9"


@pytest.mark.parametrize("interval", [0, 1, 3])
@pytest.mark.parametrize("sampling", [((1, 1),) * 3, ((2, 2), (1, 1), (1, 1)), ((2, 1), (1, 1), (1, 1)), ((1, 2), (1, 1), (1, 2))])
def test_colour_jpegs_give_luminance(sampling, interval):
    rng = random.Random(f"{sampling}{interval}")
    for width, height in ((24, 20), (1, 1), (70, 33)):
        values = [[[rng.randrange(-120, 121) for _ in range(12)] for _ in range(12)] for _ in range(3)]
        rows, cols = -(-height // 8), -(-width // 8)
        want = [[int(min(255, max(0, round(values[0][y][x] * 2 / 8 + 128)))) for x in range(cols)] for y in range(rows)]
        for more in ({}, {"scan_order": (2, 0, 1)}, {"alone": True}, {"adobe": 1}):
            raw = colour_jpeg(width, height, sampling, interval, values, **more)
            header = media.parse_header(raw)
            coefficients = media.decode_many([(header, raw), (header, raw)])[1]
            assert media.thumbnail(header, coefficients).tolist() == want
    status = [x[-1] for x in media._features([raw, colour_jpeg(8, 8, sampling, 0, values, adobe=0), raw[:-4] + b"\xff\xd9"])]
    assert status[0] == "ok" and status[1] == "bad: RGB, which has no luminance" and status[2].startswith("bad")


def test_jpegs_without_size_are_bad():
    good = media.encode(media.padded(b"x"))
    frame = good.index(b"\xff\xc0") + 5
    for size in (b"\0\0\0\x08", b"\0\x08\0\0", b"\xff\xff\xff\xff"):
        assert media._features([good[:frame] + size + good[frame + 4 :]])[0][-1].startswith("bad")


def test_damaged_media(spark):
    good = media.encode(media.padded(b"hello"))
    bad = [None, b"", b"junk", good[:40], good[:-6] + b"\xff\xd9", good.replace(b"\xff\xc0", b"\xff\xc2")]
    frame = spark.createDataFrame([(k, 5, x) for k, x in enumerate([good, *bad])], "doc_id bigint, n_bytes bigint, media binary")
    status = [r.status for r in media.features(frame).orderBy("doc_id").collect()]
    assert status[0] == "ok" and status[1] == "null" and all(s.startswith("bad") for s in status[2:])


def test_media_query(spark):
    texts = dict(tuple(r) for r in documents(spark).select("doc_id", "text").collect())
    for r in registry.QUERIES["op10_media"](spark, SF).collect():
        raw = texts[r.doc_id].encode()
        payload = media.padded(raw)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert media.features(media.store(odd_documents(spark))).count() == 9
    assert media.features(media.store(odd_documents(spark).limit(0))).count() == 0


# -- pipeline ----------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sf = "/root/testdata/sf0.01"
    good = corpus_pipeline.quality_filter(spark, docs, sf).cache()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert docs.join(labels.where("quality = 1"), "doc_id", "left_semi").count() * 0.97 < good.join(labels.where("quality = 1"), "doc_id", "left_semi").count()
    cut = corpus_pipeline.repeated_lines(spark, good, sf).cache()
    rows = [tuple(r) for r in good.select("doc_id", "text").collect()]
    assert norm((r.doc_id, r.text) for r in cut.collect()) == norm((i, t) for i, _, _, t in drop_lines(rows))
    one = corpus_pipeline.near_copies(spark, cut, sf).cache()
    some = [tuple(r) for r in cut.select("doc_id", "text").where("doc_id < 250").collect()]
    want = {i for i, c in groups(some, 5).items() if i == c}
    got = {r.doc_id for r in corpus_pipeline.near_copies(spark, cut.where("doc_id < 250"), sf).collect()}
    assert got == want
    clean = corpus_pipeline.benchmark_leaks(spark, one, sf)
    assert clean.columns == list(corpus_pipeline.COLUMNS) and 0 < one.count() - clean.count() < 60
    mixed = corpus_pipeline.mix_sources(spark, clean, sf)
    assert mixed.count() == clean.count()


def test_pipeline_odd(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    odd_documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    odd = odd_documents(spark)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {r.doc_id for r in odd.collect()} and all(0 <= r.taken <= 2 * r.size for r in got)
    nameless = odd.withColumn("doc_id", F.lit(None).cast("bigint"))
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stage(spark, nameless, str(tmp_path))
        assert kept.columns == list(corpus_pipeline.COLUMNS) and kept.count() == 9, name
    assert corpus_pipeline.mix_sources(spark, nameless, str(tmp_path)).count() == 9
    assert corpus_pipeline.run(spark, str(tmp_path)).exceptAll(corpus_pipeline.run(spark, str(tmp_path))).count() == 0


def test_long_words_are_hashed_in_windows(monkeypatch):
    from millrace.llm import shingles

    rng = random.Random(7)
    texts = ["".join(rng.choice("abC \n") for _ in range(n)).encode() for n in (0, 1, 40, 300)] + [b"x" * 50, b" ", b"a b", b"y" * 64 + b" z"]
    whole, first = shingles.word_hashes(texts)
    assert len(whole) == sum(len(t.split()) for t in texts)
    for window in (1, 2, 7, 64, 1000):
        monkeypatch.setattr(shingles, "WINDOW_BYTES", window)
        again, first_again = shingles.word_hashes(texts)
        assert (again == whole).all() and (first_again == first).all()
    monkeypatch.undo()
    # beyond the places with values of their own a word still depends on every byte's place
    n = shingles.PLACES
    words = [b"a" * (2 * n) + b"b", b"a" * n + b"b" + b"a" * n, b"b" + b"a" * (2 * n), b"a" * (2 * n + 1)]
    assert len(set(shingles.word_hashes(words)[0].tolist())) == 4


def test_long_payloads_are_coded_in_slices(monkeypatch):
    from millrace.llm import media

    data = media.padded(bytes(range(256)) * 40 + b"\xff" * 300)
    whole = media.encode(data)
    monkeypatch.setattr(media, "BLOCKS_AT_ONCE", 8)
    assert media.encode(data) == whole
    header = media.parse_header(whole)
    assert media.stored_bytes(header, media.decode_many([(header, whole)])[0]) == data
