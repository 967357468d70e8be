"""Hard negatives, licence scans and the prefix trie against plain re-statements."""

import glob
import hashlib
import os
import random
import re
import sys
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from tidelog.llm import components, licenses, negatives, prefixes, queries, scan, setsketch  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_prefix_trie"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.sql(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    a, b = (d[columns].fillna({c: -1 for c in ["parent_conv_id"] if c in columns}).sort_values(columns).reset_index(drop=True) for d in (got, want))
    assert len(a) and (a.astype(str).replace(r"\.0$", "", regex=True) == b.astype(str)).all().all()


# --- running values ---------------------------------------------------------


def test_running_values(spark):
    rng = random.Random(3)
    rows = [([],)] + [([rng.randrange(50) for _ in range(n)],) for n in (1, 2, 127, 128, 129, 700)]
    df = spark.createDataFrame(rows, "v array<int>")
    for r in df.select("v", scan.running_sum(F.col("v")).alias("s"), scan.running_max(F.col("v")).alias("m")).collect():
        assert r["s"] == np.cumsum(r["v"]).tolist()
        assert r["m"] == (np.maximum.accumulate(r["v"]).tolist() if r["v"] else [])


# --- licences ---------------------------------------------------------------


def plain_detections(text):
    """Every rule over the words, then suppression of each by every other."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower_ascii(text or ""))
    joined = " ".join(words)
    starts = {m.start(): i for i, m in enumerate(re.finditer(r"[^ ]+", joined))}
    ends = {m.end(): i + 1 for i, m in enumerate(re.finditer(r"[^ ]+", joined))}
    found = []
    for i, rule in enumerate(licenses.RULES):
        for m in re.finditer(rf"(?<![^ ])(?:{rule.pattern})(?![^ ])", joined):
            found.append((starts[m.start()], ends[m.end()], rule.priority, i))

    def inside(d, e):
        held = e[0] <= d[0] and d[1] <= e[1] and e != d
        same = e[:2] == d[:2]
        return held and (e[2] < d[2] or (e[2] == d[2] and (not same or e[3] < d[3])))

    kept = [d for d in found if licenses.RULES[d[3]].base or not any(inside(d, e) for e in found)]
    return len(words), sorted((licenses.RULES[d[3]].label, d[0], d[1], licenses.RULES[d[3]].base) for d in kept)


LICENCE_TEXTS = [
    None, "", " .!?", "no such thing here",
    "CC BY", "cc-by 4.0, cc by-sa 4.0", "Ｃc by", "General  Public\nLicense", "GENERAL PUBLIC LICENSE general public license",
    "All rights reserved. all Rights Reserved", "SPDX-License-Identifier: GPL-3.0-or-later",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "# This is released under the terms of the GNU General Public License, version 2.0", "the mit license", "licensed under the MIT license mit",
    "cc bycc by cc by by cc", "accc by", "ÉCC by é cc by", "LİCENSE public general", "Copyright (c) 2019 Someone. All rights reserved",
    "permission is hereby granted, free of charge, to any person obtaining a copy of the apache license 2.0",
]


def test_licences_against_brute_force(spark):
    given = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts = LICENCE_TEXTS + given + [" ".join(t for t in LICENCE_TEXTS if t) * 3]
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, words string, present double")
    hits = 0
    for r in licenses.find_licenses(df).collect():
        got = sorted((d["label"], d["start"], d["end"], d["base"]) for d in r["detections"])
        assert (r["n_words"], got) == plain_detections(texts[r["doc_id"]]), texts[r["doc_id"]]
        hits += len(got)
    assert hits > 40 and len(licenses.RULES) > 300


def test_licence_query_and_awkward_rows(spark, tmp_path):
    texts = [None, "", "cc by and cc by", "cc by and cc by", "Licensed under the Apache License, Version 2.0"]
    spark.createDataFrame([(i or None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, labels string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.op12_license_scan(spark, str(tmp_path)).collect()}
    assert tuple(rows[None])[1:] == (0, 0, None, None, "", "", 0.0) == tuple(rows[1])[1:]
    assert tuple(rows[2])[1:7] == (5, 2, 0, 3, "cc-by", "cc-by") and rows[2][1:] == rows[3][1:]
    assert rows[4]["labels"] == "apache-2.0" and rows[4]["base_labels"] == "" and rows[4]["score"] == 1.0
    plan = queries.op12_license_scan(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_licence_spans_of_a_very_long_text(spark):
    many = spark.createDataFrame([(1, "All rights reserved. " * 50000)], "doc_id long, text string")
    row = licenses.find_licenses(many).select("n_words", F.size("detections").alias("n"), F.element_at("detections", -1)["end"].alias("last")).first()
    assert tuple(row) == (150000, 50000, 150000)


# --- hard negatives ---------------------------------------------------------


def plain_negatives(rows, is_anchor):
    out = []
    for i, (a, la, va) in enumerate(rows):
        if not is_anchor(a):
            continue
        scored = sorted((-int(np.dot(va, v)), c, l) for j, (c, l, v) in enumerate(rows) if j != i and len(v) == len(va))
        for s, p, _ in [x for x in scored if x[2] == la][:5]:
            good = [(n, -t) for t, n, l in scored if l != la and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(a, p, k + 1, n, -s, t) for k, (n, t) in enumerate(good)]
    return sorted(out)


def test_negatives_against_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(-60, 60, (6, 8))
    rows = [(i, int(rng.integers(3)), [int(x) for x in centres[i % 6] + rng.integers(-9, 9, 8)]) for i in range(600)]
    rows += [(1000 + i, i % 2, [50] * 8) for i in range(200)]  # one vector, many times
    rows += [(2000, 0, [0] * 8), (2001, 1, [0] * 8), (2002, 0, []), (2003, 1, []), (2010, 2, [3, 4]), (2011, 2, [4, 4]), (2012, 1, [4, 3])]
    df = spark.createDataFrame(rows + rows[:30], "vec_id long, label long, v array<long>").distinct()
    got = negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, rows_per_shard=64, anchors_per_block=16)
    want = plain_negatives(rows, lambda a: a % 5 == 0)
    assert len(want) > 1000 and sorted(tuple(r) for r in got.collect()) == want


def test_negatives_awkward_rows(spark):
    schema = "vec_id long, embedding array<float>, label int, score double"
    odd = [(None, [1.0], 1, 0.0), (1, None, 1, 0.0), (2, [1.0, None], 1, 0.0), (3, [float("nan")], 1, 0.0), (4, [float("inf")], 1, 0.0), (5, [1.0], None, 0.0)]
    good = [(100, [0.5, 0.1], 1, 0.0), (101, [0.5, 0.1], 1, 1.0), (102, [0.49, 0.1], 2, 0.0), (102, [0.49, 0.1], 2, 1.0)]
    label = F.col("label")
    df = spark.createDataFrame(odd + good, schema)
    assert sorted(r["vec_id"] for r in negatives.labelled(df, label).collect()) == [100, 101, 102]
    got = negatives.hard_negatives(negatives.labelled(df, label), F.col("vec_id") % 100 == 0).collect()
    assert [tuple(r)[:4] for r in got] == [(100, 101, 1, 102)]
    assert negatives.hard_negatives(negatives.labelled(df.limit(0), label), F.lit(True)).count() == 0


def test_members_stop_early_on_clustered_rows():
    rng = np.random.default_rng(7)
    centres = np.eye(16) * 200
    points = np.concatenate([c + rng.normal(0, 4, (400, 16)) for c in centres]).astype(np.int64)
    import pandas as pd

    held = pd.DataFrame({"v": list(points), "label": rng.integers(0, 2, len(points)), "ids": [[i] for i in range(len(points))]})
    members = points[:20]
    lists = negatives.Lists.of(members, held)
    best = [[negatives.Best(5, negatives.LOWEST, negatives.HIGHEST)] for _ in members]
    scored = []
    negatives.walk(lists, members, best, lambda m, labels: scored.append(len(labels)) or np.ones(len(labels), bool))
    assert sum(scored) < 0.15 * len(points) * len(members)
    for m, (b,) in zip(members, best):
        assert sorted(b.scores.tolist(), reverse=True) == sorted((points @ m).tolist(), reverse=True)[:5]


def test_pairs_of_far_cones_are_not_searched(spark):
    import pandas as pd

    pivots = negatives.Pivots({2: np.array([[1.0, 0.0], [0.0, 1.0]])})
    cones = spark.createDataFrame([(2, 0, 0.1, 10.0, 2), (2, 1, 0.1, 10.0, 3)], "d int, pivot int, wide double, longest double, shards int")
    ask = spark.createDataFrame(pd.DataFrame({"d": [2], "own": [0], "block": [0], "angle": [0.05], "norm": [4.0], "least": [[30]]}), "d int, own int, block int, angle double, norm double, least array<long>")
    assert sorted((r["pivot"], r["shard"]) for r in negatives._routed(ask, cones, pivots).collect()) == [(0, 0), (0, 1)]


# --- prefix trie ------------------------------------------------------------


def plain_trie(rows):
    """rows: (conv, turn, role, text). The contract, one conversation at a time."""
    turns = defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5((hashlib.md5(role.encode()).hexdigest() + text).encode()).digest()
            turns[c].append(((n is not None, n or 0), role, digest, text))
    original = {c: [(r, t) for _, r, _, t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = original.get(c - c % 5, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    out = []
    for node, cs in members.items():
        under = [n for n in members if n[: len(node)] == node]
        kids = [n for n in members if len(n) == len(node) + 1 and n[: len(node)] == node]
        parents = {n[:-1] for n in members if n}
        ends = sorted(c for c in cs if len(rebuilt[c]) == len(node))
        out.append((
            min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(kids), sum(n not in parents for n in under),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in under if n), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def trie_rows(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, node string")
    nodes = prefixes.prefix_trie(*prefixes.rebuilt_turns(prefixes.ordered_turns(df)), **options)
    return sorted((tuple(r) for r in nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256").collect()), key=str)


def test_trie_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "SEGMENT", 4)
    monkeypatch.setattr(prefixes, "PIECE_BITS", 2)
    rng = random.Random(11)
    rows = []
    for c in range(120):
        for turn in range(rng.randrange(1, 12)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), "hé" if turn < 3 else rng.choice("abc")))
    rows += [(c, t, "user", f"copy {t}") for c in range(200, 260) for t in range(9)]
    rows += [(1000, t, "user", str(t % 3)) for t in range(60)]
    rows += [(None, 1, "user", "x"), (301, None, None, None), (301, 0, "user", "b"), (301, 0, "user", "a"), (302, 0, "user", ""), (302, 0, "user", ""), (2**62, 5, "user", "z")]
    want = plain_trie(rows)
    assert trie_rows(spark, rows, rows_below=6, rows_per_shard=50) == want
    assert trie_rows(spark, rows) == want


def test_trie_of_few_rows(spark):
    assert trie_rows(spark, [(7, 0, "user", "x")][:0]) == []
    # 41 takes more turns of an absent conversation than it has itself: no turn is left.
    alone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    assert trie_rows(spark, [(alone, 0, "user", "x")]) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_double_array_holds_all_paths():
    rng = random.Random(2)
    paths = sorted({tuple(rng.randrange(40) for _ in range(rng.randrange(1, 7))) for _ in range(3000)})
    trie = prefixes.DoubleArray([list(p) for p in paths])
    prefixes_of = {p[:d] for p in paths for d in range(1, len(p) + 1)}
    slots = {p: trie.walk(list(p)) for p in prefixes_of}
    assert all(len(slots[p]) == len(p) for p in prefixes_of)
    assert len({s[-1] for s in slots.values()}) == len(prefixes_of) == len(trie.order) - 1
    assert trie.walk([41, 1]) == []


# --- components and repeated ids --------------------------------------------


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    made = []
    hooks = components._hooks
    monkeypatch.setattr(components, "_hooks", lambda links, step: made.append(step) or hooks(links, step))
    order = [*range(2, 3001), 1]
    links = spark.createDataFrame(list(zip(order, order[1:])) + [(7, None), (9000, 9000), (8001, 8002)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert got == {i: 1 for i in range(1, 3001)} | {8001: 8001, 8002: 8001} and len(made) <= 20


def test_texts_of_one_id_are_one_document(spark):
    a, b, c = ("one two three four five six", "red green blue black white grey", "un deux trois quatre cinq six")
    rows = [(3, a), (5, a), (5, b), (9, b), (11, c), (11, None), (12, c), (12, ""), (4, "")]
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [
        (3, 3, True), (4, 4, True), (5, 3, False), (5, 3, False), (9, 3, False), (11, 11, True), (11, 11, True), (12, 11, False), (12, 11, False),
    ]
