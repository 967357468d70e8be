"""Components by contraction: few rounds on bad inputs, right labels on all."""

import random

import numpy as np
import pytest

from tidelog.operators import identity


def labels_of(spark, edges, ids=()):
    vertices = {v for e in edges for v in e if v is not None} | set(ids)
    v = spark.createDataFrame([(x,) for x in sorted(vertices)], "id string")
    e = spark.createDataFrame(edges, "src string, dst string")
    return {r["id"]: r["component"] for r in identity.connected_components(v, e).collect()}


@pytest.fixture
def rounds(monkeypatch):
    made = []
    hooks = identity._hooks
    monkeypatch.setattr(identity, "_hooks", lambda edges, step: made.append(step) or hooks(edges, step))
    return made


def test_long_path_in_a_bad_order_takes_few_rounds(spark, rounds):
    n = 10_000
    order = [*range(2, n + 1), 1]  # the smallest name is at the far end
    path = [(f"{a:06d}", f"{b:06d}") for a, b in zip(order, order[1:])]
    got = labels_of(spark, path)
    assert set(got.values()) == {"000001"} and len(got) == n
    assert len(rounds) <= 20


def test_shapes(spark, rounds):
    hub = [("hub", f"leaf{i}") for i in range(500)]
    ring = [(f"r{i:03d}", f"r{(i + 1) % 200:03d}") for i in range(200)]
    pairs = [(f"p{i}", f"q{i}") for i in range(50)] * 2 + [("p0", "p0")]
    got = labels_of(spark, hub + ring + pairs, ids=["alone"])
    assert got["alone"] == "alone" and got["p0"] == "p0" == got["q0"] and got["p7"] == got["q7"] == "p7"
    assert {got[f"leaf{i}"] for i in range(500)} == {"hub"} and {got[f"r{i:03d}"] for i in range(200)} == {"r000"}
    assert len(rounds) <= 9


def test_no_edges(spark, rounds):
    assert labels_of(spark, [("a", "a")]) == {"a": "a"} and rounds == []


def test_random_graphs_against_union_find(spark):
    rng = random.Random(4)
    edges = []
    for g in range(30):
        n = rng.randrange(2, 60)
        edges += [(f"{g}-{rng.randrange(n)}", f"{g}-{rng.randrange(n)}") for _ in range(int(n * rng.choice([0.4, 0.9, 1.6])) + 1)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    assert labels_of(spark, edges) == {x: find(x) for x in list(parent)}


def advanced(spark, labels, rows):
    """(labels, changes, merges) after one batch of rows of two identifiers."""
    before = spark.createDataFrame(labels, "id string, component string, more string")
    batch = spark.createDataFrame(rows, "a string, b string")
    out = identity.advance_identities(before, batch, ["a", "b"])
    return tuple(sorted((r[0], r[1]) for r in frame.collect()) for frame in out)


def test_names_of_components_last(spark):
    held = [("m", "m", "x"), ("n", "m", "x"), ("q", "q", "x"), ("z", "z", "x")]
    # A smaller new identifier does not rename, two components meet, new ones are named.
    labels, changes, merges = advanced(spark, held, [("a", "n"), ("q", "n"), ("k", "l"), ("e", None), (" ", None)])
    assert labels == [("a", "m"), ("e", "e"), ("k", "k"), ("l", "k"), ("m", "m"), ("n", "m"), ("q", "m"), ("z", "z")]
    assert changes == [("a", "m"), ("e", "e"), ("k", "k"), ("l", "k"), ("q", "m")]
    assert merges == [("q", "m")]


def test_a_batch_taken_in_twice_or_empty_changes_nothing(spark):
    held = [("m", "m", "x"), ("n", "m", "x")]
    for rows in ([("m", "n"), ("n", "m"), ("n", None)], [(None, None)], []):
        assert advanced(spark, held, rows) == ([("m", "m"), ("n", "m")], [], [])
    assert advanced(spark, [], [("b", "a")]) == ([("a", "a"), ("b", "a")], [("a", "a"), ("b", "a")], [])


def test_batches_in_turn_against_one_run(spark):
    rng = random.Random(8)
    rows = [(f"a{rng.randrange(60):02d}", rng.choice([None, "", f"b{rng.randrange(60):02d}"])) for _ in range(90)]
    labels, given_up = [], {}
    for i in range(0, 90, 30):
        labels, _, merges = advanced(spark, [(i, c, "") for i, c in labels], rows[i : i + 30])
        assert not set(given_up) & {c for _, c in labels}
        given_up.update(merges)
    at_once = identity.resolve_identities(spark.createDataFrame(rows, "a string, b string"), ["a", "b"]).labels.collect()
    least = {}
    for i, c in labels:
        least[c] = min(i, least.get(c, i))
    assert sorted((i, least[c]) for i, c in labels) == sorted((r["id"], r["component"]) for r in at_once)
    assert not set(given_up) & {c for _, c in labels}


def test_rows_stored_stay_near_the_number_of_identifiers(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(identity, "stored", lambda df, path, write=identity.stored: kept.append(write(df, path)) or kept[-1])
    monkeypatch.setattr(identity, "remove_path", lambda session, path: None)
    n = 3000
    rows = spark.range(n).selectExpr("concat('a', id) a", "concat('b', id * 7 % 3000) b", "if(id % 4 = 0, concat('c', id % 3000), null) c")
    sizes = identity.resolve_identities(rows, ["a", "b", "c"]).sizes
    assert sum(r["n_members"] for r in sizes.collect()) == 2 * n + n // 4
    assert sum(df.count() for df in kept) <= 5 * (2 * n + n // 4)
    assert "SortAggregate" not in sizes._jdf.queryExecution().executedPlan().toString()


def test_parts_of_small_chunks_meet(spark, monkeypatch):
    monkeypatch.setattr(identity, "EDGES_AT_ONCE", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        ring = [(f"r{i:02d}", f"r{(i + 1) % 40:02d}") for i in range(40)]
        got = labels_of(spark, ring + [("x", "y"), ("z", None), (None, "z")], ids=["x", "y", "z"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {**{f"r{i:02d}": "r00" for i in range(40)}, "x": "x", "y": "x", "z": "z"}


def test_places_are_the_same_in_spark_and_in_arrays(spark):
    numbers = [0, 1, 5, (3 << 40) + 7, (1 << 62) + 12345]
    for step in (1, 2, 9):
        frame = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", identity._in_order("n", step).alias("place"))
        got = [r["place"] for r in frame.withColumn("back", identity._in_order("place", step)).where("back = n").collect()]
        assert got == identity._places(np.array(numbers), step).tolist() and len(set(got)) == len(numbers)


def test_rows_in_no_order_make_few_parts(spark, monkeypatch):
    links = []
    contract = identity.contract
    monkeypatch.setattr(identity, "contract", lambda edges, base: links.append(edges.count()) or contract(edges, base))
    monkeypatch.setattr(identity, "EDGES_AT_ONCE", 200)
    rows = [(f"o{i % 500:03d}", f"p{i:04d}") for i in range(3000)]
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame(rows, "a string, b string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        found = identity.resolve_identities(frame, ["a", "b"])
        assert {(r["id"], r["component"]) for r in found.labels.collect()} == {(x, a) for a, b in rows for x in (a, b)}
        assert sorted(r["n_members"] for r in found.sizes.collect()) == [7] * 500
        held = spark.createDataFrame([("p0000", "p0000"), ("p0500", "p0500")], "id string, component string")
        assert [tuple(r) for r in identity.advance_identities(held, frame, ["a", "b"]).merges.collect()] == [("p0500", "p0000")]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # One link where a chunk ends, not one for every other row of an identifier.
    assert len(links) == 2 and max(links) <= 50
