"""Hot keys: one key holds a third of the rows. The executed plans must deal it
over several tasks, and results must stay whole."""

import contextlib

from pyspark.sql import functions as F

from tidelog.operators import identity, joins, urls

from conftest import rows

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@contextlib.contextmanager
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_components_with_a_hub(spark):
    n = 900
    edges = [("hub", f"v{i:04d}") for i in range(0, n, 3)]  # the hub touches a third of the vertices
    edges += [(f"v{i:04d}", f"v{i + 1:04d}") for i in range(1, n - 1, 3)]  # pairs elsewhere
    verts = sorted({v for e in edges for v in e})
    with skew_conf(spark):
        got = dict(rows(identity.connected_components(
            spark.createDataFrame([(v,) for v in verts], "id string"),
            spark.createDataFrame(edges, "src string, dst string"),
        )))
    hub_members = {"hub"} | {f"v{i:04d}" for i in range(0, n, 3)}
    assert {got[v] for v in hub_members} == {"hub"}
    for i in range(1, n - 1, 3):
        a, b = f"v{i:04d}", f"v{i + 1:04d}"
        assert got[a] == got[b] == min(a, b)
    assert len(got) == len(verts)


def test_url_lookup_with_a_hot_url(spark):
    hot = "https://s.example.com/hive/sku/1"
    facts = [(i, hot if i % 3 == 0 else f"https://s.example.com/x{i % 50}") for i in range(3000)]
    dim = [("https://s.example.com", "home"), ("https://s.example.com/hive", "hive"),
           ("https://s.example.com/hive/sku", "sku")]
    with skew_conf(spark):
        out = urls.categorize(
            spark.createDataFrame(facts, "id int, url string"),
            spark.createDataFrame(dim, "prefix string, category string"),
            max_bytes=0,
        )
        got = dict(rows(out, "id", "ct"))
    assert len(got) == 3000
    assert all(got[i] == ("sku" if i % 3 == 0 else "home") for i in range(3000))


def _largest_share(joined, total):
    parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return max(r["count"] for r in parts) / total


def test_lookup_join_deals_a_hot_key_over_tasks(spark):
    """The join of hot URLs and hot cells (lookup_join): no task gets the key whole."""
    n = 6000
    facts = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"))
    dim = facts.groupBy("key").agg(F.max("id").alias("top"))
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        spread = joins.lookup_join(facts, dim, "key", max_bytes=0, rows_per_part=100)
        # 2000 rows of one key are cut into 20 parts, not into a fixed number.
        assert _largest_share(spread, n) < 0.1
        parts = joins.parts_by_bucket(facts, "key", 100).select(F.explode("parts").alias("p")).where("p > 1").collect()
        assert [r["p"] for r in parts] == [20]
        assert spread.where("top is null").count() == 0 and spread.count() == n
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_component_rounds_join_plain_scans(spark, tmp_path):
    """The round's join of edges with labels is one that Spark splits at a hub."""
    from tidelog.session import stored

    edges = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("src"), F.col("id").alias("dst"))
    e = stored(edges, str(tmp_path / "e"))
    labels = stored(edges.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct(), str(tmp_path / "l"))
    with skew_conf(spark):
        heard = e.join(labels, e["src"] == labels["id"]).groupBy("dst").agg(F.min("component").alias("heard"))
        heard.collect()
        plan = heard._jdf.queryExecution().executedPlan().toString()
    assert "skew" in plan.lower()


def test_lookup_join_of_odd_columns(spark):
    """Maps inside structs, and columns named like the helper's own."""
    facts = spark.sql("SELECT id AS _salt, id % 3 AS key, named_struct('m', map('a', id)) AS parts, array(map('b', 1)) AS _ct FROM range(300)")
    dim = spark.sql("SELECT id AS key, id * 10 AS _salt_ FROM range(2)").distinct()
    got = joins.lookup_join(facts, dim, "key", max_bytes=0, rows_per_part=10)
    assert got.columns == ["key", "_salt", "parts", "_ct", "_salt_"]
    assert sorted((r["_salt"], r["_salt_"]) for r in got.collect()) == [(i, None if i % 3 == 2 else i % 3 * 10) for i in range(300)]
    assert joins.lookup_join(facts.limit(0), dim, "key", max_bytes=0).count() == 0


def test_prefixes_of_thousands_of_lengths(spark):
    """Rows made are URLs plus prefixes, however many lengths the prefixes have."""
    dim = spark.createDataFrame([("u" * n, f"c{n}") for n in range(1, 5001)] + [("v", None), ("ü", "umlaut")], "prefix string, category string")
    asked = ["u" * n + "/x" for n in (1, 2, 77, 4999, 5000)] + ["u" * 6000, "v/1", "w", "", "üx", "u/"] + [f"zz{i}" for i in range(500)]
    got = dict(rows(urls.url_categories(spark.createDataFrame([(u,) for u in asked], "url string"), dim, default="none"), "url", "ct"))
    want = {u: "none" for u in asked} | {"u" * n + "/x": f"c{n}" for n in (1, 2, 77, 4999, 5000)} | {"u" * 6000: "c5000", "üx": "umlaut", "u/": "c1"}
    assert got == want
    plan = urls._best_hits(spark.createDataFrame([(u,) for u in asked], "_url string"), dim, 0)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_prefixes_open_over_partitions(spark):
    """A prefix that is open at the begin of many partitions reaches their URLs."""
    import random

    rng = random.Random(6)
    prefixes = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 9))) for _ in range(40)} | {"a"}
    asked = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(0, 14))) for _ in range(2500)})
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dim = spark.createDataFrame([(x, x.upper()) for x in prefixes], "prefix string, category string")
        got = dict(rows(urls.url_categories(spark.createDataFrame([(u,) for u in asked], "url string").repartition(7), dim, default="-"), "url", "ct"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == {u: max((x for x in prefixes if u.startswith(x)), key=len, default="-").upper() for u in asked}
