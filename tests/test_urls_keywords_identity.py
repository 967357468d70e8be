import random

from pyspark.sql import functions as F

from tidelog.operators import identity, keywords, urls

from conftest import rows


def _brute(url, dim, default):
    best = None
    for prefix, cat in dim:
        if url.startswith(prefix) and (best is None or len(prefix) > len(best[0])):
            best = (prefix, cat)
    return best[1] if best else default


def test_longest_prefix_matches_brute_force(spark):
    rnd = random.Random(3)
    alphabet = "ab/"
    prefixes = sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 6))) for _ in range(40)})
    dim = [(p, "cat-" + p) for p in prefixes] + [(prefixes[0], "aaa-dup")]
    url_list = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 9))) for _ in range(300)] + [None]
    facts = spark.createDataFrame([(i, u) for i, u in enumerate(url_list)], "id int, url string")
    dim_df = spark.createDataFrame(dim, "prefix string, category string")
    reduced = {p: min(c for q, c in dim if q == p) for p in prefixes}
    for max_bytes in (1 << 70, 0):  # broadcast lookup, then the salted one
        got = dict(rows(urls.categorize(facts, dim_df, "url", default="其他", max_bytes=max_bytes), "id", "ct"))
        for i, u in enumerate(url_list):
            expect = "其他" if u is None else _brute(u, reduced.items(), "其他")
            assert got[i] == expect, (max_bytes, u, got[i], expect)


def test_traffic_detail(spark):
    recs = spark.createDataFrame(
        [("pg_view", {"url": "https://s.example.com/hive/sku/1"}, 1560556800000),
         ("pg_view", {"title": "no url"}, 1560556800000),
         ("click", {"url": "https://s.example.com/hive"}, 1560556800000),
         ("pg_view", {"url": "ftp://other"}, 1560643199999)],
        "logType string, event map<string,string>, commit_time long",
    )
    for c in urls.DWD_COLUMNS:
        if c not in ("eventType", "ct", "dateStr", "commit_time"):
            recs = recs.withColumn(c, F.lit(c))
    dim = spark.createDataFrame(
        [("https://s.example.com", "home"), ("https://s.example.com/hive", "hive"),
         ("https://s.example.com/hive/sku", "hive-sku")], "prefix string, category string")
    out = urls.traffic_detail(recs, dim)
    assert tuple(out.columns) == urls.DWD_COLUMNS
    assert rows(out, "ct", "dateStr") == [("hive-sku", "2019-06-15"), ("其他", "2019-06-15")]


def test_keywords_and_stopwords(spark):
    df = spark.createDataFrame([("is the 天气 a, sale! 就要 ok",)], "t string")
    got = df.select(keywords.keywords(F.col("t")).alias("k")).first()["k"]
    assert got == "the 天气 sale ok"
    words = spark.createDataFrame([("is",), ("x",), ("yes",), (",",)], "word string")
    stops = spark.createDataFrame([(w,) for w in keywords.STOP_WORDS], "word string")
    assert rows(keywords.remove_stopwords(words, stops)) == [("x",), ("yes",)]
    # Longest word first, of any length; other letters one by one; the rest skipped.
    seg = spark.createDataFrame([("天气公园里, abcdefghijk",)], "t string").select(
        keywords.segment_with_dictionary(F.col("t"), ["天气", "公园", "天", "abcdefghi"]).alias("s")).first()["s"]
    assert seg == ["天气", "公园", "里", "abcdefghi", "j", "k"]


def test_stop_words_from_a_file_and_a_segmenter(spark, tmp_path):
    from tidelog.sources import readers

    (tmp_path / "stop.txt").write_text("公园\n,\n")
    stops = readers.read_stopwords(spark, str(tmp_path / "stop.txt"))
    recs = spark.createDataFrame([({"title": "天气公园里天气"},), ({"url": "x"},)], "event map<string,string>")
    out = keywords.add_title_keywords(recs, stops, segmenter=keywords.dictionary_segmenter(["天气", "公园"]))
    assert [r["event"].get("keyword") for r in out.collect()] == ["天气 天气", None]


# phone, name, chat id, income; one phone is blank.
PEOPLE = [
    ("555-1", "Ana", "wx-a", "1"), ("555-2", "Ben", "wx-a", "2"), (None, "Ana", "wx-b", "3"), ("555-3", "Cyd", "wx-c", "4"),
    ("555-3", "Dov", "wx-d", "5"), ("555-4", "Eli", "wx-d", "6"), (" ", None, "", "7"),
]


def test_components_fixture(spark):
    df = spark.createDataFrame(PEOPLE, "phone string, name string, wx string, income string")
    comps = identity.resolve_identities(df, ["phone", "name", "wx"])
    groups = {}
    for member, comp in rows(comps.labels, "id", "component"):
        groups.setdefault(comp, set()).add(member)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, [
        {"555-1", "555-2", "Ana", "Ben", "wx-a", "wx-b"},
        {"555-3", "555-4", "Cyd", "Dov", "Eli", "wx-c", "wx-d"},
    ]))
    for comp, members in groups.items():
        assert comp == min(members)
    assert sorted(r[1] for r in rows(comps.sizes)) == [6, 7]
    members = identity.component_members(comps.labels)
    assert members.count() == 13


def test_components_random_vs_union_find(spark):
    rnd = random.Random(11)
    n = 300
    edges = [(f"v{rnd.randrange(n)}", f"v{rnd.randrange(n)}") for _ in range(220)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    verts = sorted({v for e in edges for v in e} | {"lonely"})
    members = {}
    for v in verts:
        members.setdefault(find(v), []).append(v)
    expect = {v: min(members[find(v)]) for v in verts}
    vdf = spark.createDataFrame([(v,) for v in verts], "id string")
    edf = spark.createDataFrame(edges, "src string, dst string")
    got = dict(rows(identity.connected_components(vdf, edf)))
    assert got == expect
