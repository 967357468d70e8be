"""The operators against plain re-statements, on the small given tables and on
rows made to be awkward: nulls, empty and long texts, repeats, extra columns."""

import glob
import math
import os
import sys
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from tidelog.llm import html, langid, lm, pieces, pii, queries, secrets, setsketch, shingles, tiling, topk, toxicity  # noqa: E402
from tidelog.llm.components import connected_components  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string"


def frame(spark, texts, first=0):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(first + i, t, "en", "s", 0, 1.0, "x") for i, t in enumerate(texts)], SCHEMA)


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def documents_of(folder):
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' WHERE doc_id IS NOT NULL").fetchall()


def labels_of(folder):
    return duckdb.sql(f"SELECT doc_id, max(toxic) FROM '{folder}/labels.parquet' WHERE toxic IN (0, 1) GROUP BY doc_id").fetchall()


@pytest.mark.parametrize("name", ["op5_top_k", "op6_near_duplicates"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.sql(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    a, b = (d[columns].sort_values(columns).reset_index(drop=True) for d in (got, want))
    assert len(a) and a.equals(b)


# --- language ---------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98
    rows = {r["doc_id"]: r["held_out"] for r in got.collect()}
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in rows.items())


def test_language_codewords():
    for k in (2, 3, 5, 9, 30):
        code = langid.codewords(k)
        assert min((code[i] != code[j]).sum() for i in range(k) for j in range(i)) >= 1
        assert not np.any(np.abs(code.sum(0)) == k)


def test_language_awkward(spark):
    train = frame(spark, ["the cat and the dog"] * 6).unionByName(frame(spark, ["el gato y el perro"] * 6, 100).withColumn("lang", F.lit("es")))
    model = langid.train(train, F.lit(True))
    odd = frame(spark, [None, "", "123 !?", "the cat", "el perro " * 40000, "the cat"])
    rows = [(r["lang_pred"], r["score"]) for r in langid.identify(odd, model).orderBy("doc_id").collect()]
    assert [p for p, _ in rows] == ["und", "und", "und", "en", "es", "en"] and rows[3] == rows[5]
    assert all(0 <= s <= 1 for _, s in rows)
    empty = train.limit(0)
    assert langid.train(empty, F.lit(True)) is None
    assert [r["lang_pred"] for r in langid.identify(odd.limit(4), None).collect()] == ["und"] * 4
    assert langid.identify(empty, model).count() == 0


# --- toxicity ---------------------------------------------------------------


def test_toxicity_points_at_sentences(spark):
    clean = [f"the sun rose over hill {w}. birds sang to {w}." for w in "abcdefghijklmnopqrst"]
    rude = [f"the sun rose over hill {w}. you moron {w}! birds sang." for w in "abcdefghijklmnopqrst"]
    docs = frame(spark, clean + rude)
    labels = spark.createDataFrame([(i, 1, int(i >= 20)) for i in range(40)] + [(3, 0, None), (25, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    odd = frame(spark, [None, "", "..!", "birds sang.", "birds sang. you moron!", "birds sang. " * 20000 + "Moron"])
    rows = toxicity.score(odd, model).orderBy("doc_id").collect()
    assert [r["predicted"] for r in rows] == [0, 0, 0, 0, 1, 1]
    assert [r["score"] for r in rows[:3]] == [0.0] * 3
    span = rows[4]["offending"][0]
    assert "birds sang. you moron!"[span["start"] : span["end"]] == "you moron"
    assert toxicity.train(docs, labels.where("toxic = 0"), F.lit(True)) is None
    assert {r["score"] for r in toxicity.score(odd, None).collect()} == {0.0}
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_toxicity_keeps_long_clean_texts():
    docs = dict(documents_of("/root/testdata/sf0.01"))
    labels = dict(labels_of("/root/testdata/sf0.01"))
    number, bags, y, held = {}, [], [], []
    for d, text in docs.items():
        if text and labels.get(d) in (0, 1):
            if zlib.crc32(str(d).encode()) % 5 == 0:
                held += [text] if labels[d] == 0 else []
                continue
            lines = toxicity.sentences(text)
            bags.append((np.array([number.setdefault(w, len(number)) for line in lines for w in line], dtype=np.int32), np.array([len(line) for line in lines], dtype=np.int32)))
            y.append(labels[d])
    model = toxicity.fit(bags, list(number), np.array(y), np.ones(len(y)))
    # Clean texts that are kept one by one are kept as one text, of any length.
    joined = "\n".join(t for t in held if model.score(t) < 0.5)
    long = "\n".join([joined] * (1 + 50_000 // len(model.logits(joined))))
    assert len(model.logits(long)) > 50_000
    assert toxicity.Model(model.weights, model.bias).score(long) >= 0.5
    assert model.score(long) < 0.5


def test_floor_keeps_noisy_or():
    """Sentences from the floor on add up; those under it do not."""
    weights = np.zeros(toxicity.WEIGHTS)
    weights[toxicity.word_features("bad")[0]] = 4.0
    model = toxicity.Model(weights, -5.0, -2.0)
    bad = 1 / (1 + math.exp(1))
    assert math.isclose(model.score("bad. good. bad. " + "good. " * 30000), 1 - (1 - bad) ** 2)
    assert math.isclose(model.score("good. " * 30000), 1 / (1 + math.exp(5)))


def test_noisy_or():
    weights = np.zeros(toxicity.WEIGHTS)
    weights[toxicity.word_features("bad")[0]] = 3.0
    model = toxicity.Model(weights, -2.0)
    p = [1 / (1 + math.exp(2)), 1 / (1 + math.exp(-1))]
    assert math.isclose(model.score("good. bad one."), 1 - (1 - p[0]) * (1 - p[1]))


# --- near duplicates --------------------------------------------------------


def brute_components(rows, percent=85):
    sets = {d: brute.shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_near_duplicates_of_variants(spark):
    """A family in which every text differs from the next by a few words: some
    pairs link, some only through others, many not at all."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    texts = ["", "one two", "ONE two", "one  two\n", None, "a b c d e", " ".join(base), " ".join(base).upper()]
    for n in range(150):
        words = list(base)
        for at in rng.integers(0, 120, int(rng.integers(1, 7))):
            words[at] = f"x{n}" if rng.random() < 0.7 else base[rng.integers(120)]
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setsketch.near_duplicates(frame(spark, texts), 0.85).collect()}
    assert got == brute_components(rows)
    assert len({c for _, c in got.values()}) > 20


def test_near_duplicates_awkward(spark):
    odd = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (7, "A b c d e f"), (9, None)], "doc_id long, text string")
    rows = setsketch.near_duplicates(odd, 0.85).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in rows if r["doc_id"]) == [(5, 5, True), (5, 5, True), (7, 5, False), (9, 9, True)]
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, None)]
    assert setsketch.near_duplicates(odd.limit(0), 0.85).count() == 0


def test_sketch_is_mergeable_and_estimates():
    family = setsketch.hash_family(600)
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    a, b = x[:4500], x[500:]
    ka, kb = setsketch.registers(a, family), setsketch.registers(b, family)
    assert np.array_equal(np.maximum(ka, kb), setsketch.registers(x, family))
    j = setsketch.estimate(np.array([(ka > kb).sum()]), np.array([(ka < kb).sum()]), 600, np.array([4500.0]), np.array([4500.0]))[0]
    assert abs(j - 0.8) < 0.08


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_word_hashes():
    assert len(set(shingles.word_hashes("a b ab ba aa \x01 é É").tolist())) == 8
    assert np.array_equal(shingles.word_hashes("Ab\tcD\n\v\f\r ef"), shingles.word_hashes("ab cd EF"))
    long = "xyz " * 500_000 + "é" * 3_000_000
    assert len(shingles.word_hashes(long)) == 500_001
    assert len(shingles.shingle_set("x y")) == 1 and not len(shingles.shingle_set(" \n")) and not len(shingles.shingle_set(None))


# --- decontamination --------------------------------------------------------


def test_tiling_matches_brute_force():
    def plain(item, text, least):
        """Greedy string tiling by its definition: longest first, left to right."""
        im, tm, covered = [False] * len(item), [False] * len(text), 0
        while True:
            best, found = least - 1, []
            for p in range(len(item)):
                for t in range(len(text)):
                    n = 0
                    while p + n < len(item) and t + n < len(text) and item[p + n] == text[t + n] and not im[p + n] and not tm[t + n]:
                        n += 1
                    if n > best:
                        best, found = n, [(p, t)]
                    elif n == best and n >= least:
                        found.append((p, t))
            if best < least:
                return covered
            for p, t in found:
                if not any(im[p : p + best]) and not any(tm[t : t + best]):
                    im[p : p + best] = tm[t : t + best] = [True] * best
                    covered += best

    rng = np.random.default_rng(2)
    for _ in range(60):
        item = rng.integers(1, 9, 40).astype(np.uint64)
        cut = rng.permutation(np.array_split(np.arange(40), 4).__len__())
        parts = np.array_split(item, 4)
        text = np.concatenate([np.append(rng.integers(1, 9, 12).astype(np.uint64), parts[i]) for i in cut])
        tiles = tiling.tile(item, text, 4)
        assert all(np.array_equal(item[p : p + n], text[t : t + n]) for p, t, n in tiles)
        assert len({x for p, _, n in tiles for x in range(p, p + n)}) == sum(n for *_, n in tiles)
        assert abs(sum(n for *_, n in tiles) - plain(item.tolist(), text.tolist(), 4)) <= 4


def test_tiling_of_one_repeated_word():
    began = time.time()
    assert tiling.tile(np.full(200, 7, np.uint64), np.full(100_000, 7, np.uint64)) == [(0, 0, 200)]
    assert time.time() - began < 20
    # Tiles that cut a run leave its rest: 6 + 5 of the item's 11 tokens.
    item, text = np.array([1] * 11, np.uint64), np.array([1] * 6 + [2] + [1] * 5, np.uint64)
    assert sorted(n for *_, n in tiling.tile(item, text)) == [5, 6]


def test_contamination(spark):
    item = "Which planet is nearest to the sun? It turns once in fifty nine days, more or less, around itself."
    halves = "It turns once in FIFTY nine days -- more or less around itself! Some other words. which planet is nearest to the sun"
    bench = spark.createDataFrame([(1, item, "x"), (2, "too short", "x"), (3, None, "x"), (None, item, "x"), (4, "", "x")], "item_id long, text string, coverage string")
    texts = ["nothing of it here at all", "before " + item + " after", halves, None, "", "which planet is nearest", "word " * 50000 + item, item]
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in tiling.contaminated(frame(spark, texts), bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (6, 1), (7, 1)} and min(got.values()) > 0.9
    assert tiling.contaminated(frame(spark, texts), bench.limit(0)).count() == 0
    assert tiling.contaminated(frame(spark, texts).limit(0), bench).count() == 0


def test_tokens_beyond_ascii():
    def same(a, b):
        return np.array_equal(shingles.token_hashes(a), shingles.token_hashes(b))

    assert same("“It’s” a\u00a0b—c…", "\"It's\" a b - c") and same("naïve Größe", "NAÏVE größe!") and not same("naïve", "naive")
    assert same("中文，字x1 한국 語", "中 文 字 x1 한국 語") and same("ที่นี่", "ที่ นี่") and same("กำ123", "ก ำ 123")
    assert len(shingles.token_hashes("これはペンです")) == 7 and len(shingles.token_hashes("हिन्दी में")) == 2 and not len(shingles.token_hashes("—😀\ud800…"))
    long = "字" * (shingles.CHUNK + 5) + "x\u0301y z"
    assert len(shingles.token_hashes(long)) == shingles.CHUNK + 7
    assert np.array_equal(shingles.token_hashes("x" * (shingles.CHUNK - 1) + "字\u0e31b"), shingles.token_hashes("x" * (shingles.CHUNK - 1) + " 字\u0e31 b"))


def test_contamination_beyond_ascii(spark):
    items = ["哪一颗行星离太阳最近？它五十九天自转一周。", "ดาวเคราะห์ดวงใดอยู่ใกล้ดวงอาทิตย์มากที่สุด", "Which planet is “nearest” to the sun—and turns once in fifty nine days?"]
    bench = spark.createDataFrame(list(enumerate(items, 1)), "item_id long, text string")
    texts = ["前面的文字" + items[0] + "后面的文字", "它五十九天自转一周，别的话。哪一颗行星离太阳最近", "บทนำ" + items[1] + "จบ", "Which planet is \"nearest\" to the sun - and turns once in\u00a0fifty nine days", "今天天气很好，我们去公园散步。", "วันนี้อากาศดีมาก"]
    got = {(r["doc_id"], r["item_id"]) for r in tiling.contaminated(frame(spark, texts), bench).collect()}
    assert got == {(0, 1), (1, 1), (2, 2), (3, 3)}


# --- personal data and secrets ----------------------------------------------

ODD = [
    None, "", "a@b.c_d@e.f x@y.z a@b@c.d", "1.2.3.4.5.6.7.8 999.1.1.1 256.1.1.1 010.001.0.0", "4111 1111 1111 1111 4111-1111-1111-1112", "1" * 30000,
    "+" * 30 + "1 (234) 555-1212 . ) ( +12", "é@ü.de ſecret=abcdefgh PASSWORD: \"abcDEF123\" apikey='zz' api_key = 'zzzzzzz' token=abc",
    "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + " " + "f" * 23 + " " + "f" * 24, "DE89 3704 0044 0532 0130 00 iban GB82WEST12345698765432 GB82WEST12345698765433",
    'x = "hunter2hunter"\ndb_pwd = x\nprivate_key := \'ab12\' + "CD34efgh"', "a" * 60000 + "@b.c " + "1.2.3.4 " * 500, "😀 a@b.co 😀 1.2.3.4 phone +1 (222) 333-4444",
]


@pytest.mark.parametrize("find,rules,columns", [(secrets.find_secrets, brute.SECRETS, {"assign": "n_assign", "access": "n_access", "hex": "n_hex"}), (pii.find_pii, brute.PII, {k: f"n_{k}" for k in ("email", "ip", "card", "phone")})])
def test_base_spans(spark, find, rules, columns):
    rows = dict(documents(spark)) | {10**6 + i: t for i, t in enumerate(ODD)}
    df = frame(spark, list(rows.values())).withColumn("doc_id", F.element_at(F.array(*[F.lit(k) for k in rows]), (F.col("doc_id") + 1).cast("int")))
    got = queries._digest(find(df), columns).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute.base_spans(rows[r["doc_id"]], rules)
        assert r["base_sha256"] == brute.sha(want), (r["doc_id"], want[:3], r["spans"][:200])
        assert [r[c] for c in columns.values()] == [sum(w.startswith(k + ":") for w in want) for k in columns]
    assert find(df.limit(0)).count() == 0


def test_added_spans(spark):
    rows = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.find_pii(frame(spark, ODD)).collect()}
    assert rows[9] == [("iban", 0, 27), ("iban", 33, 55)]
    found = [(s["kind"], ODD[10][s["start"] : s["end"]]) for s in secrets.scan(ODD[10])]
    assert found == [("literal", "hunter2hunter"), ("literal", "ab12"), ("literal", "CD34efgh")]
    assert not secrets.scan('colour = "hunter2hunter"') and not secrets.scan('db_pwd = "changeme"')


@pytest.mark.parametrize(
    "text,want",
    [
        ("# prod\nexport DB_PWD=k3J8xQz2Lm # comment\nPORT=8080", ["k3J8xQz2Lm"]),
        ("db:\n  - private_key: aB3dE5fG7h\n  host: example.org", ["aB3dE5fG7h"]),
        ("[aws]\r\naws_access_key = Zx81/qqPl+w\r\nregion = eu\r\n", ["Zx81/qqPl+w"]),
        ("client.key:P4ss(w)rd!\nsigning-key=Q9w8E7r6;", ["P4ss(w)rd!", "Q9w8E7r6"]),
        ('private_key: str = "aB3dE5fG7h"', ["aB3dE5fG7h"]),
        ('x: Optional[str] = "aB3dE5fG7h"\ndb_pwd = x', ["aB3dE5fG7h"]),
        ('const dbPwd: string | null = "aB3dE5fG7h";', ["aB3dE5fG7h"]),
        ('private dbPwd?: string = "aB3dE5fG7h";', ["aB3dE5fG7h"]),
        ('var pwd string = "aB3dE5fG7h"', ["aB3dE5fG7h"]),
        ('var x string = "aB3dE5fG7h"\npwd := x', ["aB3dE5fG7h"]),
        ('const pwd Phrase = "aB3dE5fG7h"', ["aB3dE5fG7h"]),
        ('String text = "aB3dE5fG7h"; credential = text', ["aB3dE5fG7h"]),
        ('let pwd: &\'static str = "aB3dE5fG7h";', ["aB3dE5fG7h"]),
        ('db_pwd = prefix() + "aB3dE5fG7h"', ["aB3dE5fG7h"]),
        ('db_pwd = "aB3dE5fG7h" + salt + f("zz99zz99", x)', ["aB3dE5fG7h"]),
        ('db_pwd = "aB3dE5" +\n  "fG7hJ8"', ["aB3dE5", "fG7hJ8"]),
        ("db_pwd = get_it(config)\ndb_pwd = settings.db.pwd\nprivateKey: string;\nDB_PWD=${OTHER}\ndb_pwd: $OTHER", []),
        ('f(db_pwd=g(credential="aB3dE5fG7h"))', ["aB3dE5fG7h"]),
        ("colour=aB3dE5fG7h\nthe db_pwd is long\nDB_PWD=\n", []),
    ],
)
def test_values_of_sensitive_names(text, want):
    assert [text[s["start"] : s["end"]] for s in secrets.scan(text)] == want


@pytest.mark.parametrize(
    "text,want",
    [
        ('x = "Zk39fjQ0a8"\nx = load()\npassword = x', []),
        ('x = "Zk39fjQ0a8"\nuse(x=load())\nif x:\n  pass\npwd = x', ["Zk39fjQ0a8"]),
        ('x = "Zk39fjQ0a8"\nx = "aB3dE5fG7h"\npwd = x', ["aB3dE5fG7h"]),
        ('db_pwd = """aB3dE5fG7h"""', ["aB3dE5fG7h"]),
        ("db_pwd = '''\n  aB3dE5fG7h\n'''", ["aB3dE5fG7h"]),
        ("cfg['db_pwd'] = 'aB3dE5fG7h'", ["aB3dE5fG7h"]),
        ('os.environ["A"]["DB_PWD"] = "aB3dE5fG7h";', ["aB3dE5fG7h"]),
        ('set_pwd("aB3dE5fG7h")', ["aB3dE5fG7h"]),
        ('k = "aB3dE5fG7h"; conn.setDbPwd(k)', ["aB3dE5fG7h"]),
        ('props.setProperty("db.pwd", "aB3dE5fG7h")', ["aB3dE5fG7h"]),
        ("define('DB_PWD', 'aB3dE5fG7h');", ["aB3dE5fG7h"]),
        ('settle_pwd("aB3dE5fG7h") check("db.pwd", "aB3dE5fG7h")', []),
        ("db:\n  pwd: |\n    aB3dE5fG7h\n  host: x", ["aB3dE5fG7h"]),
        ("private_key: >-\n  aB3dE5fG7h\n  Q9w8E7r6tt\n\nnext: 1", ["aB3dE5fG7h\n  Q9w8E7r6tt"]),
        ("pwd: |\nnot: inside", []),
        ("<conf><db_pwd kind='x'> aB3dE5fG7h </db_pwd></conf>", ["aB3dE5fG7h"]),
        ("<db_pwd>aB3dE5fG7h</db_host>", []),
        ('db_pwd = f"aB3dE5{x}fG7h"', []),
        ('db_pwd = b"aB3dE5fG7h"\nauth_key = f\'Q9w8E7r6tt\'', ["aB3dE5fG7h", "Q9w8E7r6tt"]),
    ],
)
def test_more_forms_of_assignment(text, want):
    assert [text[s["start"] : s["end"]] for s in secrets.scan(text) if s["kind"] == "literal"] == want


@pytest.mark.parametrize("name", ["pass_phrase", "pass_word", "pass-phrase", "db.p_w_d", "Pass_Word", "to_ken", "sec_ret", "cre-dential", "auth_k$ey"])
def test_no_hint_is_missed(name):
    text = name + ' = "aB3dE5fG7h"'
    assert [text[s["start"] : s["end"]] for s in secrets.scan(text)] == ["aB3dE5fG7h"]


def test_lexing_stays_linear():
    for piece in ("f(a=x+", "a: b ", "pwd=[", "a:[", "x = y + ", "pwd: ", "db_pwd=" + "z" * 50 + " ", '"""', "pwd: |\n ", "<pwd ", "<pwd>a", "set(pwd, "):
        secrets.scan("pwd secret " + piece * 20_000)


def test_context_moves_the_score(spark):
    near, far = (r["spans"][0]["score"] for r in pii.find_pii(frame(spark, ["server 10.0.0.1", "version 10.0.0.1"])).orderBy("doc_id").collect())
    assert near > 0.5 > far


def test_redaction(spark):
    done = [r["text"] for r in pii.redact(frame(spark, ODD)).orderBy("doc_id").collect()]
    assert done[:3] == [None, "", "[EMAIL][EMAIL] [EMAIL] a@[EMAIL]"] and done[12].startswith("😀 [EMAIL] 😀 [IP] phone [PHONE]")


def test_redaction_whatever_the_context(spark):
    texts = ["order 4111 1111 1111 1111", "serial +1 (222) 333-4444", "release 10.0.0.1", "isbn, example: a@b.co"]
    assert [r["text"] for r in pii.redact(frame(spark, texts)).orderBy("doc_id").collect()] == ["order [CARD]", "serial [PHONE]", "release [IP]", "isbn, example: [EMAIL]"]


def test_context_of_whole_words(spark):
    """Hurting words count as whole words only, also where the context is cut."""
    after = "10.0.0.1 " + "x" * 37 + " vimentre"
    before = "conv " + "y" * 38 + " 10.0.0.1"
    texts = [after, before, "10.0.0.1 " + "x" * 37 + " v", "v " + "y" * 37 + " 10.0.0.1", "border 4111 1111 1111 1111", "order 4111 1111 1111 1111", "10.0.0.1 " + "x" * 32 + " version", "10.0.0.1 " + "x" * 32 + " versionen"]
    assert [r["spans"][0]["score"] for r in pii.find_pii(frame(spark, texts)).orderBy("doc_id").collect()] == [0.7, 0.7, 0.3, 0.3, 0.8, 0.4, 0.3, 0.7]


def test_very_many_spans(spark):
    """More spans than a fold gathers at once, and gaps longer than a piece."""
    n, gap = 3 * pii.GATHERED + 7, "é😀 " * pii.PIECE
    text = "10.2.3.4 ok " * n + gap + "a@b.co" + gap
    (row,) = pii.find_pii(frame(spark, [text])).collect()
    assert [(s["kind"], s["start"]) for s in row["spans"]] == [("ip", 12 * i) for i in range(n)] + [("email", 12 * n + len(gap))]
    (row,) = pii.redact(frame(spark, [text])).collect()
    assert row["text"] == "[IP] ok " * n + gap + "[EMAIL]" + gap


def test_native_plan(spark):
    plan = queries.op10_pii(spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


# --- language model ---------------------------------------------------------


def test_language_model_base(spark):
    rows = documents(spark)
    counts = Counter(w for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2 for w in [*brute.WORD.findall(brute.lower_ascii(t or "")), None])
    total, types = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in queries.op7_language_model(spark, SF).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        words = [*brute.WORD.findall(brute.lower_ascii(t or "")), None]
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), total)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in words), rel_tol=1e-9)
        assert r["score"] < 0
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_is_a_distribution(spark):
    """Over all words and the unknown class, the chances after any history add up to 1."""
    learn = ["a b a c", "a b b", "c a b", "a d", "e"]
    vocabulary = ["a", "b", "c", "d", "e", "unseen"]
    # A text "h w" scores P(h) P(w|h) P(end|w): take the parts apart by three texts each.
    df = frame(spark, learn).unionByName(frame(spark, vocabulary, 100)).unionByName(frame(spark, [f"a {w}" for w in vocabulary] + ["a"], 200))
    got = {r["doc_id"]: r["score"] for r in lm.score(df, F.col("doc_id") >= 100).collect()}
    counts = Counter(w for t in learn for w in [*t.split(), None])
    assert sum(counts.values()) == 18
    state = lm.Automaton
    stats = lm.Statistics(18, 6, 0.5, 0.5, 5)
    weights = np.log10(np.array([(counts[w] - 0.5) / 18 for w in [*"abcde", None]] + [0.5 * 6 / 18]))
    arcs = Counter((h, w) for t in learn for h, w in zip(t.split(), [*t.split()[1:], None]))
    words = [*"abcde", None, "unseen"]
    p = state(weights, None, np.array([arcs[("a", w)] for w in words], float), stats).traverse(np.arange(7), np.full(7, float(counts["a"])), np.arange(7))
    assert math.isclose(float((10**p).sum()), 1.0)
    assert got[206] < 0 and all(v < 0 for v in got.values())


def test_language_model_awkward(spark):
    odd = frame(spark, [None, "", "a", "a", "a " * 300000])
    rows = lm.score(odd, F.col("doc_id") == 2).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in rows] == [1, 1, 2, 2, 300001] and rows[2]["score"] == rows[3]["score"]
    assert lm.score(odd.limit(0), F.lit(False)).count() == 0
    assert {r["base_score"] for r in lm.score(odd, F.lit(True)).collect()} == {0.0}


# --- pieces -----------------------------------------------------------------


def test_pieces_match_brute_force():
    model = pieces.load()
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    known = {lib.id_to_piece(i): i for i in range(lib.get_piece_size()) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))}

    def best(text):
        score = [0.0] + [-math.inf] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(end):
                piece = text[start:end]
                own = lib.get_score(known[piece]) if piece in known else model.unknown_score if end - start == 1 else None
                if own is not None:
                    score[end] = max(score[end], score[start] + own)
        return score[-1]

    for text in ["the quick brown fox", "ciónñgaco über", "日本 x", "a  b   c", "x\ny", "💡!"]:
        ids = model.encode(text)
        marked = "▁" + text.replace(" ", "▁")
        unknown = [c for c in marked if c not in known]
        own = sum(lib.get_score(i) for i in ids if not lib.is_byte(i)) + model.unknown_score * len(unknown)
        assert math.isclose(own, best(marked), rel_tol=1e-12)
        assert model.decode(ids) == text


def test_round_trip(spark):
    odd = [None, "", " ", "  two  spaces ", "▁ marker ▁▁", "tab\tand\r\nline\n\n", "\u0000 ﻿ 💡 日本語", "x" * 200000, "same", "same"]
    rows = pieces.with_pieces(frame(spark, odd).withColumn("ids", F.lit(1))).orderBy("doc_id").collect()
    assert all(r["round_trip"] for r in rows) and [len(r["ids"]) for r in rows[:2]] == [0, 0]
    assert rows[8]["ids"] == rows[9]["ids"] and all(r["n_tokens"] == len(r["ids"]) for r in rows)
    assert pieces.with_pieces(frame(spark, odd).limit(0)).count() == 0
    assert queries.op9_sentencepiece(spark, SF).where("not round_trip").count() == 0


# --- top-k ------------------------------------------------------------------


def test_top_k_awkward(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(50)] + [rows[3], (None, rows[3][1]), (50, None), (2000, [1.0] * 3), (2050, [2.0] * 3), (2100, []), (2150, [None] + [1.0] * 7), (2200, [float("nan")] * 8), (2250, [float("inf")] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = topk.top_k(topk.quantized(df), F.col("vec_id") % 50 == 0, 5, rows_per_shard=60, queries_per_block=3).collect()
    clean = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q, v in clean:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in clean if c != q and len(w) == len(v))
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:5])]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert topk.top_k(topk.quantized(df.limit(0)), F.col("vec_id") % 50 == 0).count() == 0


# --- pages ------------------------------------------------------------------


def test_page_text(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = html.train(pages)
    rows = {r["page_id"]: r["text"] for r in html.main_text(pages, model).collect()}
    for r in pages.collect():
        blocks = html.leaves(r["html"])
        want = "\n\n".join(b.text for b, k in zip(blocks, html.semantic_labels(blocks)) if k)
        assert rows[r["page_id"]] == want
    odd = spark.createDataFrame([(1, "u", None, "x"), (2, "u", "", "x"), (3, "u", "<p", "x"), (4, "u", "<script>var a='<p>x</p>'</script><!-- <p>y</p>", "x"), (5, None, "<article>" + "<p>some words of a story here.</p>" * 3000 + "</article>", "x")], "page_id long, url string, html string, text string")
    text = {r["page_id"]: r["text"] for r in html.main_text(odd, model).collect()}
    assert text[1] == text[2] == text[4] == "" and text[5].count("\n\n") == 2999
    assert html.main_text(odd.limit(0), html.train(odd.limit(0))).count() == 0


def test_labeller_learns_from_rare_semantic_pages(spark, monkeypatch):
    """Pages with tags are found among many without, also among false ones."""
    plain = [(i, f"u{i}", f"<div class=menu>home</div><div><p>words {i} of a page</p></div><!-- <article> -->" if i % 2 else f"<div>plain {i}</div>") for i in range(3000)]
    tagged = [(i, f"u{i}", f"<nav>home</nav><ARTICLE\n class=x><p>story {i} told here.</p></article>") for i in range(3000, 3006)]
    rows = spark.createDataFrame(plain + tagged, "page_id long, url string, html string")
    seen = []
    monkeypatch.setattr(html, "fit", lambda pages: seen.append(pages))
    for df in (rows, rows.where("page_id % 2 = 0"), rows.where("page_id >= 3000").withColumn("url", F.lit(None).cast("string")).withColumn("page_id", F.lit(None).cast("long"))):
        html.train(df)
    assert [sum(any(html.semantic_labels(p) or ()) for p in pages) for pages in seen] == [6, 3, 6]
    assert all(len(p) <= html.SAMPLE_PAGES for p in seen)


def test_page_text_without_semantic_pages(spark):
    rows = spark.createDataFrame([(1, "u", "<div class=menu>home</div><div><p>first</p><p>second</p></div><div id=footer>legal</div>"), (2, "u", "<main></main>")], "page_id long, url string, html string")
    model = html.train(rows)
    assert model is None
    assert {r["page_id"]: r["text"] for r in html.main_text(rows, model).collect()} == {1: "first\n\nsecond", 2: ""}


def test_page_blocks():
    page = "<div>a &lt;b&gt; &amp;amp; <b>c</b><br>d\n e<ul><li>f<li>g</ul><a href='x>y'>h</a> 1 < 2</div><STYLE>p{}</style>i"
    assert [b.text for b in html.leaves(page)] == ["a <b> &amp; c d e", "f", "g", "h 1 < 2", "i"]


def test_raw_elements():
    def texts(page):
        return [b.text for b in html.leaves(page)]

    assert texts("<p>a <svg width='1'/> b</p><p>c <svg><text>x</text></svg>d</p>") == ["a b", "c d"]
    assert texts("<p>a<svg id=x/>y</svg> b</p>") == ["a b"] and texts("<p>a <svg/>b</p>") == ["a b"]
    assert texts("<article><p>so <math/>E = <math display='block'><mi>m</mi><msup><mi>c</mi></msup></math> holds</p></article>") == ["so E = mc holds"]
    assert texts("<p>a</p><video controls><p>b</p><object>c<p>d</p>") == ["a", "b", "c", "d"]
    assert texts("<p>a</p><script>b <p>c</p>") == ["a"]
    assert len(texts("<canvas><p>a</p>" * 100_000)) == 100_000


def test_deep_pages_stay_linear():
    began = time.time()
    assert len(html.leaves("<div class=a><p>x</p>" * 100_000)) == 100_000
    assert len(html.leaves("<div>" * 50_000 + "<li>x</li></dd><dt>" * 50_000)) == 50_000
    assert time.time() - began < 20
    page = "<ul class=b><li class=a>x<div class=a>y</div><li>z</ul><dl><dt>k<dd>v</dl>w"
    assert [b.path for b in html.leaves(page)] == [("ul", ".b", "li", ".a"), ("ul", ".b", "li", ".a", "div"), ("ul", ".b", "li"), ("dl", "dt"), ("dl", "dt", "dd"), ()]


def test_new_layouts():
    """Pages without semantic tags, laid out in ways not trained on."""
    import pandas as pd

    blocks = [html.leaves(h) for h in pd.read_parquet("/root/testdata/sf0.01/pages.parquet")["html"][:120]]
    model = html.fit(blocks[:80])
    rng = np.random.default_rng(77)
    wrong = total = 0
    for page in blocks[80:]:
        article = [b.text for b, k in zip(page, html.semantic_labels(page)) if k]
        laid, labels = html.new_layout(article, [b.text for p in blocks[80:] for b in p], rng)
        wrong += int(((html.label(model, [laid])[0] >= 0.5) != np.array(labels)).sum())
        total += len(labels)
    assert wrong < 0.05 * total


def test_lstm_gradient():
    rng = np.random.default_rng(0)
    model = html.BiLstm(rng)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask = rng.standard_normal((2, 4, html.INPUT)), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool)
    y = np.array([[1, 0, 1, 0], [0, 1, 0, 0]], float)

    def loss():
        p = model.predict(x, mask)
        return -float((np.where(mask, y * np.log(p) + (1 - y) * np.log(1 - p), 0)).sum() / mask.sum())

    grads = model.gradients(x, mask, y)
    for name, at in (("forth", (3, 5)), ("back", (html.INPUT + 2, 40)), ("forth", (-1, 20)), ("out", (7,))):
        old = model.p[name][at]
        model.p[name][at] = old + 1e-3
        up = loss()
        model.p[name][at] = old - 1e-3
        down = loss()
        model.p[name][at] = old
        assert math.isclose((up - down) / 2e-3, float(grads[name][at]), rel_tol=0.05, abs_tol=1e-4)
