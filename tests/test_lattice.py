"""Lattice segmentation against all ways to cut a run."""

import math
import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.operators import keywords, lattice


def brute(run, dictionary):
    """The cheapest of all ways to cut ``run``; of equal ones the one whose last words
    are longer, looked at from the end."""
    total = sum(dictionary.values())
    unknown = math.floor(1000 * math.log(total) + 0.5) + lattice.UNKNOWN
    best = None
    for mask in range(1 << (len(run) - 1)):
        pieces, last = [], 0
        for i in range(1, len(run) + 1):
            if i == len(run) or mask >> (i - 1) & 1:
                pieces.append(run[last:i])
                last = i
        if any(p not in dictionary and len(p) > 1 for p in pieces):
            continue
        cost = sum(math.floor(1000 * math.log(total / dictionary[p]) + 0.5) if p in dictionary else unknown for p in pieces)
        key = (cost, [-len(p) for p in reversed(pieces)], pieces)
        best = key if best is None or key < best else best
    words, open_one = [], False
    for p in best[2]:
        if p not in dictionary and open_one:
            words[-1] += p
        else:
            words.append(p)
        open_one = p not in dictionary
    return words


def test_random_runs_against_brute_force():
    rng = random.Random(11)
    for _ in range(150):
        letters = rng.choice(["ab", "abc", "天气公园", "a\U0001f600é1"])
        dictionary = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))): rng.choice([1, 1, 2, 7, 100]) for _ in range(rng.randrange(1, 9))}
        runs = ["".join(rng.choice(letters + "z") for _ in range(rng.randrange(1, 11))) for _ in range(8)]
        assert lattice.Lattice(dictionary.items()).segment(runs) == [brute(r, dictionary) for r in runs], (dictionary, runs)


def test_best_path_beats_the_longest_first_word():
    words = {"研究": 50, "研究生": 20, "生命": 40, "命": 1, "起源": 30}
    assert lattice.Lattice(words.items()).segment(["研究生命起源"]) == [["研究", "生命", "起源"]]


def test_parts_do_not_change_the_result(monkeypatch):
    rng = random.Random(3)
    words = {"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 5))): rng.randrange(1, 50) for _ in range(40)}
    runs = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 40))) for _ in range(200)]
    whole = lattice.Lattice(words.items()).segment(runs)
    monkeypatch.setattr(lattice, "LETTERS_AT_ONCE", 25)
    assert lattice.Lattice(words.items()).segment(runs) == whole


def test_large_dictionary_and_long_runs():
    rng = random.Random(5)
    words = {}
    while len(words) < 100_000:
        words["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))] = rng.randrange(1, 1000)
    listed = list(words)
    cut = lattice.Lattice(words.items())
    run = "".join(rng.choice(listed) for _ in range(20_000))
    began = time.time()
    found = cut.segment([run, "Z" * 50_000])
    assert time.time() - began < 20
    assert "".join(found[0]) == run and found[1] == ["Z" * 50_000]
    short = [rng.choice(listed) + rng.choice(listed)[:3] for _ in range(5)]
    near = {run[i:j]: words[run[i:j]] for run in short for i in range(len(run)) for j in range(i + 1, len(run) + 1) if run[i:j] in words}
    total = sum(words.values())
    monkey = dict(near, **{"#" * 9: total - sum(near.values())})  # the same total
    assert cut.segment(short) == [brute(r, monkey) for r in short]


def test_dictionaries_without_words_and_odd_entries():
    assert lattice.Lattice([]).segment(["abc"]) == [["abc"]]
    assert lattice.Lattice([("", 3), (None, 2), ("ab", 0), ("b", None), ("ab", 2), ("ab", 3)]).segment(["xabab"]) == [["x", "ab", "ab"]]
    assert lattice.Lattice([("a", 1)]).segment([]) == []


def test_too_many_words_are_refused(monkeypatch):
    monkeypatch.setattr(lattice, "MAX_WORDS", 2)
    with pytest.raises(ValueError):
        lattice.Lattice([("a", 1), ("b", 1), ("c", 1)])


def test_segmenter_of_columns(spark):
    df = spark.createDataFrame([(1, "今天天气很好, 公园 ok"), (2, None), (3, ""), (4, "--"), (5, "今天天气很好, 公园 ok")], "i int, t string")
    segmenter = lattice.lattice_segmenter([("今天", 9), ("天天", 2), ("天气", 9), ("公园", 3), ("很", 5)])
    out = {r["i"]: r["s"] for r in df.select("i", segmenter(F.col("t")).alias("s")).collect()}
    assert out == {1: ["今天", "天气", "很", "好", "公园", "ok"], 2: None, 3: [], 4: [], 5: out[1]}
    recs = spark.createDataFrame([({"title": "今天天气很好"},), ({"x": "y"},)], "event map<string,string>")
    done = keywords.add_title_keywords(recs, segmenter=segmenter).collect()
    assert [r["event"].get("keyword") for r in done] == ["今天 天气", None]


def test_counted_dictionary(spark):
    df = spark.createDataFrame([("ab ab cde f",), (None,), ("cde, ab xy",), ("abcdefg",)], "t string")
    assert lattice.count_dictionary(df, "t", 2, 6, 2) == [("ab", 3), ("cde", 2)]


def test_runs_become_python_strings_some_at_a_time(spark, monkeypatch):
    seen = []
    segment = lattice.Lattice.segment
    monkeypatch.setattr(lattice.Lattice, "segment", lambda self, runs: seen.append(len(runs)) or segment(self, runs))
    monkeypatch.setattr(lattice.F, "arrow_udf", lambda cut, kind: seen.append(cut))
    monkeypatch.setattr(lattice, "RUNS_AT_ONCE", 2, raising=False)
    monkeypatch.setattr(lattice, "ROWS_AT_ONCE", 4, raising=False)
    lattice.lattice_segmenter([("ab", 3), ("cd", 2)])
    batch = pa.array([["no"], ["abcd", "x1"], None, [], ["cdab", "abcd", "x1"], ["x1"]], pa.list_(pa.string())).slice(1)
    got = seen.pop(0)(batch)
    assert got.to_pylist() == [["ab", "cd", "x1"], None, [], ["cd", "ab", "ab", "cd", "x1"], ["x1"]]
    assert seen == [2, 1, 1]
