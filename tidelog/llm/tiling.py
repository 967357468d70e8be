"""Benchmark decontamination by greedy string tiling.

1. Seeds, runs of ``seed`` tokens of the benchmark items, go into a bitmap of
   fixed size. Documents look their own runs up in it and keep, beside the seeds
   met, only the tokens that lie in one.
2. Joining an item's rarest seeds exactly gives pairs of documents and items. A
   pair goes on if it shares as many seeds as the coverage asked for cannot do without.
3. Each pair is tiled: the longest common unmarked runs are marked again and
   again, found by running Karp-Rabin. Tiles do not overlap and may lie in any
   order, so reordered passages count. Coverage is the share of the item's
   tokens in tiles of at least ``seed`` tokens.

Tokens are lower-case runs of letters, marks and digits; in scripts written without
spaces (Chinese, Japanese, Thai and others) each letter is one. Defined results: null and empty
texts have no token and match nothing; an item of fewer than ``seed`` tokens is
too short to be told from chance and matches nothing; rows with null ids are left
out. Repeated rows of an id are tiled one by one and the best coverage counts.
Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import map_batches, materialize
from .shingles import mix, ngram_hashes, token_hashes

SEED = 4
COVERAGE = 0.5
#: The bitmap of seeds has 2^25 bits (4 MB) however large the benchmark is.
BITMAP_BITS = 25
#: Length at which the search for matches begins.
FIRST_SEARCH = 20


def _windows(tokens: np.ndarray, marked: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of the unmarked windows of s tokens, and their places."""
    count = len(tokens) - s + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    base = np.uint64(0x9E3779B97F4A7C15)
    powers = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(tokens), base, np.uint64))))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tokens * powers[: len(tokens)], dtype=np.uint64)))
    # Windows are made comparable by lifting each to the power of the last place.
    own = (sums[s:] - sums[:-s]) * powers[: len(sums) - s][::-1]
    taken = np.concatenate(([0], np.cumsum(marked)))
    free = np.flatnonzero(taken[s:] - taken[:-s] == 0)
    return mix(own[free]), free


def _run_starts(item: np.ndarray, text: np.ndarray, in_item: np.ndarray, in_text: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in both where a common unmarked run of s tokens or more begins.

    A pair of places whose predecessors also match lies inside a run, so of a
    repeated word only the ends of either side begin runs: there are about as
    many starts as tokens, not as many as pairs of places."""
    size = max(len(item), len(text))
    # Both sides' windows are lifted alike only if they are equally long.
    (h_item, p_item), (h_text, p_text) = (
        _windows(np.concatenate((x, np.zeros(size - len(x), np.uint64))), np.concatenate((m, np.ones(size - len(m), bool))), s) for x, m in ((item, in_item), (text, in_text))
    )
    order = np.argsort(h_text, kind="stable")
    h_text, p_text = h_text[order], p_text[order]
    first, last = np.searchsorted(h_text, h_item, "left"), np.searchsorted(h_text, h_item, "right")
    starts: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    for p, a, b in zip(p_item[first < last].tolist(), first[first < last].tolist(), last[first < last].tolist()):
        t = p_text[a:b]
        if p and not in_item[p - 1]:
            before = np.maximum(t - 1, 0)
            t = t[(t == 0) | in_text[before] | (text[before] != item[p - 1])]
        starts.append(t)
        owners.append(np.full(len(t), p))
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(starts)


def _run_lengths(item: np.ndarray, text: np.ndarray, in_item: np.ndarray, in_text: np.ndarray, p: np.ndarray, t: np.ndarray) -> np.ndarray:
    """How far the runs that begin at p and t go, token by token, all in step."""
    length = np.zeros(len(p), np.int64)
    going = np.arange(len(p))
    n = 0
    while len(going):
        at_p, at_t = p[going] + n, t[going] + n
        inside = (at_p < len(item)) & (at_t < len(text))
        going, at_p, at_t = going[inside], at_p[inside], at_t[inside]
        same = (item[at_p] == text[at_t]) & ~in_item[at_p] & ~in_text[at_t]
        going = going[same]
        n += 1
        length[going] = n
    return length


def tile(item: np.ndarray, text: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """(place in item, place in text, length) of the tiles, longest first."""
    tiles: list[tuple[int, int, int]] = []
    in_item, in_text = np.zeros(len(item), bool), np.zeros(len(text), bool)
    s = max(least, FIRST_SEARCH)
    while True:
        p, t = _run_starts(item, text, in_item, in_text, s)
        lengths = _run_lengths(item, text, in_item, in_text, p, t)
        longest = int(lengths.max(initial=0))
        if longest > 2 * s:
            s = longest
            continue
        order = np.lexsort((t, p, -lengths))
        p, t, lengths = (x[order][: np.count_nonzero(lengths >= s)] for x in (p, t, lengths))
        again = False  # whether a tile cut a run so that s tokens or more of it may be left
        while len(lengths) and not again:
            n = int(lengths[0])
            k = np.count_nonzero(lengths == n)
            one, two, p, t, lengths = p[:k], t[:k], p[k:], t[k:], lengths[k:]
            sums_item, sums_text = (np.concatenate(([0], np.cumsum(m))) for m in (in_item, in_text))
            cut = np.maximum(sums_item[one + n] - sums_item[one], sums_text[two + n] - sums_text[two])
            while True:
                again = again or bool(np.any((cut > 0) & (n - cut >= s)))
                one, two = one[cut == 0], two[cut == 0]
                if not len(one):
                    break
                a, b = int(one[0]), int(two[0])
                in_item[a : a + n] = in_text[b : b + n] = True
                tiles.append((a, b, n))
                one, two = one[1:], two[1:]
                cut = np.maximum(np.maximum(n - np.abs(one - a), n - np.abs(two - b)), 0)
        if again:
            continue
        if s <= least:
            return tiles
        s = max(least, s // 2)


def _items(benchmark: DataFrame, seed: int, coverage: float) -> DataFrame:
    """item_id, tokens, n, needed (seeds that a covered item must share), seeds."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], [], []]
        for item_id, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
            tokens = token_hashes(text) if text and item_id is not None else np.zeros(0, np.uint64)
            if len(tokens) >= seed:
                every = ngram_hashes(tokens, seed)
                seeds = np.unique(every)
                # c covered tokens in tiles of seed or more have c / seed runs; repeats may hide some.
                needed = math.ceil(coverage * len(tokens) / seed) if len(seeds) == len(every) else 1
                for column, value in zip(out, (item_id, tokens.tobytes(), len(tokens), needed, seeds.view(np.int64).tolist())):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32()), pa.array(out[4], pa.list_(pa.int64()))], names=["item_id", "tokens", "n_tokens", "needed", "seeds"])

    return map_batches(benchmark.select(F.col("item_id").cast("long"), "text"), run, "item_id long, tokens binary, n_tokens int, needed int, seeds array<long>")


def _met(documents: DataFrame, bitmap: np.ndarray, seed: int) -> DataFrame:
    """Documents that meet the bitmap: doc_id, row (names the row of a repeated
    id), seeds, and tokens and places of what lies in a seed."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], [], []]
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if not text or doc_id is None:
                continue
            tokens = token_hashes(text)
            every = ngram_hashes(tokens, seed)
            bit = every & np.uint64((1 << BITMAP_BITS) - 1)
            at = np.flatnonzero((bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1)
            if not len(at):
                continue
            inside = np.zeros(len(tokens), bool)
            for i in range(seed):
                inside[at + i] = True
            places = np.flatnonzero(inside)
            kept = tokens[places]
            row = int(mix(np.array([np.bitwise_xor.reduce(mix(kept + places.astype(np.uint64)))]))[0] >> np.uint64(1))
            for column, value in zip(out, (doc_id, row, np.unique(every[at]).view(np.int64).tolist(), kept.tobytes(), places.astype("<i8").tobytes())):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.binary()), pa.array(out[4], pa.binary())], names=["doc_id", "row", "seeds", "tokens", "places"])

    return map_batches(documents.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, row long, seeds array<long>, tokens binary, places binary")


def contaminated(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED) -> DataFrame:
    """doc_id, item_id, coverage, tiles for every pair of coverage or more; tiles
    are (item_at, text_at, length) in tokens."""
    items = materialize(_items(benchmark, seed, coverage))
    seeds = items.select(F.explode("seeds").alias("seed"))
    # One binary of 4 KB for each 2^15 bits: 4 MB in all, whatever the benchmark's size.
    bit = F.col("seed").bitwiseAND((1 << BITMAP_BITS) - 1) + 1
    words = seeds.groupBy(F.bitmap_bucket_number(bit).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for r in words.collect():
        bitmap[(r["at"] - 1) * len(r["bits"]) : r["at"] * len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    met = materialize(_met(documents, bitmap, seed))
    asked = met.select("doc_id", "row", F.explode("seeds").alias("seed"))
    # Who shares n of an item's m seeds shares one of its m - n + 1 rarest: common seeds make no pairs.
    often = asked.groupBy("seed").agg(F.count(F.lit(1)).alias("often"))
    by_rarity = Window.partitionBy("item_id", "tokens").orderBy(F.coalesce("often", F.lit(0)), "seed")
    spread = items.select("item_id", "tokens", "needed", F.size("seeds").alias("m"), F.explode("seeds").alias("seed")).join(often, "seed", "left")
    rare = spread.withColumn("place", F.row_number().over(by_rarity)).where("often > 0 and place <= m - needed + 1").select("item_id", "seed")
    pairs = materialize(asked.join(rare, "seed").select("doc_id", "row", "item_id").distinct())
    held = items.select("item_id", F.col("tokens").alias("item_tokens"), F.col("seeds").alias("item_seeds"), "needed")
    both = pairs.join(met.select("doc_id", "row", "seeds", "tokens", "places"), ["doc_id", "row"]).join(held, "item_id")
    full = both.where(F.size(F.array_intersect("seeds", "item_seeds")) >= F.col("needed"))
    kind = pa.list_(pa.struct([("item_at", pa.int32()), ("text_at", pa.int32()), ("length", pa.int32())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], []]
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "item_id", "tokens", "places", "item_tokens"))
        for doc_id, item_id, tokens, places, item in zip(*columns):
            own, at = np.frombuffer(tokens, np.uint64), np.frombuffer(places, "<i8")
            # A gap in the text is a token that equals none.
            gaps = np.flatnonzero(np.diff(at) > 1) + 1
            own, at = np.insert(own, gaps, np.uint64(0)), np.insert(at, gaps, -1)
            wanted = np.frombuffer(item, np.uint64)
            tiles = tile(wanted, own, seed)
            share = sum(n for *_, n in tiles) / len(wanted)
            if share >= coverage:
                for column, value in zip(out, (doc_id, item_id, share, [{"item_at": p, "text_at": int(at[t]), "length": n} for p, t, n in tiles])):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64()), pa.array(out[3], kind)], names=["doc_id", "item_id", "coverage", "tiles"])

    tiled = map_batches(full.select("doc_id", "item_id", "tokens", "places", "item_tokens"), run, "doc_id long, item_id long, coverage double, tiles array<struct<item_at:int,text_at:int,length:int>>")
    return tiled.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "tiles")).alias("b")).select("doc_id", "item_id", "b.coverage", "b.tiles")
