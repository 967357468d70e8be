"""Hard negatives from anchor-clustered shared lists.

Anchors that point the same way are one cluster and share one list: the
candidates, sorted once by an upper bound that holds for every member,

    |x| * cos(max(0, angle(x, centre) - widest angle of a member)),

and every member walks that list from the top until what is left cannot change
its answer: the bound times its own length is below all it still looks for.

On Spark: rows are dealt to pivots (nearest direction, from a bounded sample) and,
within a pivot, into shards of bounded size. A block of a cluster's anchors meets a
shard only if the same bound, between the pivots' cones, reaches what the block
looks for. Two walks: the first finds positives (a block's own pivot comes first,
and what it finds is where the walk over other shards starts), the second negatives
in the window that each positive's score sets.

Equal vectors of one label are one anchor and one candidate, with their smallest
ids: a vector that a third of all rows share costs one row. No answer changes, as
of equal scores the smaller ids come first.

Components are floor(256 * x), x as double; scores are exact integers (as long as
they fit a long). Defined results: rows with a null label, id or vector, or a null
or non-finite component take no part. Rows equal in id, label and vector count once;
rows of one id with other vectors or labels are rows of their own. Only vectors of
an anchor's length are its candidates; empty vectors score 0. An anchor without
positives, or a positive without negatives, gives no row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize

SCALE = 256
ROWS_PER_SHARD = 4096
ANCHORS_PER_BLOCK = 512
#: The pivots of a vector length, and the sample that they are chosen from.
MAX_PIVOTS = 128
SAMPLE = 4096
#: Vector lengths with pivots of their own; rows of further ones share one pivot.
MAX_LENGTHS = 16
#: Candidates scored at a time during a walk.
STEP = 256

#: Scores that every score is above, or below.
LOWEST, HIGHEST = -(1 << 62), 1 << 62

FOUND = "anchor string, wanted long, score long, ids array<long>, alike boolean"


def labelled(vectors: DataFrame, label: Column, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, label, v (array of long) of the rows that take part."""
    x = F.col(vector_column)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.lit(SCALE) * c.cast("double")))
    kept = vectors.where(F.col(id_column).isNotNull() & label.isNotNull() & x.isNotNull() & finite)
    return kept.select(F.col(id_column).cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("v")).distinct()


@dataclass(frozen=True)
class Pivots:
    """Unit directions for each vector length."""

    of: dict[int, np.ndarray]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pivot of each row, and the angle to it."""
        directions = self.of.get(points.shape[1])
        if directions is None:
            return np.full(len(points), -1), np.full(len(points), np.pi)
        cosine = _unit(points) @ directions.T
        best = cosine.argmax(1)
        return best, _angle(cosine[np.arange(len(points)), best])

    def between(self, length: int, a: int, b: int) -> float:
        if a < 0 or b < 0:
            return 0.0
        return float(_angle(self.of[length][a] @ self.of[length][b]))


def _unit(points: np.ndarray) -> np.ndarray:
    norms = np.sqrt((points**2).sum(1))[:, None]
    return points / np.where(norms > 0, norms, 1)


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def _stacked(values) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.int64) for v in values], dtype=np.int64).reshape(len(values), len(values[0]) if len(values) else 0)


def choose_pivots(rows: DataFrame, lengths: dict[int, int], rows_per_shard: int) -> Pivots:
    """Directions by a few rounds of spherical k-means on at most ``SAMPLE`` rows
    (those of the smallest hashes) of each of the commonest lengths."""
    found: dict[int, np.ndarray] = {}
    for length in sorted(lengths, key=lambda d: (-lengths[d], d))[:MAX_LENGTHS]:
        k = min(MAX_PIVOTS, -(-lengths[length] // rows_per_shard))
        if not length or k < 1:
            continue
        sample = [r["v"] for r in rows.where(F.size("v") == length).orderBy(F.xxhash64("v"), "v").select("v").limit(SAMPLE).collect()]
        points = _unit(_stacked(sample).astype(np.float64))
        centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)]
        for _ in range(8):
            nearest = (points @ centres.T).argmax(1)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, points)
            centres = np.where((np.abs(sums).sum(1) > 0)[:, None], _unit(sums), centres)
        found[length] = centres
    return Pivots(found)


def _with_pivots(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """``rows`` with pivot, angle to it and length (norm)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.assign(pivot=-1, angle=np.pi, norm=0.0)
            for length, group in batch.groupby(batch["v"].map(len)):
                if length:
                    points = _stacked(group["v"].to_list()).astype(np.float64)
                    pivot, angle = pivots.nearest(points)
                    out.loc[group.index, "pivot"] = pivot
                    out.loc[group.index, "angle"] = angle
                    out.loc[group.index, "norm"] = np.sqrt((points**2).sum(1))
            yield out

    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return rows.mapInPandas(run, f"{kinds}, pivot int, angle double, norm double")


@dataclass
class Lists:
    """A shard's candidates in the order of a cluster's upper bound."""

    vectors: np.ndarray
    labels: np.ndarray
    ids: list
    bounds: np.ndarray

    @staticmethod
    def of(members: np.ndarray, held: pd.DataFrame) -> "Lists":
        vectors = _stacked(held["v"].to_list())
        points = vectors.astype(np.float64)
        centre = _unit(_unit(members.astype(np.float64)).sum(0)[None, :])[0] if members.shape[1] else np.zeros(0)
        if not np.any(centre):  # members cancel out: no common direction
            wide, angles = np.pi, np.zeros(len(points))
        else:
            wide = float(_angle(_unit(members.astype(np.float64)) @ centre).max())
            angles = _angle(_unit(points) @ centre)
        norms = np.sqrt((points**2).sum(1))
        bounds = norms * np.cos(np.maximum(0.0, angles - wide - 1e-7))
        order = np.argsort(-bounds, kind="stable")
        ids = held["ids"].to_list()
        return Lists(vectors[order], held["label"].to_numpy(np.int64)[order], [ids[i] for i in order], bounds[order])


def _scores(asking: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Exact inner products; doubles are exact while sums stay below 2^53."""
    if not asking.size or not held.size:
        return np.zeros((len(asking), len(held)), np.int64)
    if float(np.abs(asking).max()) * float(np.abs(held).max()) * asking.shape[1] < 2.0**52:
        return np.rint(asking.astype(np.float64) @ held.T.astype(np.float64)).astype(np.int64)
    return asking @ held.T


class Best:
    """The first k rows of a search: higher scores first, then smaller ids.
    Candidates of one vector come with all of their smallest ids."""

    def __init__(self, k: int, least: float, most: float) -> None:
        self.k, self.least, self.most = k, least, most
        self.scores, self.place = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, places: np.ndarray, first: np.ndarray) -> None:
        s, p, f = (np.concatenate(x) for x in ((self.scores, scores), (self.place, places), (self.first, first)))
        order = np.lexsort((f, -s))[: self.k]
        self.scores, self.place, self.first = s[order], p[order], f[order]
        if len(order) == self.k:
            self.least = max(self.least, float(self.scores[-1]))


def walk(lists: Lists, members: np.ndarray, searches: list[list[Best]], fits) -> None:
    """Every member goes down the shared list for all of its searches, until the
    bound is below what any of them still takes. ``fits(member, labels)`` says
    which candidates it may take."""
    lengths = np.sqrt((members.astype(np.float64) ** 2).sum(1))
    first = np.array([i[0] for i in lists.ids], dtype=np.int64)
    open_members = np.arange(len(members))
    for at in range(0, len(lists.bounds), STEP):
        above = lists.bounds[at] * lengths
        above = above + 1e-9 * np.abs(above) + 1e-6  # rounding
        open_members = np.array([m for m in open_members if any(above[m] >= s.least for s in searches[m])], dtype=np.int64)
        if not len(open_members):
            return
        part = slice(at, at + STEP)
        scores = _scores(members[open_members], lists.vectors[part])
        for m, own in zip(open_members, scores):
            allowed = fits(m, lists.labels[part])
            for search in searches[m]:
                good = np.flatnonzero(allowed & (own >= search.least) & (own <= search.most))
                if len(good):
                    search.offer(own[good], good + at, first[part][good])


def _walked(asked: DataFrame, held: DataFrame, keys: list[str], k: int, same_label: bool) -> DataFrame:
    """asked: keys, anchor, label, v, and as arrays the windows' wanted, least, most;
    held: keys, label, v, ids. For every window the shard's first k candidates."""

    def run(_: tuple, members: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(members) and len(candidates):
            own = _stacked(members["v"].to_list())
            labels = members["label"].to_numpy(np.int64)
            lists = Lists.of(own, candidates)
            windows = [list(zip(*w)) for w in zip(members["wanted"], members["least"], members["most"])]
            searches = [[Best(k, float(least), float(most)) for _, least, most in ws] for ws in windows]
            walk(lists, own, searches, lambda m, those: (those == labels[m]) == same_label)
            for m, (anchor, ws, found) in enumerate(zip(members["anchor"], windows, searches)):
                for (wanted, _, _), best in zip(ws, found):
                    out += [(anchor, int(wanted), int(s), list(lists.ids[p]), same_label and bool((lists.vectors[p] == own[m]).all())) for s, p in zip(best.scores, best.place)]
        return pd.DataFrame(out, columns=["anchor", "wanted", "score", "ids", "alike"])

    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(run, FOUND)


def _each(found: DataFrame) -> DataFrame:
    return found.select("anchor", "wanted", "score", "alike", F.explode("ids").alias("vec_id"))


def _first(each: DataFrame, k: int) -> DataFrame:
    """The first k rows of every search."""
    order = Window.partitionBy("anchor", "wanted").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _window(wanted: Column, least: Column, most: Column) -> dict[str, Column]:
    return {"wanted": F.array(wanted.cast("long")), "least": F.array(least.cast("long")), "most": F.array(most.cast("long"))}


def _routed(searching: DataFrame, cones: DataFrame, pivots: Pivots) -> DataFrame:
    """The (block, shard) pairs that the bound between two pivots' cones does not
    rule out. It is worked out for blocks and pivots, of which a vector length has
    at most MAX_PIVOTS, not for shards or rows."""
    # What one unit of a member's length must reach, at least.
    need = F.coalesce(F.array_min("least"), F.lit(HIGHEST)).cast("double")
    per_unit = F.when(F.col("norm") > 0, need / F.col("norm")).when(need > 0, float("inf")).otherwise(float("-inf"))
    wide = searching.groupBy("d", "own", "block").agg(F.max("angle").alias("member_wide"), F.min(per_unit).alias("need"))

    def reached(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            between = np.array([pivots.between(d, o, p) for d, o, p in zip(b["d"], b["own"], b["pivot"])], dtype=np.float64)
            gap = np.maximum(0.0, between - b["member_wide"].to_numpy() - b["wide"].to_numpy() - 1e-7)
            # Beyond a right angle no product is positive, whatever the length.
            reach = b["longest"].to_numpy() * np.cos(np.minimum(gap, np.pi / 2))
            yield b[reach + 1e-9 * reach + 1e-6 >= b["need"].to_numpy()][["d", "own", "block", "pivot", "shards"]]

    met = wide.join(cones, "d").mapInPandas(reached, "d int, own int, block int, pivot int, shards int")
    return met.select("d", "own", "block", "pivot", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    rows_per_shard: int = ROWS_PER_SHARD, anchors_per_block: int = ANCHORS_PER_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: (vec_id, label, v) of :func:`labelled`; ``is_anchor`` is a condition
    on vec_id. An anchor's positives are its first other rows of its label; a
    positive's negatives the first rows of other labels whose score is between
    ``low`` and ``high`` hundredths of the positive's score.
    """
    name = F.md5(F.concat_ws(",", F.col("label").cast("string"), F.col("v").cast("array<string>")))
    rows = materialize(rows.withColumn("name", name))
    # One row for equal vectors of a label: the smallest ids, one more than are asked for.
    by_id = Window.partitionBy("name").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= max(positives, negatives) + 1)
    merged = materialize(few.groupBy("name").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.array_sort(F.collect_list("vec_id")).alias("ids")))
    counted = merged.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    lengths = {r["d"]: r["n"] for r in counted.orderBy(F.desc("n"), "d").limit(MAX_LENGTHS).collect()}
    pivots = choose_pivots(merged, lengths, rows_per_shard)

    placed = materialize(_with_pivots(merged, pivots).withColumn("d", F.size("v")))
    cones = placed.groupBy("d", "pivot").agg(F.max("angle").alias("wide"), F.max("norm").alias("longest"), F.count(F.lit(1)).alias("n"))
    cones = materialize(cones.withColumn("shards", F.ceil(F.col("n") / rows_per_shard).cast("int")).drop("n"))
    with_shards = placed.join(cones.select("d", "pivot", "shards"), ["d", "pivot"])
    part = F.pmod(F.xxhash64("name"), F.col("shards")).cast("int")
    shards = materialize(with_shards.select("d", "pivot", part.alias("shard"), "label", "v", "ids"))

    anchors = materialize(rows.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), F.col("name").alias("anchor")))
    members = materialize(with_shards.join(anchors.select(F.col("anchor").alias("name")).distinct(), "name"))
    blocks = members.groupBy("d", "pivot").agg(F.ceil(F.count(F.lit(1)) / anchors_per_block).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64(F.lit("block"), "name"), F.col("blocks")).cast("int")
    asked = members.join(blocks, ["d", "pivot"])
    # The shard with the member's own row is where its search begins.
    asked = materialize(asked.select("d", F.col("pivot").alias("own"), block.alias("block"), part.alias("home"), F.col("name").alias("anchor"), "label", "v", "angle", "norm"))
    grid = ["d", "own", "block", "pivot", "shard"]

    def search(searching: DataFrame, pairs: DataFrame, k: int, same_label: bool) -> DataFrame:
        pairs = materialize(pairs)
        ask = searching.join(pairs, ["d", "own", "block"])
        held = shards.join(pairs, ["d", "pivot", "shard"])
        return _each(_walked(ask.select(*grid, "anchor", "label", "v", "wanted", "least", "most"), held.select(*grid, "label", "v", "ids"), grid, k, same_label))

    # One more than asked for, as the anchor's own row is among them.
    k = positives + 1
    at_home = materialize(asked.select("d", "own", "block", F.col("own").alias("pivot"), F.col("home").alias("shard")).distinct())
    near = materialize(_first(search(asked.withColumns(_window(F.lit(0), F.lit(LOWEST), F.lit(HIGHEST))), at_home, k, True), k).drop("place"))
    kth = near.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).where(F.col("n") == k).drop("n")
    told = materialize(asked.join(kth, "anchor", "left").withColumns(_window(F.lit(0), F.coalesce("kth", F.lit(LOWEST)), F.lit(HIGHEST))))
    elsewhere = _routed(told, cones, pivots).join(at_home, grid, "left_anti")
    best = materialize(_first(near.unionByName(search(told, elsewhere, k, True)), k))

    # Windows that positives' scores set; equal scores share one.
    scores = best.where("score >= 0").groupBy("anchor").agg(F.array_sort(F.collect_set("score")).alias("wanted"))
    windows = {"least": F.transform("wanted", lambda p: F.ceil(p * low / 100).cast("long")), "most": F.transform("wanted", lambda p: F.floor(p * high / 100).cast("long"))}
    wanted = materialize(asked.join(scores, "anchor").withColumns(windows))
    hard = _first(search(wanted, _routed(wanted, cones, pivots), negatives, False), negatives)
    given = materialize(hard.select("anchor", F.col("wanted").alias("positive_score"), F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")))

    order = Window.partitionBy("anchor_id", "anchor").orderBy(F.desc("score"), "vec_id")
    others = anchors.join(best, "anchor").where(~(F.col("alike") & (F.col("vec_id") == F.col("anchor_id"))))
    chosen = others.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    pairs = chosen.select("anchor_id", "anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(given, ["anchor", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
