"""Exact top-k by inner product: ball trees with branch and bound.

Vectors are dealt into shards of bounded size; each shard builds a ball tree
(nodes with a centre and a radius). A query visits a shard's leaves in the order
of the upper bound q.c + |q| r and stops where the bound falls below its current
kth score. That score is shared: every query first searches one shard, and the
kth score found there is where its search of all other shards starts. Queries
are a stated set; they meet shards in blocks of bounded size.

Components are floor(256 * x), x as double; scores are exact integers (as long
as they fit a long). Defined results: vectors that are null, or hold null or
non-finite components, take no part as query or candidate, nor do rows with a
null id. Only vectors of the query's length are its candidates; an empty vector
scores 0. Rows equal in id and vector count once; rows of one id with different
vectors are several queries and candidates, and a candidate of the query's own
id is left out. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize

SCALE = 256
ROWS_PER_SHARD = 4096
QUERIES_PER_BLOCK = 2048
ROWS_PER_LEAF = 128
RESULT = "query_id long, q_hash long, vec_id long, score long"


def quantized(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, v (array of long) of the vectors that take part."""
    x = F.col(vector_column)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return (
        vectors.where(x.isNotNull() & finite & F.col(id_column).isNotNull())
        .select(F.col(id_column).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(F.lit(SCALE) * c.cast("double"))).alias("v"))
        .distinct()
    )


class BallTree:
    """A balanced tree over the rows of ``points``: level by level, each node
    is halved along the direction between two far points."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        depth = max(0, int(np.ceil(np.log2(max(1, len(points)) / ROWS_PER_LEAF))))
        groups = [np.arange(len(points))]
        self.levels = [self._balls(groups)]
        for _ in range(depth):
            groups = [half for g in groups for half in self._halves(g)]
            self.levels.append(self._balls(groups))
        self.leaves = groups

    def _halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.points[rows]
        far = p[((p - p.mean(0)) ** 2).sum(1).argmax()] if len(rows) else 0
        other = p[((p - far) ** 2).sum(1).argmax()] if len(rows) else 0
        order = np.argsort(p @ (other - far), kind="stable") if len(rows) else rows
        half = len(rows) // 2
        return rows[order[:half]], rows[order[half:]]

    def _balls(self, groups: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        centres = np.stack([self.points[g].mean(0) if len(g) else np.zeros(self.points.shape[1]) for g in groups])
        radii = np.array([np.sqrt(((self.points[g] - c) ** 2).sum(1).max()) if len(g) else 0.0 for g, c in zip(groups, centres)])
        return centres, radii

    def bounds(self, queries: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Upper bound of the score of every (query, leaf); -inf where a node
        above is already below the query's kth score."""
        norms = np.sqrt((queries**2).sum(1))[:, None]
        above = np.full((len(queries), 1), np.inf)
        for level, (centres, radii) in enumerate(self.levels):
            if level:
                above = np.repeat(above, 2, axis=1)
            own = queries @ centres.T + norms * radii
            own += 1e-9 * (np.abs(own) + norms * (radii + 1)) + 1e-6  # rounding
            above = np.minimum(above, own)
            above = np.where(above < least[:, None], -np.inf, above)
        return above


def search(tree: BallTree, exact: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's place, ids, scores) of what may be among the k best: nothing
    below ``least`` or the query's kth score in this shard."""
    n = len(queries)
    points = queries.astype(np.float64)
    bound = tree.bounds(points, least)
    order = np.argsort(-bound, axis=1, kind="stable")
    kth = least.astype(np.float64)
    best_ids, best_scores = [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n
    for visit in range(order.shape[1]):
        leaf = order[:, visit]
        open_queries = np.flatnonzero(bound[np.arange(n), leaf] >= kth)
        if not len(open_queries):
            break
        for one in np.unique(leaf[open_queries]):
            rows = tree.leaves[one]
            if not len(rows):
                continue
            asking = open_queries[leaf[open_queries] == one]
            scores = queries[asking] @ exact[rows].T
            for q, own in zip(asking, scores):
                good = np.flatnonzero((own >= kth[q]) & (ids[rows] != query_ids[q]))
                if len(good):
                    i, s = np.concatenate((best_ids[q], ids[rows[good]])), np.concatenate((best_scores[q], own[good]))
                    top = np.lexsort((i, -s))[:k]
                    best_ids[q], best_scores[q] = i[top], s[top]
                    if len(top) == k:
                        kth[q] = max(kth[q], s[top[-1]])
    for q in range(n):
        if len(best_ids[q]):
            yield q, best_ids[q], best_scores[q]


def _searched(queries: DataFrame, vectors: DataFrame, keys: list[str], k: int) -> DataFrame:
    """queries: keys, query_id, q_hash, v, least; vectors: shard, vec_id, v."""

    def run(_: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(asked) and len(held):
            exact = np.stack(held["v"].to_numpy()).astype(np.int64)
            tree = BallTree(exact.astype(np.float64))
            own = np.stack(asked["v"].to_numpy()).astype(np.int64)
            least = np.array([-np.inf if x is None or x != x else float(x) for x in asked["least"]])
            ids = asked["query_id"].to_numpy(np.int64)
            for q, i, s in search(tree, exact, held["vec_id"].to_numpy(np.int64), own, ids, least, k):
                out += [(int(ids[q]), int(asked["q_hash"].iloc[q]), int(a), int(b)) for a, b in zip(i, s)]
        return pd.DataFrame(out, columns=["query_id", "q_hash", "vec_id", "score"])

    return queries.groupBy(*keys).cogroup(vectors.groupBy(*keys)).applyInPandas(run, RESULT)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, rows_per_shard: int = ROWS_PER_SHARD, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score. ``vectors``: (vec_id, v) of :func:`quantized`;
    ``is_query`` is a condition on vec_id."""
    vectors = materialize(vectors.withColumn("dim", F.size("v")))
    sizes = {r["dim"]: (r["n"], r["q"]) for r in vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).collect()}
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n_shards = F.create_map(*[F.lit(v) for d, (n, _) in sizes.items() for v in (d, -(-n // rows_per_shard))])
    n_blocks = F.create_map(*[F.lit(v) for d, (_, q) in sizes.items() for v in (d, -(-max(1, q) // queries_per_block))])
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "vec_id", "v"), n_shards[F.col("dim")]).cast("int"))
    asked = materialize(
        vectors.where(is_query).select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("q_hash"), "v", "dim")
        .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "query_id", "v"), n_blocks[F.col("dim")]).cast("int"))
        .withColumn("home", F.pmod(F.xxhash64(F.lit("home"), "query_id", "v"), n_shards[F.col("dim")]).cast("int"))
    )
    grid = ["dim", "shard", "block"]
    copies = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks[F.col("dim")] - 1)))
    first = materialize(_searched(asked.withColumn("least", F.lit(None).cast("long")).withColumn("shard", F.col("home")), copies, grid, k))
    shared = first.groupBy("query_id", "q_hash").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    informed = asked.join(shared, ["query_id", "q_hash"], "left").withColumn("least", F.when(F.col("n") >= k, F.col("kth")))
    others = informed.withColumn("shard", F.explode(F.sequence(F.lit(0), n_shards[F.col("dim")] - 1))).where("shard != home")
    rest = _searched(others.drop("n", "kth"), copies, grid, k)
    best = Window.partitionBy("query_id", "q_hash").orderBy(F.desc("score"), "vec_id")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
