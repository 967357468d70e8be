"""Near-duplicate documents by SetSketch registers.

A document is the set of its word shingles. Register i of its sketch is the
minimum of independent exponential hashes over the set, kept as its truncated
logarithm to a base (an exponentially spaced scale): the sketch of a union is
the register-wise maximum, and equal sets agree in every register. Steps:

1. Documents of one and the same set are one class, named by its smallest id
   (aggregated map-side; the class goes on as one row).
2. Bands of register values put classes into buckets. The number of bands makes
   the chance to miss a pair at the threshold less than ``MISS``.
3. Each class meets the leader (smallest id) of each of its buckets. A pair goes
   on if the maximum-likelihood estimate of the similarity, joint over the
   registers and the known set sizes, is not clearly below the threshold, and
   links if the full sets say so.
4. After components of these links, only buckets that still hold several
   components matter. Their classes meet once more, by an exact prefix filter and
   across components only: no link is lost by meeting leaders first, and neither
   a large group of copies, one component by then, nor a large family of texts
   that are not similar enough makes pairs among its members.

Defined results: null text or text without words has an empty set, size 0, and
is linked with nothing. Rows with null doc_id are returned with a null component.
Rows that share a doc_id count as that one document: what any of its texts is linked
with, it is linked with, and all its rows have one component. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import digest, map_batches, materialize
from .components import connected_components
from .shingles import mix, shingle_set

BASE = 1.02
#: Largest register value; a set would need e^1000 elements to pass it.
LIMIT = (1 << 16) - 2
ROWS_PER_BAND = 5
#: Chance to miss a pair whose similarity is just the threshold.
MISS = 1e-7
#: Standard deviations by which an estimate may fall short of the threshold.
SLACK = 5.0
#: Elements hashed at a time; memory does not grow with the set.
CHUNK = 2048


def bands_for(threshold: float, rows: int = ROWS_PER_BAND, miss: float = MISS) -> int:
    return max(1, math.ceil(math.log(miss) / math.log(1 - threshold**rows)))


def hash_family(m: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20231)
    odd = rng.integers(0, 1 << 32, m, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    return odd[:, None], rng.integers(0, 1 << 32, m, dtype=np.uint64).astype(np.uint32)[:, None]


def registers(elements: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """K_i = floor(1 - log_b(min of Exp(1) hashes)), within 0 and LIMIT. The
    exponential hash rises with the uniform one, so the minimum is taken on the
    32-bit hash and transformed once."""
    odd, shift = family
    least = np.full(len(odd), 0xFFFFFFFF, np.uint32)
    short = (elements >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), CHUNK):
        np.minimum(least, (short[at : at + CHUNK] * odd + shift).min(axis=1), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32)
    return np.clip(np.floor(1 - np.log(exponential) / math.log(BASE)), 0, LIMIT).astype("<u2")


def band_keys(k: np.ndarray, bands: int, rows: int = ROWS_PER_BAND) -> np.ndarray:
    """One 64-bit key per band, of the band's number and its register values."""
    h = mix(np.arange(bands, dtype=np.uint64) + np.uint64(1))
    for column in k.reshape(bands, rows).T:
        h = mix(h * np.uint64(0xA0761D6478BD642F) + column.astype(np.uint64))
    return h.view(np.int64)


def estimate(above: np.ndarray, below: np.ndarray, m: int, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sets of known sizes, from how
    many registers of the first are above and below those of the second."""
    u = (na / (na + nb))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 201)[None, :]
    j = np.minimum(j, np.minimum(u / v, v / u))

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)

    up, down = chance(np.clip(u - v * j, 0, 1)), chance(np.clip(v - u * j, 0, 1))
    tiny = 1e-12
    likelihood = above[:, None] * np.log(up + tiny) + below[:, None] * np.log(down + tiny) + (m - above - below)[:, None] * np.log(np.maximum(1 - up - down, 0) + tiny)
    return np.take_along_axis(j, likelihood.argmax(1)[:, None], 1)[:, 0]


def sketch(documents: DataFrame, threshold: float, shingle: int = 5) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the set; null if empty), registers."""
    m = bands_for(threshold) * ROWS_PER_BAND

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        family = hash_family(m)
        sizes, keys, sketches = [], [], []
        for text in batch.column("text").to_pylist():
            s = shingle_set(text, shingle)
            sizes.append(len(s))
            keys.append(digest(s.tobytes()) if len(s) else None)
            sketches.append(registers(s, family).tobytes() if len(s) else None)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary())], names=["doc_id", "n_shingles", "set_key", "registers"])

    return map_batches(documents.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, n_shingles long, set_key binary, registers binary")


def _plausible(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) that sizes and registers do not rule out."""
    m = bands_for(threshold) * ROWS_PER_BAND
    sides = classes.select(F.col("rep"), F.col("n_shingles").alias("n"), "registers")
    one, two = (sides.toDF(f"{s}_id", f"{s}_n", f"{s}_r") for s in "xy")
    joined = pairs.join(one, F.col("a") == F.col("x_id")).join(two, F.col("b") == F.col("y_id")).where(100 * F.least("x_n", "y_n") >= round(100 * threshold) * F.greatest("x_n", "y_n"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, m) for c in ("x_r", "y_r"))
        na, nb = (np.array(batch.column(c).to_pylist(), dtype=np.float64) for c in ("x_n", "y_n"))
        j = estimate((x > y).sum(1), (x < y).sum(1), m, na, nb)
        keep = j + SLACK * math.sqrt(threshold * (1 - threshold) / m) >= threshold
        return pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"])

    return map_batches(joined.select("a", "b", "x_n", "x_r", "y_n", "y_r"), run, "a long, b long")


def _confirmed(pairs: DataFrame, documents: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """Pairs whose full sets reach the threshold (in hundredths, exact)."""
    involved = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    texts = documents.select(F.col("doc_id").cast("long"), "text").join(involved, "doc_id")
    one, two = (texts.toDF(f"{s}_id", f"{s}_text") for s in "xy")
    joined = pairs.join(one, F.col("a") == F.col("x_id")).join(two, F.col("b") == F.col("y_id")).select("a", "b", "x_text", "y_text")
    percent = round(100 * threshold)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, last, known = [], None, None
        for x, y in zip(batch.column("x_text").to_pylist(), batch.column("y_text").to_pylist()):
            if y != last or known is None:
                last, known = y, shingle_set(y, shingle)
            s = shingle_set(x, shingle)
            both = len(np.intersect1d(s, known, assume_unique=True))
            keep.append(100 * both >= percent * (len(s) + len(known) - both))
        return pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"])

    return map_batches(joined, run, "a long, b long")


def _several(labelled: DataFrame, key: str) -> DataFrame:
    """Keys whose rows are of more than one component, with the smallest one."""
    ends = labelled.groupBy(key).agg(F.min("component").alias("main"), F.max("component").alias("other"))
    return ends.where("main != other").select(key, "main")


def _crossing(unsettled: DataFrame, documents: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """Pairs (a, b) of different components that may reach the threshold.

    Exact prefix filter: let every set be sorted by how many of the unsettled
    sets hold a shingle, rarest first. Two sets whose overlap must be o or more
    share a shingle among the first |x| - o + 1 of x and |y| - o + 1 of y, where
    o is t/(1+t) of both sizes together. Variants of one text that differ too much have enough shingles of their
    own to share none there, however many variants there are.
    """
    percent = round(100 * threshold)
    texts = documents.select(F.col("doc_id").cast("long").alias("rep"), "text").join(unsettled, "rep").select("rep", "component", "text")

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(t, shingle) for t in batch.column("text").to_pylist()]
        sizes = np.array([len(f) for f in found])
        rep, component = (np.repeat(np.array(batch.column(c).to_pylist(), dtype=np.int64), sizes) for c in ("rep", "component"))
        return pa.RecordBatch.from_arrays([pa.array(rep), pa.array(component), pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate(found).view(np.int64))], names=["rep", "component", "n", "shingle"])

    rows = materialize(map_batches(texts, sets, "rep long, component long, n long, shingle long"))
    held = materialize(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("held")).where("held > 1"))
    place = F.row_number().over(Window.partitionBy("rep", "n").orderBy(F.coalesce("held", F.lit(1)), "shingle"))
    ranked = rows.join(held, "shingle", "left").withColumn("place", place).where("held is not null")
    # Among the first |x| - o + 1 for any partner; the pair's own o decides below.
    prefixes = materialize(ranked.where(f"place <= n - (({percent} * n + 99) div 100) + 1").select("shingle", "rep", "component", "n", "place"))
    open_rows = materialize(prefixes.join(materialize(_several(prefixes, "shingle")), "shingle"))
    a, b = (open_rows.select("shingle", "main", *[F.col(c).alias(f"{side}_{c}") for c in ("rep", "component", "n", "place")]) for side in "ab")
    overlap = f"(({percent} * (a_n + b_n) + {99 + percent}) div {100 + percent})"
    fits = F.expr(f"a_component != b_component and a_place <= a_n - {overlap} + 1 and b_place <= b_n - {overlap} + 1")
    met = a.where("a_component != main").drop("main").join(b.drop("main"), "shingle")
    return met.where(fits).select(F.greatest("a_rep", "b_rep").alias("a"), F.least("a_rep", "b_rep").alias("b")).distinct()


def _of_one_id(with_set: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of documents that have several texts."""
    texts = with_set.groupBy("doc_id").agg(F.min("set_key").alias("one"), F.max("set_key").alias("other"))
    several = materialize(texts.where("one != other").select("doc_id"))
    held = materialize(with_set.join(several, "doc_id").select("doc_id", "set_key").distinct().join(classes.select("set_key", "rep"), "set_key").select("doc_id", "rep"))
    least = held.groupBy("doc_id").agg(F.min("rep").alias("b"))
    return held.join(materialize(least), "doc_id").where("rep != b").select(F.col("rep").alias("a"), "b").distinct()


def near_duplicates(documents: DataFrame, threshold: float = 0.8, shingle: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``documents``.

    Linked are documents whose sets' intersection is at least ``threshold`` of
    their union (read as whole hundredths). component_id is the smallest doc_id
    reachable over links; kept says that it is the row's own.
    """
    bands = bands_for(threshold)
    sketched = materialize(sketch(documents, threshold, shingle))
    with_set = sketched.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = materialize(with_set.groupBy("set_key").agg(F.min(F.struct("doc_id", "n_shingles", "registers")).alias("r")).select("set_key", F.col("r.doc_id").alias("rep"), "r.n_shingles", "r.registers"))

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [band_keys(np.frombuffer(r, "<u2"), bands) for r in batch.column("registers").to_pylist()]
        reps = np.repeat(np.array(batch.column("rep").to_pylist(), dtype=np.int64), bands)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(reps)], names=["bucket", "rep"])

    members = map_batches(classes.select("rep", "registers"), keys, "bucket long, rep long")
    led = materialize(members.groupBy("bucket").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket", "leader"))
    shared = materialize(members.join(led, "bucket"))
    first = materialize(_plausible(shared.where("rep != leader").select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct(), classes, threshold))
    links = materialize(_confirmed(first, documents, threshold, shingle).unionByName(_of_one_id(with_set, classes)))
    labels = connected_components(links)

    labelled = materialize(shared.join(labels, F.col("rep") == F.col("node"), "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component")))
    split = materialize(_several(labelled, "bucket"))
    unsettled = materialize(labelled.join(split, "bucket").select("rep", "component").distinct())
    untested = materialize(_crossing(unsettled, documents, threshold, shingle))
    second = materialize(_plausible(untested, classes, threshold))
    more = materialize(_confirmed(second, documents, threshold, shingle))
    final = labels if more.isEmpty() else connected_components(links.unionByName(more))

    of_set = materialize(classes.select("set_key", "rep").join(final, F.col("rep") == F.col("node"), "left").select("set_key", F.coalesce("component", "rep").alias("component_id")))
    named = sketched.select("doc_id", "n_shingles", "set_key").join(of_set, "set_key", "left")
    # A row without words belongs to its document's other rows, if there are any.
    wordless = materialize(sketched.where("set_key is null and doc_id is not null").select("doc_id").distinct())
    others = with_set.join(wordless, "doc_id").join(of_set, "set_key").groupBy("doc_id").agg(F.min("component_id").alias("of_others"))
    named = named.join(materialize(others), "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "of_others", "doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
