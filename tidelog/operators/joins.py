"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension may be sent to every task up to this size.
MAX_BROADCAST_BYTES = 32 * 1024 * 1024

# Fact rows that a key's part is to hold, about, when the dimension is not broadcast.
ROWS_PER_PART = 1_000_000

# Counters of the sketch that tells hot keys, and into how many parts all facts
# together are cut at most: a bucket of more than that share is hot.
SKETCH_BUCKETS = 1 << 16
MAX_PARTS = 1 << 14

# Parts of every key in a stream's micro-batches, which are bounded themselves.
STREAM_PARTS = 16


def estimated_bytes(df: DataFrame) -> int:
    """The planner's upper estimate of the size of ``df``; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def proven_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return estimated_bytes(df) <= max_bytes


def sized_broadcast(dim: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint only where the planner's estimate proves the size."""
    return F.broadcast(dim) if proven_small(dim, max_bytes) else dim


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SKETCH_BUCKETS)).cast("int")


def parts_by_bucket(facts: DataFrame, key: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """One row, one column: an array that holds for each bucket of keys into how
    many parts its facts are cut.

    A frequency sketch of the key column, in one pass: rows are counted by a hash of
    the key, which is combined before its shuffle, so a task sends at most one row a
    bucket, however many keys there are. A count is never less than that of any key
    in the bucket. A bucket is cut by what it holds beyond ``rows_per_part`` (or, of
    very many facts, beyond 1/MAX_PARTS of them); all others are left whole.
    """
    counts = facts.groupBy(_bucket(key).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    listed = counts.agg(F.sum("n").alias("total"), F.collect_list(F.struct("bucket", "n")).alias("counts"))
    size = F.greatest(F.lit(rows_per_part).cast("double"), F.coalesce("total", F.lit(0)) / MAX_PARTS)
    listed = listed.select("counts", size.alias("size"))
    cut = F.transform(F.filter("counts", lambda c: c["n"] > F.col("size")), lambda c: F.struct(c["bucket"], F.ceil(c["n"] / F.col("size")).cast("int")))
    hot = listed.select(F.map_from_entries(cut).alias("hot"))
    return hot.select(F.transform(F.sequence(F.lit(0), F.lit(SKETCH_BUCKETS - 1)), lambda b: F.coalesce(F.try_element_at("hot", b), F.lit(1))).alias("parts"))


def _hashable(field: T.StructField) -> Column | None:
    """The column as something that can be hashed; maps are written as text."""
    kind = field.dataType.simpleString()
    if "variant" in kind:
        return None
    return F.to_json(F.struct(F.col(f"`{field.name}`"))) if "map<" in kind else F.col(f"`{field.name}`")


def _unused(name: str, *frames: DataFrame) -> str:
    taken = {c.lower() for f in frames for c in f.columns}
    while name in taken:
        name += "_"
    return name


def lookup_join(facts: DataFrame, dim: DataFrame, key: str, max_bytes: int = MAX_BROADCAST_BYTES, rows_per_part: int = ROWS_PER_PART, counted: DataFrame | None = None) -> DataFrame:
    """Left join of facts to a dimension of one row per ``key``.

    A dimension proven small is broadcast. Otherwise a sketch of the key column (a
    scalar subquery: nothing runs while the plan is built) tells the hot keys, whose
    facts are dealt into parts of about ``rows_per_part`` by a hash of the whole row,
    and whose rows of the dimension are copied into each part. A key that holds a
    third of all facts is spread over as many tasks as its size asks for; rows of
    other keys are not copied. ``counted`` are rows with the same keys that are cheaper
    to count, such as the facts before another lookup. (Skew splitting at run time would
    not help, as the dimension comes out of an aggregation by the key.) The hash, unlike
    a random number, stays the same when a task runs again. The keys of a stream cannot be
    counted beforehand: every key of a micro-batch is cut into STREAM_PARTS.
    """
    if proven_small(dim, max_bytes):
        return facts.join(F.broadcast(dim), key, "left")
    salt = _unused("_salt", facts, dim)
    if facts.isStreaming:
        parts = F.lit(STREAM_PARTS)
    else:
        parts = F.get(parts_by_bucket(facts if counted is None else counted, key, rows_per_part).scalar(), _bucket(key))
    hashed = [c for f in facts.schema.fields if (c := _hashable(f)) is not None]
    salted = facts.withColumn(salt, F.pmod(F.xxhash64(F.lit("part"), *hashed), parts).cast("int"))
    copies = dim.withColumn(salt, F.explode(F.sequence(F.lit(0), parts - 1)))
    return salted.join(copies, [key, salt], "left").drop(salt)
