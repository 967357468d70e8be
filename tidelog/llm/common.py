"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
import re
import sys
import uuid
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Names that the operators take from their input; everything else is ignored.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Rows that a function of an Arrow batch gets at once.
ROWS_AT_ONCE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any path that Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def in_fold(id_column: str, modulus: int, remainder: int) -> Column:
    """True if the row is held out. A row without an id is held out too: nothing
    is learned from it."""
    return F.coalesce(fold(id_column, modulus) == remainder, F.lit(True))


def hash_below(fraction: Column, *columns: str, salt: str) -> Column:
    """Deterministic sampling: true for about ``fraction`` of distinct keys."""
    return F.pmod(F.xxhash64(F.lit(salt), *columns), F.lit(1_000_000)) < fraction * 1_000_000


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of a partition, a thousand rows at a time,
    so that a worker holds few texts as Python objects."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                yield fn(batch.slice(at, ROWS_AT_ONCE))

    return df.mapInArrow(run, schema)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names.

    The setting is read from the session. It may be unset only on a local
    master (tests), where Spark's own checkpoint folder or a temporary one of
    this machine is right; anywhere else that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="tidelog-llm-")
    return f"{base.rstrip('/')}/tidelog-llm-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and the
    rows survive a lost executor. Readers get plain scans, so that a join over
    them is one that Spark can split at hot keys."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_stored_at"] = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the table that ``materialize`` wrote for ``df``, once nothing reads it
    any more. Other DataFrames are left alone."""
    path = df.__dict__.pop("_stored_at", None)
    if path:
        target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def of_this_process(name: str) -> dict:
    """A dict that lives as long as the Python process: tasks that run one after
    another in a worker share it, and it never travels with a function."""
    return sys.modules.setdefault(f"_tidelog_{name}", ModuleType(f"_tidelog_{name}")).__dict__


def digest(data: bytes) -> bytes:
    """128-bit digest that names a value across tasks."""
    return hashlib.blake2b(data, digest_size=16).digest()
