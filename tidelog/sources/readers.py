"""Readers (S1–S11) and the SQL-dump / delimited-text parsers.

Readers return DataFrames; parsers are column expressions over a ``value``
text column, so they run inside the scan stage with no Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.sources.sinks import NULL_TEXT


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, header: bool = True
) -> DataFrame:
    """Header CSV. Without a schema every column is a string (no inference);
    leading blanks inside fields are kept."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_lines(spark: SparkSession, paths: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """Text lines (plain, ``.gz``, or whole directories) as one ``value`` column.

    Gzip files cannot be split: each becomes a single task. Pass
    ``partitions`` to spread the lines before heavy work.
    """
    df = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return df.repartition(partitions) if partitions else df


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """JDBC table. Credentials come from ``properties`` (never hard-coded).
    With ``partition_column`` and bounds the read is split into
    ``num_partitions`` parallel range queries."""
    props = dict(properties or {})
    if partition_column is not None:
        return spark.read.jdbc(
            url,
            table,
            column=partition_column,
            lowerBound=lower_bound,
            upperBound=upper_bound,
            numPartitions=num_partitions or 1,
            properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)


def _strip(c, head: int, tail: int):
    """Drop ``head`` leading and ``tail`` trailing characters."""
    return F.substr(c, F.lit(head + 1), F.length(c) - (head + tail))


def _pieces(lines: DataFrame, col: str, sep: str) -> DataFrame:
    # Split once into an array column; the pickers below read the array.
    return lines.select(F.split(F.col(col), "\\Q" + sep + "\\E").alias("_p"))


# SQL literals. A quoted value may hold any character; a quote in it is
# doubled or escaped. A tuple holds values between brackets.
_QUOTED = r"'(?:[^'\\]++|\\.|'')*+'"
_VALUE = _QUOTED + r"|[^,()'\s](?:[^,()']*[^,()'\s])?"
_TUPLE = r"\((?:[^'()]++|" + _QUOTED + r")*+\)"
_REMARK = r"^\s*(?:--|#|/\*)"


def _plain(value):
    """A value as text: without its quotes and escapes; a bare NULL is null."""
    inner = F.regexp_replace(F.regexp_replace(_strip(value, 1, 1), "''", "'"), r"\\(.)", "$1")
    return F.when(F.startswith(value, F.lit("'")), inner).when(F.upper(value) != "NULL", value)


def sql_tuples(lines: DataFrame, col: str = "value") -> DataFrame:
    """SQL dump lines -> one row per tuple, ``values`` as an array of text.

    A statement may hold any number of tuples; what stands before VALUES (a table's
    name, a list of columns) is no tuple, and remarks hold none."""
    line = F.coalesce(F.col(col), F.lit(""))
    rest = F.regexp_replace(line, r"(?is)^\s*(?:INSERT|REPLACE)\b[^']*?\bVALUES\b", "")
    tuples = F.when(~line.rlike(_REMARK), F.regexp_extract_all(rest, F.lit(_TUPLE), F.lit(0)))
    return lines.select(F.explode(tuples).alias("_t")).select(F.transform(F.regexp_extract_all("_t", F.lit(_VALUE), F.lit(0)), _plain).alias("values"))


def _values(lines: DataFrame, col: str, least: int, quoted: bool) -> DataFrame:
    """``_p``: the pieces of each row, by the SQL literals or split on comma+space."""
    pieces = sql_tuples(lines, col).select(F.col("values").alias("_p")) if quoted else _pieces(lines, col, ", ")
    return pieces.where(F.size("_p") >= least)


def parse_area_dump(lines: DataFrame, col: str = "value", quoted: bool = True) -> DataFrame:
    """``INSERT INTO t VALUES (code, 'name', parent, '', level, x, lng, lat, ...);``
    lines -> (code, name, parent_code, level, lng, lat) as text.

    The code is the last six characters of piece 0, the last two pieces are lng and
    lat. Lines are read as SQL: names may hold separators, brackets and quotes, a
    statement several tuples. ``quoted=False`` is the original job's way: pieces are
    split on comma+space, the name loses its first and last character, and lat its
    two trailing ones (``);``). Rows with fewer than six pieces are left to
    ``short_lines``."""
    p = F.col("_p")
    n = F.size(p)
    return _values(lines, col, 6, quoted).select(
        F.right(F.get(p, 0), F.lit(6)).alias("code"),
        (F.get(p, 1) if quoted else _strip(F.get(p, 1), 1, 1)).alias("name"),
        F.get(p, 2).alias("parent_code"),
        F.get(p, 4).alias("level"),
        F.get(p, n - 2).alias("lng"),
        (F.get(p, n - 1) if quoted else _strip(F.get(p, n - 1), 0, 2)).alias("lat"),
    )


def parse_biz_dump(lines: DataFrame, col: str = "value", quoted: bool = True) -> DataFrame:
    """``('id', 'province', 'city', 'district', 'biz', 'lng', 'lat');`` lines ->
    (province, city, district, biz, lng, lat) as text, read as SQL or, with
    ``quoted=False``, split on comma+space as the original job does."""
    p = F.col("_p")
    names = ("province", "city", "district", "biz", "lng", "lat")
    if quoted:
        return _values(lines, col, 7, True).select(*[F.get(p, i + 1).alias(c) for i, c in enumerate(names)])
    return _values(lines, col, 7, False).select(*[_strip(F.get(p, i + 1), 1, 3 if c == "lat" else 1).alias(c) for i, c in enumerate(names)])


def short_lines(lines: DataFrame, least: int, col: str = "value", sep: str | None = None) -> DataFrame:
    """The lines that a dump parser leaves out, or leaves a tuple of: null, without a
    tuple, or with one of fewer than ``least`` values (6 for areas, 7 for districts).
    With ``sep`` lines are split on it, as the parsers do with ``quoted=False``."""
    if sep is not None:
        pieces = F.size(F.split(F.col(col), "\\Q" + sep + "\\E"))
        return lines.where(F.col(col).isNull() | (pieces < least)).select(col)
    line = F.col(col)
    rest = F.regexp_replace(line, r"(?is)^\s*(?:INSERT|REPLACE)\b[^']*?\bVALUES\b", "")
    tuples = F.regexp_extract_all(rest, F.lit(_TUPLE), F.lit(0))
    short = F.exists(tuples, lambda t: F.size(F.regexp_extract_all(t, F.lit(_VALUE), F.lit(0))) < least)
    return lines.where(line.isNull() | line.rlike(_REMARK) | (F.size(tuples) == 0) | short).select(col)


def parse_delimited(
    lines: DataFrame, schema: T.StructType | str, sep: str = ",", col: str = "value"
) -> DataFrame:
    """Headerless delimited text -> typed columns (``try_cast``: a bad field
    becomes null instead of failing the job)."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    p = F.col("_p")
    return _pieces(lines, col, sep).select(
        *[F.get(p, i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    )


def read_delimited(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, sep: str = ","
) -> DataFrame:
    """Headerless delimited files, quoted where a value needs it, to typed
    columns; a field that does not convert becomes null."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    paths = [path] if isinstance(path, str) else list(path)
    rows = spark.read.schema(texts).option("sep", sep).option("escape", '"').option("multiLine", True).option("nullValue", NULL_TEXT).csv(paths)
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_url_dimension(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Two-column ``prefix,category`` text -> (prefix, category)."""
    return parse_delimited(read_lines(spark, path), "prefix string, category string")


def read_stopwords(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One stop word per line. Read as text, not CSV: a comma is itself an entry."""
    return read_lines(spark, path).select(F.col("value").alias("word")).where(F.length("word") > 0)
