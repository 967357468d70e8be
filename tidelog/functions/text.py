"""String, label and map expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A Unicode-aware word separator: anything that is not a letter or a digit.
WORD_SEPARATOR = r"[^\p{L}\p{N}]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """True for null, empty or whitespace-only strings (null-safe)."""
    return ~F.coalesce(_col(c), F.lit("")).rlike(r"\S")


def is_not_blank(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("")).rlike(r"\S")


def any_identifier(cols: Iterable[Column | str], null_text: str = "null") -> Column:
    """Concatenate the identifiers (nulls skipped), delete the literal ``null``
    text, and test that something non-blank remains."""
    joined = F.concat_ws("", *[_col(c) for c in cols])
    return F.replace(joined, F.lit(null_text), F.lit("")).rlike(r"\S")


def non_blank_array(cols: Iterable[Column | str]) -> Column:
    """Array of the non-blank values among ``cols``, in column order."""
    return F.filter(F.array(*[_col(c).cast("string") for c in cols]), lambda x: x.rlike(r"\S"))


# The interval label reads "gap of <n> days" as 隔<n>天.
INTERVAL_LABEL_PREFIX = "隔"
INTERVAL_LABEL_SUFFIX = "天"


def interval_label(n: Column | str) -> Column:
    return F.concat(F.lit(INTERVAL_LABEL_PREFIX), _col(n).cast("string"), F.lit(INTERVAL_LABEL_SUFFIX))


def last_of_each_key(m: Column | str) -> Column:
    """``m`` with one entry per key, the last one given. A JSON object may repeat
    a key; map functions fail on that under the default policy."""
    # Sorted by (key, place), an entry is its key's last one if another key follows.
    # Entries with an equal key need no comparison with all others that way.
    placed = F.array_sort(F.transform(F.map_entries(_col(m)), lambda e, i: F.struct(e["key"].alias("key"), i.alias("at"), e["value"].alias("value"))))

    def last(sorted_entries: Column) -> Column:
        kept = F.filter(sorted_entries, lambda e, i: ~e["key"].eqNullSafe(F.get(sorted_entries, i + 1)["key"]))
        in_order = F.array_sort(F.transform(kept, lambda e: F.struct(e["at"].alias("at"), e["key"].alias("key"), e["value"].alias("value"))))
        return F.transform(in_order, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))

    # A one-element array binds the sorted entries, so that they are made once.
    return F.map_from_entries(F.element_at(F.transform(F.array(placed), last), 1))


def map_put(m: Column | str, key: str, value: Column) -> Column:
    """``m + (key -> value)`` with overwrite semantics (``map_concat`` alone
    raises on a duplicate key under the default dedup policy)."""
    kept = F.map_filter(last_of_each_key(m), lambda k, _v: k != F.lit(key))
    return F.map_concat(kept, F.create_map(F.lit(key), value))


def tokens(text: Column | str, pattern: str = WORD_SEPARATOR) -> Column:
    """Split on ``pattern`` and drop empty pieces."""
    return F.filter(F.split(_col(text), pattern), lambda t: F.length(t) > 0)
