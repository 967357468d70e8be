"""Running sums and maxima over arrays, as native expressions.

Spark has no function for a running value over an array, and a fold that appends
to its result copies it at every step. Here the array is cut into chunks: each
chunk's total, the totals' own running value, and short folds inside the chunks.
The work grows with the array's length times the chunk's, never with its square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

CHUNK = 128
_NUMBERS = "array<int>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, combine: Callable[[Column, Column], Column], start: Column) -> Column:
    """Inclusive running value of an array of numbers: element i is ``combine``
    over ``start`` and the elements up to i. ``combine`` must be associative."""

    def inside(chunk: Column, carried: Column) -> Column:
        first = F.struct(carried.alias("last"), F.array().cast(_NUMBERS).alias("out"))

        def step(acc: Column, x: Column) -> Column:
            now = combine(acc["last"], x)
            return F.struct(now.alias("last"), F.concat(acc["out"], F.array(now)).alias("out"))

        return F.aggregate(chunk, first, step, lambda acc: acc["out"])

    def over(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, start, combine))
        # Of the totals a plain fold will do: there are few, and only numbers.
        carried = F.aggregate(
            totals,
            F.struct(start.alias("last"), F.array().cast(_NUMBERS).alias("out")),
            lambda acc, t: F.struct(combine(acc["last"], t).alias("last"), F.concat(acc["out"], F.array(acc["last"])).alias("out")),
            lambda acc: acc["out"],
        )
        return let(carried, lambda c: F.flatten(F.transform(chunks, lambda chunk, j: inside(chunk, F.get(c, j)))))

    def cut(all_values: Column) -> Column:
        n = F.size(all_values)
        places = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int"))).otherwise(F.array().cast("array<int>"))
        return let(F.transform(places, lambda j: F.slice(all_values, j * CHUNK + 1, F.lit(CHUNK))), over)

    return let(values.cast(_NUMBERS), cut)


def running_sum(values: Column) -> Column:
    return running(values, lambda a, b: a + b, F.lit(0))


def running_max(values: Column) -> Column:
    """Running maximum of an array of integers that are not negative."""
    return running(values, lambda a, b: F.greatest(a, b), F.lit(0))
