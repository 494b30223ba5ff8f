"""Small column combinators shared by the function modules."""

from __future__ import annotations

from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Inside a lambda Spark re-evaluates an expression at every mention, which turns a
    linear pass over an array into a quadratic one; a bound variable does not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def literal_map(pairs: dict[str, str]) -> Column:
    """Constant string map from a bounded Python dict.

    One literal that the optimizer folds into a map, instead of two per entry.
    """
    text = "\x1e".join(f"{key}\x1f{value}" for key, value in pairs.items())
    return F.str_to_map(F.lit(text), F.lit("\x1e"), F.lit("\x1f"))


def literal_array(values: Iterable) -> Column:
    return F.array(*[F.lit(v) for v in values])


def pick(values: list, index: Column) -> Column:
    """``values[index mod len]`` for a bounded Python list."""
    return F.element_at(literal_array(values), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def first_by(items: Column, key: Callable[[Column], Column]) -> Column:
    """Keep the first array element for each key, in order (short arrays)."""
    return let(
        F.transform(items, key),
        lambda keys: F.filter(items, lambda x, i: F.array_position(keys, F.element_at(keys, i + 1)) == i + 1),
    )


def run_starts(ordered: Column, key: Callable[[Column], Column]) -> Column:
    """1-based positions in a sorted array where the key differs from the one before."""
    return F.filter(
        F.sequence(F.lit(1), F.size(ordered)),
        lambda i: (i == 1) | (key(F.element_at(ordered, i)) != key(F.element_at(ordered, F.greatest(i - 1, F.lit(1))))),
    )


def each(array: Column | str) -> Column:
    """One row per element, like ``explode``.

    Exploding a bare column lets the optimizer add a ``size(column) > 0`` filter and
    push it below the projection that computes the column, which then runs twice (and
    ahead of any repartitioning). An expression is exempt from that.
    """
    return F.explode(F.concat(array))


def each_at(array: Column | str) -> Column:
    """One row per element with its position, like ``posexplode``."""
    return F.posexplode(F.concat(array))


def kept(value: Column, test: Callable[[Column], Column]) -> Column:
    """Generator: the row's ``value`` when it passes ``test``, else no row.

    A filter on a computed column is pushed below the projection and computes it again;
    a generator computes it once.
    """
    return F.explode(F.filter(F.array(value), test))


def unfold(rows: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """One row per whole number from ``first`` to ``last``, in a column ``name``.

    Unfolded in steps of 2^32, 2^16 and 1, so no row ever holds more than 65,536 numbers
    of a range, however wide it is. A range that ends before it starts gives no row.
    """
    out = rows.withColumns({"_first": first.cast("long"), "_last": last.cast("long")}).filter("_first <= _last")
    for step, width in ((1 << 32, None), (1 << 16, 1 << 32), (1, 1 << 16)):
        end = F.col("_last") if width is None else F.least(F.col("_first") + (width - 1), F.col("_last"))
        out = out.withColumn("_first", F.explode(F.sequence(F.col("_first"), end, F.lit(step).cast("long"))))
    return out.drop("_last").withColumnRenamed("_first", name)
