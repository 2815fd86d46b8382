"""Order of rows along a space-filling curve, by two columns that queries filter on.

Files that hold neighbouring stretches of the curve span few values of either column,
so Parquet's minima and maxima rule most of them out for a filter on either one.

A column becomes a coordinate of ``BITS`` bits by its approximate quantiles (one
aggregate over all rows, combined map-side), so a value that holds a third of the rows
takes a third of the axis and the rest keeps its resolution.  Nulls have coordinate 0.
Texts are ordered by their first six bytes; those that agree in them share a
coordinate, and callers sort by the text itself within it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8
# 48 bits: ``percentile_approx`` works in doubles.
PREFIX_BYTES = 6


def as_number(column: Column, data_type: T.DataType) -> Column:
    """A long in the order of the column's values (texts: of their first bytes)."""
    if isinstance(data_type, T.StringType):
        digits = F.rpad(F.hex(F.substring(column, 1, PREFIX_BYTES)), 2 * PREFIX_BYTES, "0")
        return F.conv(digits, 16, 10).cast("long")
    return column.cast("long")


def cut_points(rows: DataFrame, columns: list[str], bits: int = BITS) -> dict[str, list[int]]:
    """For each column ``2^bits - 1`` values at equal shares of the rows (none: no rows)."""
    parts = 1 << bits
    shares = [i / parts for i in range(1, parts)]
    got = rows.agg(*[F.percentile_approx(as_number(F.col(c), rows.schema[c].dataType),
                                         shares, 40 * parts).alias(c) for c in columns]).first()
    return {c: list(got[c] or []) for c in columns}


def coordinate(number: Column, cuts: list[int], bits: int = BITS) -> Column:
    """How many of the cut points are not above the number, found by halving."""
    if not cuts:
        return F.lit(0).cast("long")
    table = F.lit(cuts).cast("array<bigint>")
    steps = F.lit([1 << b for b in reversed(range(bits))]).cast("array<bigint>")
    return F.aggregate(
        steps, F.lit(0).cast("long"),
        lambda found, step: F.when(
            F.get(table, (found + step - 1).cast("int")) <= number, found + step)
        .otherwise(found))


def hilbert(x: Column, y: Column, bits: int = BITS) -> Column:
    """Place of a cell on the Hilbert curve over a square of ``2^bits`` by ``2^bits``."""
    sides = F.lit([1 << b for b in reversed(range(bits))]).cast("array<bigint>")
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"),
                     F.lit(0).cast("long").alias("place"))

    def step(at: Column, side: Column) -> Column:
        right, upper = at["x"].bitwiseAND(side) > 0, at["y"].bitwiseAND(side) > 0
        quarter = F.when(upper, F.when(right, 2).otherwise(1)).otherwise(
            F.when(right, 3).otherwise(0))
        across, up = at["x"].bitwiseAND(side - 1), at["y"].bitwiseAND(side - 1)
        # The lower quarters are run through transposed, the right one mirrored as well.
        mirror = right & ~upper
        new_x = F.when(upper, across).when(mirror, side - 1 - up).otherwise(up)
        new_y = F.when(upper, up).when(mirror, side - 1 - across).otherwise(across)
        return F.struct(new_x.alias("x"), new_y.alias("y"),
                        (at["place"] + side * side * quarter).alias("place"))

    return F.aggregate(sides, start, step, lambda at: at["place"])


def curve_place(rows: DataFrame, columns: list[str]) -> Column:
    """Place of each row on the curve over two columns of ``rows`` (runs one aggregate)."""
    cuts = cut_points(rows, columns)
    return hilbert(*[coordinate(as_number(F.col(c), rows.schema[c].dataType), cuts[c])
                     for c in columns])
