"""Key → range lookup as an equality join on common prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def common_prefix(a: Column, b: Column, digits: int) -> Column:
    """Length of the common beginning of two texts of the same length."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(digits)), F.lit(0),
        lambda n, i: F.when((n == i - 1) & (a.substr(i, F.lit(1)) == b.substr(i, F.lit(1))), i).otherwise(n),
    )


def range_matches(df: DataFrame, point: str, ranges: DataFrame, low: str, high: str, digits: int = 32) -> DataFrame:
    """The rows whose ``point`` lies in a range, with the range's other columns; ranges must not overlap.

    All three are texts of ``digits`` hexadecimal digits. A range has one row, under the common prefix of its
    ends, and a point looks under its prefixes of those lengths that occur. Ranges under one prefix differ in the
    next digit, and as they do not overlap there are at most 15 of them, so neither side grows with the width of
    a range. ``df`` is read once; a point looked up for many rows should be asked once, see :func:`range_lookup`.
    """
    values = [c for c in ranges.columns if c not in (low, high)]
    side = ranges.where(F.col(low) <= F.col(high)).select(
        common_prefix(F.col(low), F.col(high), digits).alias("_length"), F.col(low).alias("_low"), F.col(high).alias("_high"), *values
    ).withColumn("_prefix", F.expr("substring(_low, 1, _length)"))
    lengths = side.agg(F.sort_array(F.collect_set("_length"))).scalar()
    asked = df.where(F.col(point).isNotNull()).withColumn("_length", F.explode(lengths)).withColumn(
        "_prefix", F.col(point).substr(F.lit(1), F.col("_length")))
    inside = F.col(point).between(F.col("_low"), F.col("_high"))
    return asked.join(side, ["_length", "_prefix"]).where(inside).select(*df.columns, *values)


def range_lookup(df: DataFrame, point: str, ranges: DataFrame, low: str, high: str, digits: int = 32) -> DataFrame:
    """Left join of ``point`` to the range that holds it (see :func:`range_matches`).

    Distinct points are looked up once, and the answer is joined back by equality, where Spark splits a frequent one.
    """
    found = range_matches(df.select(point).distinct(), point, ranges, low, high, digits)
    return df.join(found, point, "left")
