"""Exact medians of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BINS_PER_OCTAVE = 32
CELLS = 4096


def _log_bin(v: Column) -> Column:
    """A number that never decreases as ``v`` grows, with a bounded number of values.

    It is never null, so that no join adds a null filter below the counts all passes share.
    """
    size = F.floor(F.log2(F.greatest(F.abs(v), F.lit(1e-12))) * BINS_PER_OCTAVE) + 2000
    return F.coalesce(F.when(v > 0, size).when(v < 0, -size), F.lit(0).cast("bigint"))


def _seek(pieces: DataFrame, group: list[str], order: str) -> DataFrame:
    """Keep the one or two pieces that hold the middle ranks ``_r1`` and ``_r2`` of the group."""
    upto = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    end = F.col("_base") + F.sum("_n").over(upto)
    return (
        pieces.withColumn("_end", end)
        .withColumn("_before", F.col("_end") - F.col("_n"))
        .where((F.col("_before") < F.col("_r2")) & (F.col("_end") >= F.col("_r1")))
    )


def exact_medians(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Exact median of each column per group (mean of the two middle values), nulls ignored.

    Meant for few but large groups: nothing is gathered per group, and what is broadcast is at most two
    rows per group and column. The values are first counted, so equal ones become one row. Pass 1 adds up
    the counts in coarse logarithmic bins and finds the bins with the middle ranks; pass 2 does the same
    with equal cells inside those bins; pass 3 orders the values of the middle cells. All passes read the
    same shuffled counts, and all decisions rest on exact numbers.
    """
    group = ["_g", "_measure"]
    measures = F.array(
        *[F.struct(F.lit(c).alias("_measure"), F.col(c).cast("double").alias("_v")) for c in columns]
    )
    values = (
        df.select(F.struct(*by).alias("_g"), F.inline(measures))
        .where(F.col("_v").isNotNull())
        .groupBy(*group, "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bin", _log_bin(F.col("_v")))
    )
    total = F.sum("_n").over(W.partitionBy(*group))
    bins = (
        values.groupBy(*group, "_bin")
        .agg(F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        .withColumn("_base", F.lit(0))
        .withColumn("_r1", F.floor((total + 1) / 2))
        .withColumn("_r2", F.floor(total / 2) + 1)
    )
    middle = _seek(bins, group, "_bin").select(*group, "_bin", "_low", "_high", "_before", "_r1", "_r2")
    span = F.col("_high") - F.col("_low")
    cell = F.floor(F.coalesce(F.try_divide(F.col("_v") - F.col("_low"), span), F.lit(0.0)) * CELLS)
    inside = values.join(F.broadcast(middle), [*group, "_bin"]).withColumn("_cell", cell)
    cells = inside.groupBy(*group, "_bin", "_cell").agg(
        F.sum("_n").alias("_n"),
        *[F.first(c).alias(c) for c in ("_r1", "_r2")],
        F.first("_before").alias("_base"),
    )
    kept = _seek(cells, [*group, "_bin"], "_cell").select(
        *group, "_bin", "_cell", F.col("_before").alias("_base")
    )
    found = _seek(
        inside.join(F.broadcast(kept), [*group, "_bin", "_cell"]), [*group, "_bin", "_cell"], "_v"
    )

    def at(rank: str) -> Column:
        hit = (F.col("_before") < F.col(rank)) & (F.col("_end") >= F.col(rank))
        return F.max(F.when(hit, F.col("_v")))

    medians = found.groupBy(*group).agg(((at("_r1") + at("_r2")) / 2).alias("_median"))
    return medians.groupBy("_g").agg(
        *[F.max(F.when(F.col("_measure") == c, F.col("_median"))).alias(c) for c in columns]
    ).select("_g.*", *columns)
