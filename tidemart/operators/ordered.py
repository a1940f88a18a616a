"""Order-dependent operators that do not need a whole group in one task.

A window over ``partitionBy(key).orderBy(time)`` puts each key into one task. Here every key is cut into
slices of a fixed width of time, rows without a time by their tie-break, and windows run inside (key, slice).
What has to cross a slice boundary is one row per slice, carried over by a window of its own. The rows are
shuffled once, by (key, slice), and everything reads that one shuffle; there is no counting of keys
beforehand and no other plan for small inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEY, SLICE = "_key", "_slice"
# Whole numbers are taken as milliseconds. A slice should hold no more rows of a key than a task can sort.
WIDTH_MS = 3_600_000
TIE_WIDTH = 1 << 20


def sliced(df: DataFrame, keys: list[str], order: list[str], width: int = WIDTH_MS, tie_width: int = TIE_WIDTH) -> DataFrame:
    """Add the key as one column and ``_slice``, which rises with ``order`` inside a key.

    ``order`` ends with a time (or whole number) and a whole number as tie-break; leading columns with few
    values come first in a slice. ``width`` is in milliseconds. Rows without a time come first, cut by
    ``tie_width`` of the tie-break. Neither column is ever null, so that joins on them need no null rule.
    """
    time, tie = order[-2], order[-1]
    if df.schema[time].dataType.typeName().startswith("timestamp"):
        position = F.unix_millis(F.col(time).cast("timestamp"))
    else:
        position = F.col(time).cast("bigint")
    part = F.floor(position / width)
    tie_part = F.when(position.isNull(), F.floor(F.col(tie) / tie_width))
    parts = F.struct(*[F.col(m) for m in order[:-2]], part.alias("_part"), tie_part.alias("_tie_part"))
    return df.withColumns({KEY: F.struct(*[F.col(k) for k in keys]), SLICE: parts})


def _neighbour(
    df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, forward: bool, **widths: int
) -> DataFrame:
    shift = F.lead if forward else F.lag
    rows = W.partitionBy(KEY, SLICE).orderBy(*order)
    inside = sliced(df, keys, order, **widths).withColumn("_value", F.struct(value.alias("v"))).withColumns(
        {"_near": shift("_value").over(rows), "_after": F.lead(F.lit(True)).over(rows), "_before": F.lag(F.lit(True)).over(rows)}
    )
    # What the neighbouring slice has to know is the value of the row at the border. The condition on all columns always
    # holds; with it both readers need the same columns, whichever the caller uses later, so both read one shuffle.
    read = F.xxhash64(*[c for c in inside.columns if c not in ("_near", "_after", "_before")])
    inside = inside.where(F.coalesce(F.nullif(read, F.lit(0)), F.lit(1)) != 0)
    border = F.col("_before" if forward else "_after").isNull()
    edges = inside.where(border).select(KEY, SLICE, "_value").select(
        KEY, SLICE, shift("_value").over(W.partitionBy(KEY).orderBy(SLICE)).alias("_edge")
    )
    return (
        inside.join(edges, [KEY, SLICE], "left")
        .withColumn(out, F.coalesce(F.col("_near"), F.col("_edge"))["v"])
        .drop("_value", "_near", "_edge", "_after", "_before", KEY, SLICE)
    )


def previous_value(
    df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, **widths: int
) -> DataFrame:
    """Value of the previous row of the group; null on its first row (see :func:`sliced` for ``order``)."""
    return _neighbour(df, keys, order, value, out, forward=False, **widths)


def next_value(
    df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, **widths: int
) -> DataFrame:
    """Value of the next row of the group; null on its last row."""
    return _neighbour(df, keys, order, value, out, forward=True, **widths)


def longest_runs(
    df: DataFrame, keys: list[str], order: list[str], hit: Column, reset: Column, out: str, **widths: int
) -> DataFrame:
    """Per group, the most ``hit`` rows between two ``reset`` rows in the given order.

    Rows that are neither count as absent. The running number of resets names the run of each row;
    runs that continue over a slice boundary get the same number because every slice starts from the
    resets of the slices before it.
    """
    flags = df.withColumns({"_reset": reset.cast("int"), "_hits": (hit & ~reset).cast("int")})
    rows = W.partitionBy(KEY, SLICE).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = (
        sliced(flags, keys, order, **widths)
        .withColumn("_run", F.sum("_reset").over(rows))
        .groupBy(KEY, SLICE, "_run")
        .agg(F.sum("_hits").alias("_hits"))
    )
    before = W.partitionBy(KEY).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    offsets = local.groupBy(KEY, SLICE).agg(F.max("_run").alias("_resets")).select(
        KEY, SLICE, F.coalesce(F.sum("_resets").over(before), F.lit(0)).alias("_offset")
    )
    whole = local.join(offsets, [KEY, SLICE]).withColumn("_run", F.col("_run") + F.col("_offset"))
    return (
        whole.groupBy(KEY, "_run")
        .agg(F.sum("_hits").alias("_hits"))
        .groupBy(KEY)
        .agg(F.max("_hits").cast("int").alias(out))
        .select(f"{KEY}.*", out)
    )


def running_sums(df: DataFrame, keys: list[str], order: str, sums: dict[str, str]) -> DataFrame:
    """Totals up to and including each ``order`` value, for groups bounded by that column.

    Meant for pre-aggregated buckets (a day has 288 five-minute buckets), not for raw rows.
    """
    upto = W.partitionBy(*keys).orderBy(order).rangeBetween(W.unboundedPreceding, 0)
    return df.withColumns({out: F.sum(c).over(upto) for out, c in sums.items()})
