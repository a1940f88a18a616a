"""Row counts and unique counts under conditions, in one pass over few copies of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals_and_uniques(
    df: DataFrame, keys: list[str], totals: dict[str, Column], uniques: dict[str, dict[str, Column]]
) -> DataFrame:
    """Per ``keys``: sums of ``totals``, and how many different ids have a row meeting a condition.

    ``uniques`` maps an id column to ``{output: condition}``. Several distinct counts in one aggregate
    make Spark copy each row once per count; here a row is copied once per id column, and only where one
    of its conditions holds. The first aggregate is by (keys, id), with map-side combine, so a group with
    a large share of the rows is spread over its ids; the second adds up one row per id. A missing id
    counts as one id.
    """
    columns = list(uniques)
    conditions = [(out, c, cond) for c, outs in uniques.items() for out, cond in outs.items()]

    def copy(column: str) -> Column:
        first = column == columns[0]
        return F.struct(
            F.lit(column).alias("_kind"),
            F.col(column).cast("string").alias("_id"),
            *[(value if first else F.lit(None)).alias(name) for name, value in totals.items()],
            *[
                (F.coalesce(cond, F.lit(False)) if c == column else F.lit(False)).cast("int").alias(out)
                for out, c, cond in conditions
            ],
        )

    flags = [out for out, _, _ in conditions]
    copies = df.select(*keys, F.inline(F.array(*[copy(c) for c in columns])))
    wanted = F.col("_kind") == columns[0]
    for out, c, _ in conditions:
        if c != columns[0]:
            wanted = wanted | (F.col(out) == 1)
    per_id = copies.where(wanted).groupBy(*keys, "_kind", "_id").agg(
        *[F.sum(name).alias(name) for name in totals], *[F.max(f).alias(f) for f in flags]
    )
    return per_id.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*totals, *flags)])


def ones(condition: Column) -> Column:
    """1 where the condition holds, else 0: its sum counts rows."""
    return F.coalesce(condition, F.lit(False)).cast("int")
