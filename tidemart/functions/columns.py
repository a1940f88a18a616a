"""Small helpers to accept a column either by name or as an expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_SCALE = 18


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    """Exact amount, so that sums do not depend on the order of rows.

    All digits of the input are kept; an amount with more of them than the scale holds raises.
    """
    amount, exact = col(c), col(c).cast(f"decimal(38,{scale})")
    lost = amount.cast("double") != exact.cast("double")
    message = F.concat(F.lit("amount does not fit: "), amount.cast("string"))
    return F.when(lost, F.raise_error(message).cast(f"decimal(38,{scale})")).otherwise(exact)


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as a double, null when the denominator is null or zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on ``keys`` where null keys match too; the keys of ``right`` are dropped."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    condition = F.lit(True)
    for i, k in enumerate(keys):
        match = left[k].eqNullSafe(renamed[f"_r_{k}"])
        condition = match if i == 0 else condition & match
    return left.join(renamed, condition, "left").drop(*[f"_r_{k}" for k in keys])
