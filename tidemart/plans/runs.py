"""What the hourly jobs share: the day rule of a run and the customer join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import iso_between, iso_day

Days = tuple[str, str] | None


def rows_of_run(df: DataFrame, time: str, days: Days, partition: str = "snapshot_date") -> DataFrame:
    """Rows whose text time lies on the day of their own partition.

    A day ends with ``23:59:59.999``, whether one call covers a range of daily runs or, with ``days=None``,
    every partition. The partition range is pruned and the raw time range can be pushed to the scan.
    """
    if days:
        df = df.where(F.col(partition).between(*days) & iso_between(time, *days))
    within = F.substring_index(time, "+", 1) <= F.concat(F.col(partition), F.lit("T23:59:59.999"))
    return df.where((iso_day(time) == F.col(partition)) & within)


def with_login_name(df: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join of the customer's login name, from the snapshot of the same day if there are several."""
    keys = ["product_id", "customer_id"]
    if "snapshot_date" in customers.columns:
        keys.append("snapshot_date")
    return df.join(customers.select(*keys, "login_name"), keys, "left")
