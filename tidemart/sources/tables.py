"""Scans of daily-partitioned tables and event tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col


def read_table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """``root/name.parquet`` when a root folder is given, else the catalog table ``name``."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet") if root else spark.table(name)


def scan_day(df: DataFrame, day: str, partition: str = "dt") -> DataFrame:
    """Rows of one day partition."""
    return df.where(F.col(partition) == day)


def scan_range(df: DataFrame, first_day: str, last_day: str, partition: str = "dt") -> DataFrame:
    """Rows of the day partitions from ``first_day`` to ``last_day``, both included."""
    return df.where(F.col(partition).between(first_day, last_day))


def on_days(ts: Column | str, first_day: str, last_day: str | None = None) -> Column:
    """Timestamps inside whole days, as a half-open range the scan can use."""
    end = (date.fromisoformat(last_day or first_day) + timedelta(days=1)).isoformat()
    kind = "timestamp_ntz"
    return (col(ts) >= F.lit(first_day).cast(kind)) & (col(ts) < F.lit(end).cast(kind))


def _literal(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def inline_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[object]]) -> DataFrame:
    """A few constant rows whose exact size Spark knows when it plans a join."""
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"select * from values {values} as t({', '.join(columns)})")
