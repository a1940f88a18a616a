"""Hourly deposits, withdrawals and rebates per user.

A customer table that is small enough to broadcast meets the log lines where they are read, and the
only shuffle is that of the partial sums. With a larger one the lines are first reduced to one row per
customer, hour and code group: the join then moves sums instead of lines, and a customer with very many
lines is a handful of rows by then. Counts, sums, maxima and minima combine the same way both times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import (
    DEPOSIT_CODES,
    REBATE_CODE,
    WITHDRAW_CODE,
    WITHDRAW_REVERSALS,
    deposit_channel,
)
from ..functions.columns import money
from ..functions.keys import user_key
from ..functions.times import day_of_hour, iso_hour
from ..operators.lookups import strict_lookup
from ..operators.sizes import BROADCAST_BYTES, is_small
from .runs import Days, rows_of_run, with_login_name


def _combine(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("top").alias("top"), F.min("low").alias("low")
    )


def _per_user_hour(
    rows: DataFrame,
    customers: DataFrame,
    hours: DataFrame,
    currencies: DataFrame,
    load_time: str,
    count: Column,
    amount: Column,
    extra: dict[str, Column] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    extra = extra or {}
    customer = ["product_id", "customer_id"]
    group = ["full_date_hour", *extra, "currency"]
    lines = rows.select(
        *customer,
        iso_hour("created_date").alias("full_date_hour"),
        F.col("currency").alias("currency_code"),
        *[c.alias(name) for name, c in extra.items()],
        count.alias("n"),
        *[amount.alias(name) for name in ("total", "top", "low")],
    )
    if not is_small(customers, broadcast_bytes):
        lines = _combine(lines, [*customer, "full_date_hour", *extra, "currency_code"])
    priced = strict_lookup(
        lines, currencies, F.col("currency_code"), "currency_code", "currency_id", "currency"
    )
    dated = priced.withColumn("snapshot_date", day_of_hour("full_date_hour"))
    named = with_login_name(dated, customers).withColumn("user_fk", user_key("product_id", "login_name"))
    facts = strict_lookup(
        _combine(named, [*group, "user_fk"]),
        hours, F.col("full_date_hour"), "full_date_hour", "date_hour_sk", "date_hour_fk",
    )
    return facts.select(
        F.col("date_hour_fk").cast("bigint").alias("date_hour_fk"), "user_fk", *extra, "currency",
        *["n", *[F.col(c).cast("double").alias(c) for c in ("total", "top", "low")]],
        F.lit(load_time).alias("load_time"), day_of_hour("full_date_hour").alias("dt"),
    )


def deposit_hourly(
    credit_logs: DataFrame,
    customers: DataFrame,
    hours: DataFrame,
    currencies: DataFrame,
    load_time: str,
    days: Days = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Deposit count and amount per hour, user, channel and currency."""
    rows = rows_of_run(credit_logs.where(F.col("trans_code").isin(*DEPOSIT_CODES)), "created_date", days)
    channel = {"deposit_channel_fk": deposit_channel("trans_code", "sub_type")}
    facts = _per_user_hour(
        rows, customers, hours, currencies, load_time, F.lit(1), money("amount"), channel,
        broadcast_bytes,
    )
    return facts.select(
        "date_hour_fk", "user_fk", "deposit_channel_fk", "currency",
        F.col("n").alias("deposit_count"), F.col("total").alias("deposit_amount"),
        "load_time", "dt",
    )


def withdraw_hourly(
    credit_logs: DataFrame,
    customers: DataFrame,
    hours: DataFrame,
    currencies: DataFrame,
    load_time: str,
    days: Days = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Withdrawals per hour, user and currency; reversals count negative, extremes stop at zero."""
    codes = (WITHDRAW_CODE, *WITHDRAW_REVERSALS)
    rows = rows_of_run(credit_logs.where(F.col("trans_code").isin(*codes)), "created_date", days)
    sign = F.when(F.col("trans_code") == WITHDRAW_CODE, 1).otherwise(-1)
    amount = money("amount")
    signed = F.when(F.col("trans_code") == WITHDRAW_CODE, amount).otherwise(-amount)
    facts = _per_user_hour(
        rows, customers, hours, currencies, load_time, sign, signed, broadcast_bytes=broadcast_bytes
    )
    zero = F.lit(0.0)
    return facts.select(
        "date_hour_fk", "user_fk", "currency",
        F.col("n").cast("int").alias("withdraw_count"),
        F.col("total").alias("withdraw_amount"),
        F.greatest(F.coalesce("top", zero), zero).alias("withdraw_max"),
        F.greatest(F.coalesce("low", zero), zero).alias("withdraw_min"),
        "load_time", "dt",
    )


def rebate_hourly(
    credit_logs: DataFrame,
    customers: DataFrame,
    hours: DataFrame,
    currencies: DataFrame,
    load_time: str,
    days: Days = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rebates per hour, user and currency."""
    rows = rows_of_run(credit_logs.where(F.col("trans_code") == REBATE_CODE), "created_date", days)
    facts = _per_user_hour(
        rows, customers, hours, currencies, load_time, F.lit(1), money("game_amount"),
        broadcast_bytes=broadcast_bytes,
    )
    return facts.select(
        "date_hour_fk", "user_fk", "currency",
        F.col("n").cast("int").alias("xima_count"),
        F.col("total").alias("xima_amount"),
        F.col("top").alias("xima_max"),
        F.col("low").alias("xima_min"),
        "load_time", "dt",
    )
