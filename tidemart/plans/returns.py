"""Return rates: per user, per zodiac and hour, and through the day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import money, ratio
from ..functions.keys import key_prefix
from ..functions.times import days_before, five_minute_bucket, two_hour_name
from ..operators.ordered import running_sums

# The kinds of electronic games.
ELECTRONIC_KINDS = (5, 8)


def electronic_bets(bets: DataFrame, last_day: str | None = None, days: int | None = None) -> DataFrame:
    """Bets on electronic games, from ``days`` days before ``last_day`` up to it."""
    rows = bets.where(F.col("game_kind_fk").isin(*ELECTRONIC_KINDS))
    if last_day is None:
        return rows
    return rows.where(F.col("dt").between(days_before(last_day, days or 0), last_day))


def _rate(profit: str, valid: str) -> Column:
    return ratio(F.sum(profit), F.sum(valid))


def user_return_rate(
    bets: DataFrame, load_time: str, snapshot_date: str, days: int | None = None
) -> DataFrame:
    """Profit over valid bets per product, user and game; null where nothing valid was bet.

    ``days=None`` takes the whole table.
    """
    rows = electronic_bets(bets, snapshot_date if days is not None else None, days)
    return (
        rows.select(
            key_prefix("product_platform_fk").alias("product_id"),
            F.col("user_fk").alias("user_id"),
            "game_platform_fk",
            money("profit").alias("_profit"),
            money("valid_monetary").alias("_valid"),
        )
        .groupBy("product_id", "user_id", "game_platform_fk")
        .agg(_rate("_profit", "_valid").alias("return_rate"))
        .withColumn("load_time", F.lit(load_time))
        .withColumn("snapshot_date", F.lit(snapshot_date))
    )


def zodiac_return(
    bets: DataFrame,
    hours: DataFrame,
    users: DataFrame,
    load_time: str,
    snapshot_date: str,
    days: int | None = None,
) -> DataFrame:
    """Return rate per product platform, game, month, hour of day and signs of the user.

    Bets are added up per user and hour of day before the user attributes are joined, so that the join
    does not move single bets and a very active user is at most one row per month, hour and game. The
    two hours of one period stay separate rows.
    """
    rows = electronic_bets(bets, snapshot_date if days is not None else None, days)
    clock = hours.select(F.col("date_hour_sk").alias("date_hour_fk"), "month_num", "hour_num")
    per_user = (
        rows.select(
            "date_hour_fk", F.col("user_fk").alias("user_id"), "product_platform_fk", "game_platform_fk",
            money("profit").alias("_profit"), money("valid_monetary").alias("_valid"),
        )
        .join(clock, "date_hour_fk")
        .groupBy("user_id", "product_platform_fk", "game_platform_fk", "month_num", "hour_num")
        .agg(F.sum("_profit").alias("_profit"), F.sum("_valid").alias("_valid"))
    )
    signs = users.select("user_id", "chinese_zodiac", "zodiac")
    keys = ["product_platform_fk", "game_platform_fk", "month_num", "hour_num", "chinese_zodiac", "zodiac"]
    return (
        per_user.join(signs, "user_id", "left")
        .groupBy(*keys)
        .agg(_rate("_profit", "_valid").alias("return_rate"))
        .select(
            F.col("product_platform_fk").alias("product_platform_sk"),
            F.col("game_platform_fk").alias("game_platform_sk"),
            "zodiac",
            "chinese_zodiac",
            F.col("month_num").alias("month"),
            two_hour_name("hour_num").alias("ancient_chinese_hour"),
            "return_rate",
            key_prefix("product_platform_fk").alias("product_id"),
            F.lit(load_time).alias("load_time"),
            F.lit(snapshot_date).alias("snapshot_date"),
        )
    )


GAME_DAY = ["product_id", "platform", "gametype", "exec_date"]


def intraday_return(orders: DataFrame) -> DataFrame:
    """Stakes and returns up to each five-minute bucket of the day, and their ratio.

    ``orders``: product_id, platform, gametype, billtime (text), account, cus_account, game_kind. The
    window runs over at most 288 buckets per game and day.
    """
    kinds = [str(k) for k in ELECTRONIC_KINDS]
    time = F.to_timestamp("billtime", "yyyy-MM-dd HH:mm:ss")
    account, won = money("account"), money("cus_account")
    buckets = (
        orders.where(F.col("game_kind").cast("string").isin(*kinds))
        .groupBy(
            "product_id", "platform", "gametype",
            F.substring_index("billtime", " ", 1).alias("exec_date"),
            five_minute_bucket(time).alias("plot_time_label"),
        )
        .agg(F.sum(account).alias("_stake"), F.sum(won + account).alias("_return"))
    )
    totals = running_sums(
        buckets, GAME_DAY, "plot_time_label", {"monetary": "_stake", "return": "_return"}
    )
    return totals.select(
        *GAME_DAY,
        "plot_time_label",
        F.col("monetary").cast("double").alias("monetary"),
        F.col("return").cast("double").alias("return"),
        ratio(F.col("return"), F.col("monetary")).alias("rate"),
    )


def return_stats(intraday: DataFrame, percentages: dict[str, float] | None = None) -> DataFrame:
    """Spread of the running rate per game and day, with exact percentiles over its buckets."""
    wanted = {"median": 0.5, **(percentages or {})}
    return (
        intraday.groupBy(*GAME_DAY)
        .agg(
            F.max("rate").alias("max"),
            F.min("rate").alias("min"),
            F.stddev_samp("rate").alias("std"),
            F.avg("rate").alias("avg"),
            F.percentile("rate", list(wanted.values())).alias("_p"),
        )
        .select(
            *GAME_DAY, "max", "min", "std", "avg",
            *[F.get("_p", F.lit(i)).alias(name) for i, name in enumerate(wanted)],
        )
    )
