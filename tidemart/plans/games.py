"""Daily statistics per game, product and platform, over bets and over users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import left_join_null_safe, money, ratio
from ..operators.statistics import exact_medians

GROUP = ["gametype", "product_id", "platform"]
GAME_KINDS = (5, 8)
MEDIAN_USERS = 100_000
MEDIANS = ["return_rate_median", "monetary_median", "cnt_median"]
# Names and order of the columns of the fact table.
OUTPUT = (
    "game_platform_sk", "product_platform_sk", "member_cnt", "monetary", "valid_monetary",
    "return_rate", "return_rate_mean", "return_rate_median", "return_rate_std", "return_rate_max",
    "return_rate_min", "return_max", "return_min", "bet_max", "bet_avg", "monetary_mean",
    "monetary_std", "monetary_median", "cnt_mean", "cnt_median", "cnt_std", "load_time",
    "snapshot_date",
)


def _per_user(rows: DataFrame) -> DataFrame:
    """One row per group and user; everything later is derived from these partial results."""
    return (
        rows.groupBy(*GROUP, "loginname")
        .agg(
            F.sum("_account").alias("_monetary"),
            F.sum("_valid").alias("_valid"),
            F.sum("_won").alias("_won"),
            F.count(F.lit(1)).alias("_bets"),
            F.max("_won").alias("_won_max"),
            F.min("_won").alias("_won_min"),
            F.max("_account").alias("_bet_max"),
        )
        .withColumn("_rate", ratio(-F.col("_won"), F.col("_valid")))
    )


def _user_values(users: DataFrame) -> DataFrame:
    """The three per-user values, of users with a defined rate only."""
    return users.where(F.col("_rate").isNotNull()).select(
        *GROUP,
        F.col("_rate").alias(MEDIANS[0]),
        F.col("_monetary").cast("double").alias(MEDIANS[1]),
        F.col("_bets").cast("double").alias(MEDIANS[2]),
    )


def game_group_stats(orders: DataFrame, most_users: int = MEDIAN_USERS) -> DataFrame:
    """All group and user statistics, without the dimension keys.

    One shuffle by (group, user) gives a row per user, and a second, map-side combined one gives the
    groups. Medians need all users of a group: groups of at most ``most_users`` rated users use the built-in
    aggregate, larger ones leave it out and use the distributed median. Both read the rows per user.
    """
    amounts = {"_account": "account", "_valid": "valid_account", "_won": "cus_account"}
    rows = orders.where(F.col("game_kind").isin(*GAME_KINDS)).select(
        *GROUP, "loginname", *[F.coalesce(money(c), money(F.lit(0))).alias(n) for n, c in amounts.items()]
    )
    per_user = _per_user(rows)
    sizes = per_user.groupBy(*GROUP).agg((F.count("_rate") > most_users).alias("_hot"))
    users = left_join_null_safe(per_user, sizes, GROUP)
    rated = F.col("_rate").isNotNull()

    def of_rated(value: Column) -> Column:
        return F.when(rated, value)

    staked = F.col("_monetary").cast("double")
    bets = F.col("_bets").cast("double")
    values = dict(zip(MEDIANS, (F.col("_rate"), staked, bets), strict=True))
    groups = users.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("member_cnt"),
        F.sum("_monetary").cast("double").alias("monetary"),
        F.sum("_valid").cast("double").alias("valid_monetary"),
        ratio(-F.sum("_won"), F.sum("_valid")).alias("return_rate"),
        F.avg("_rate").alias("return_rate_mean"),
        F.stddev_samp("_rate").alias("return_rate_std"),
        F.max("_rate").alias("return_rate_max"),
        F.min("_rate").alias("return_rate_min"),
        F.max("_won_max").cast("double").alias("return_max"),
        F.min("_won_min").cast("double").alias("return_min"),
        F.max("_bet_max").cast("double").alias("bet_max"),
        ratio(F.sum("_monetary"), F.sum("_bets")).alias("bet_avg"),
        ratio(F.sum(of_rated(F.col("_monetary"))), F.count("_rate")).alias("monetary_mean"),
        F.stddev_samp(of_rated(staked)).alias("monetary_std"),
        F.avg(of_rated(bets)).alias("cnt_mean"),
        F.stddev_samp(of_rated(bets)).alias("cnt_std"),
        *[F.median(F.when(rated & ~F.col("_hot"), v)).alias(m) for m, v in values.items()],
    )
    medians = exact_medians(_user_values(users.where(F.col("_hot"))), GROUP, MEDIANS)
    renamed = medians.select(*GROUP, *[F.col(m).alias(f"_{m}") for m in MEDIANS])
    return (
        left_join_null_safe(groups, renamed, GROUP)
        .withColumns({m: F.coalesce(F.col(m), F.col(f"_{m}")) for m in MEDIANS})
        .drop(*[f"_{m}" for m in MEDIANS])
    )


def game_daily_stats(
    orders: DataFrame,
    game_platforms: DataFrame,
    product_platforms: DataFrame,
    load_time: str,
    snapshot_date: str,
    most_users: int = MEDIAN_USERS,
) -> DataFrame:
    """The 23-column daily fact with the surrogate keys of game and product.

    ``orders``: gametype, product_id, platform, loginname, account, valid_account, cus_account,
    game_kind of one day. ``game_platforms``: id_sk, gametype, platform. ``product_platforms``: id_sk,
    product_id, platform.
    """
    games = game_platforms.select(F.col("id_sk").alias("game_platform_sk"), "gametype", "platform")
    products = product_platforms.select(
        F.col("id_sk").alias("product_platform_sk"), "product_id", "platform"
    )
    return (
        game_group_stats(orders, most_users)
        .join(games, ["gametype", "platform"], "left")
        .join(products, ["product_id", "platform"], "left")
        .withColumns({"load_time": F.lit(load_time), "snapshot_date": F.lit(snapshot_date)})
        .select(*OUTPUT)
    )
