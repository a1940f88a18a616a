"""Deposit missions: a gamma fit of daily deposits per user and a ladder of targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.codes import next_hundred
from ..functions.columns import money, ratio
from ..functions.keys import is_regular_user, key_prefix
from ..functions.times import days_before
from ..sinks.tables import replace_key

# Fixed values of the mission model.
THETA = 0.001
DELTA = 0.15
TOP_RATE = 0.05
MIN_DAYS, MANY_DAYS, NEW_USER_AGE = 1, 10, 30
LOGIN_DAYS, RECENT_LOGIN_DAYS, NET_DAYS = 30, 7, 90

STEP = "struct<step:int,deposit:bigint,bonus:bigint>"


def users_of_product(facts: DataFrame, product_id: str, first_day: str, last_day: str) -> DataFrame:
    """Rows of a product's regular users in a range of days."""
    return facts.where(
        F.col("dt").between(first_day, last_day)
        & (key_prefix("user_fk") == product_id)
        & is_regular_user("user_fk")
    )


def deposit_moments(deposits: DataFrame, since: str | None = None, sum_since: str | None = None) -> DataFrame:
    """Per user: number of deposit days, mean, sample variance and median of the daily deposits, and their sum.

    All but the sum take the days from ``since`` on, the sum those from ``sum_since`` on (all if not given),
    so one scan serves two look-backs. The median is that of the ranks in the daily rows, which a user has
    few of, and which are shuffled by user anyway.
    """
    daily = deposits.groupBy("user_fk", "dt").agg(F.sum(money("deposit_amount")).alias("_dep"))
    counts = F.col("dt") >= since if since else F.lit(True)
    summed = F.col("dt") >= sum_since if sum_since else F.lit(True)
    user = W.partitionBy("user_fk")
    ranked = daily.withColumn("_counts", counts).withColumns({
        "_days": F.count_if("_counts").over(user),
        "_rank": F.row_number().over(user.orderBy(F.desc("_counts"), "_dep")),
    })
    dep, days = F.when(F.col("_counts"), F.col("_dep").cast("double")), F.col("_days")
    middle = F.col("_rank").isin(F.floor((days + 1) / 2), F.floor(days / 2) + 1)
    return ranked.groupBy("user_fk").agg(
        F.count(dep).alias("cnt"),
        F.avg(dep).alias("mean"),
        F.var_samp(dep).alias("variance"),
        F.avg(F.when(middle, dep)).alias("dep_median"),
        F.sum(F.when(summed, F.col("_dep"))).alias("_in"),
    )


def active_days(logins: DataFrame, last_day: str, days: int = LOGIN_DAYS, recent: int = RECENT_LOGIN_DAYS) -> DataFrame:
    """Distinct login days in two look-backs that end on ``last_day``, in one pass."""
    first, first_recent = days_before(last_day, days - 1), days_before(last_day, recent - 1)
    return (
        logins.where(F.col("dt").between(first, last_day))
        .select("user_fk", "dt")
        .distinct()
        .groupBy("user_fk")
        .agg(
            F.count(F.lit(1)).alias("cnt_30"),
            F.count_if(F.col("dt") >= first_recent).alias("cnt_7"),
        )
    )


def net_profit_rate(deposits: DataFrame, withdrawals: DataFrame) -> DataFrame:
    """Share of the deposits that was not withdrawn again, per user with deposits."""
    put = deposits.groupBy("user_fk").agg(F.sum(money("deposit_amount")).alias("_in"))
    return _with_net_rate(put, withdrawals)


def _with_net_rate(put: DataFrame, withdrawals: DataFrame) -> DataFrame:
    """Add the sums and the rate to users with their deposits ``_in``; all are null without deposits."""
    taken = withdrawals.groupBy("user_fk").agg(F.sum(money("withdraw_amount")).alias("_out"))
    out = F.when(F.col("_in").isNotNull(), F.coalesce("_out", money(F.lit(0))))
    return put.join(taken, "user_fk", "left").withColumns({
        "dep_sum": F.col("_in").cast("double"),
        "withdraw_sum": out.cast("double"),
        "net_profit_rate": ratio(F.col("_in") - out, F.col("_in")),
    }).drop("_in", "_out")


def gamma_segments(moments: DataFrame) -> DataFrame:
    """Gamma parameters by moments and the two segment borders, rounded up to the next hundred.

    Users whose daily deposits do not vary are left out, as are borders that do not rise. A border beyond the
    whole numbers raises.
    """
    varying = moments.where(F.col("variance") != 0)
    alpha, beta, mode, median = (F.col(c) for c in ("alpha", "beta", "mode", "median"))
    raw = F.col("_raw")
    return (
        varying.withColumn("alpha", F.col("mean") * F.col("mean") / F.col("variance"))
        .withColumn("beta", F.col("mean") / F.col("variance"))
        .withColumn("mode", F.try_divide(alpha - 1, beta))
        .withColumn("median", F.try_divide(alpha * (15 * alpha - 4), beta * (15 * alpha + 1)))
        .withColumn(
            "_raw",
            F.when(alpha > 1, mode + F.try_divide(F.sqrt(alpha - 1), beta))
            .when(median > 0, median)
            .otherwise(F.try_divide(alpha, beta)),
        )
        .withColumn("_next", raw + F.try_divide(raw, beta * raw - alpha + 1))
        .withColumn("bdry", _whole_border("_raw"))
        .withColumn("next_bdry", _whole_border("_next"))
        .drop("_raw", "_next", "variance", "mean")
        .where(F.col("bdry") < F.col("next_bdry"))
    )


def _whole_border(raw: str) -> Column:
    """The next hundred, null only where the border itself is."""
    message = F.concat(F.lit("border beyond the whole numbers: "), F.col(raw).cast("string"))
    undefined = F.col(raw).isNull() | F.isnan(raw)
    return F.coalesce(next_hundred(raw), F.when(~undefined, F.raise_error(message).cast("bigint")))


def _ladder(low: Column, high: Column, net_rate: Column) -> Column:
    """The steps of a ladder: a fold, because each rate is computed from the one before."""
    steps = F.length(high.cast("string")) - 1
    first_rate = F.least(F.lit(TOP_RATE), (0.5 - THETA) * net_rate)

    def target(j: Column) -> Column:
        return next_hundred((j * high + (steps - j) * low) / steps.cast("double"))

    def whole(x: Column) -> Column:
        return x.cast("bigint") * 10 + 8

    def add(state: Column, j: Column) -> Column:
        t = target(j)
        carried = state["rate"] * state["target"] * (1 + DELTA) / t
        rate = F.when(j == 0, first_rate).otherwise(carried)
        bonus = whole(t * rate / 50)
        step = F.struct(
            j.cast("int").alias("step"),
            t.alias("deposit"),
            F.when(bonus <= 0, whole(t * 0.001)).otherwise(bonus).alias("bonus"),
        ).cast(STEP)
        return F.struct(
            t.alias("target"), rate.alias("rate"), F.concat(state["steps"], F.array(step)).alias("steps")
        ).cast(f"struct<target:bigint,rate:double,steps:array<{STEP}>>")

    start = F.struct(
        F.lit(0).cast("bigint").alias("target"),
        F.lit(0.0).alias("rate"),
        F.array().cast(f"array<{STEP}>").alias("steps"),
    )
    return F.aggregate(F.sequence(F.lit(0), steps), start, add, lambda s: s["steps"])


def ladder_text(steps: Column) -> Column:
    """``{"0":{"deposit":…,"bonus":…},…}`` with steps in ascending order."""
    entry = F.transform(
        steps,
        lambda s: F.struct(
            s["step"].cast("string"), F.struct(s["deposit"].alias("deposit"), s["bonus"].alias("bonus"))
        ),
    )
    return F.to_json(F.map_from_entries(entry))


def with_ladder(segments: DataFrame) -> DataFrame:
    """Add steps, their JSON text, the budget and the expected earnings."""
    net = F.coalesce("net_profit_rate", F.lit(0.0))

    def total(field: str) -> Column:
        return F.aggregate("steps", F.lit(0).cast("bigint"), lambda a, s: a + s[field])

    return (
        segments.withColumn("net_profit_rate", net)
        .withColumn("steps", _ladder(F.col("bdry"), F.col("next_bdry"), F.col("net_profit_rate")))
        .withColumn("missions", ladder_text(F.col("steps")))
        .withColumn("budget", total("bonus"))
        .withColumn("expected_earn", total("deposit") * F.col("net_profit_rate") - F.col("budget"))
    )


def mission_ladder(
    deposits: DataFrame,
    logins: DataFrame,
    withdrawals: DataFrame,
    users: DataFrame,
    product_id: str,
    run_date: str,
    renewal_days: int,
    net_days: int = NET_DAYS,
) -> DataFrame:
    """Missions of a product's regular users.

    All look-backs end the day before ``run_date``. Every input is reduced to a row per user before it
    is joined, so no join sees a frequent key. A user the user table lacks counts as new.
    """
    yesterday = days_before(run_date, 1)

    def since(facts: DataFrame, days: int) -> DataFrame:
        return users_of_product(facts, product_id, days_before(run_date, days), yesterday)

    ages = users.where(
        (F.col("dt") == yesterday)
        & (F.col("product_id") == product_id)
        & (F.col("customer_type") == 1)
        & is_regular_user("user_id")
    ).select(
        F.col("user_id").alias("user_fk"),
        F.datediff(F.lit(run_date).cast("date"), F.substring_index("register_time", "T", 1).cast("date")).alias("age"),
    )
    renewal, net = days_before(run_date, renewal_days), days_before(run_date, net_days)
    fit = (
        deposit_moments(since(deposits, max(renewal_days, net_days)), renewal, net)
        .where(F.col("cnt") > MIN_DAYS)
        .join(ages, "user_fk", "left")
        .join(active_days(since(logins, LOGIN_DAYS), yesterday), "user_fk", "left")
        .fillna(0, ["age", "cnt_30", "cnt_7"])
        .where((F.col("cnt") > MANY_DAYS) | (F.col("age") < NEW_USER_AGE))
    )
    segments = gamma_segments(_with_net_rate(fit, since(withdrawals, net_days)))
    return with_ladder(segments).select(
        F.col("user_fk").alias("user_id"),
        "beta", "alpha", "mode", "median", "bdry", "next_bdry", "missions", "budget",
        F.col("cnt").alias("dep_cnt"), F.col("age").alias("reg_act_days"),
        F.col("cnt_30").alias("active_30_days"), F.col("cnt_7").alias("active_7_days"),
        "dep_median",
        F.coalesce("dep_sum", F.lit(0.0)).alias("dep_sum"),
        F.coalesce("withdraw_sum", F.lit(0.0)).alias("withdraw_sum"),
        "net_profit_rate", "expected_earn",
        F.lit(product_id).alias("product_id"),
        F.lit(run_date).alias("dt"),
        F.lit(renewal_days).alias("renewal_period"),
    )


def store_missions(missions: DataFrame, table: str, product_id: str, run_date: str, renewal_days: int) -> None:
    """Replace the missions of one product, day and period; a rerun does not duplicate them."""
    replace_key(
        missions, table, {"product_id": product_id, "dt": run_date, "renewal_period": renewal_days}
    )
