"""Hourly login counts, plain and by device, domain and platform.

Logins are counted per hour text first and the hour key is looked up on the counts, so the dimension
meets the small side and the only shuffle is that of the partial counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import (
    GATEWAY_HOSTS,
    NON_PLATFORM_LOGINS,
    WEB_LOGIN,
    known_device,
    login_domain,
)
from ..functions.keys import user_key
from ..functions.times import day_of_hour, iso_hour
from ..operators.lookups import strict_lookup
from .runs import Days, rows_of_run


def _counts(
    logins: DataFrame, hours: DataFrame, load_time: str, extra: dict[str, Column] | None = None
) -> DataFrame:
    extra = extra or {}
    counted = logins.groupBy(
        iso_hour("login_time").alias("full_date_hour"),
        user_key("product_id", "login_name").alias("user_fk"),
        *[c.alias(name) for name, c in extra.items()],
    ).agg(F.count(F.lit(1)).alias("login_count"))
    keyed = strict_lookup(
        counted, hours, F.col("full_date_hour"), "full_date_hour", "date_hour_sk", "date_hour_fk"
    )
    return keyed.select(
        F.col("date_hour_fk").cast("bigint").alias("date_hour_fk"),
        "user_fk",
        *extra,
        "login_count",
        F.lit(load_time).alias("load_time"),
        day_of_hour("full_date_hour").alias("dt"),
    )


def _web(logins: DataFrame, days: Days) -> DataFrame:
    return rows_of_run(logins.where(F.col("login_game") == WEB_LOGIN), "login_time", days)


def login_hourly(logins: DataFrame, hours: DataFrame, load_time: str, days: Days = None) -> DataFrame:
    """Web logins per hour and user."""
    return _counts(_web(logins, days), hours, load_time)


def login_device_hourly(
    logins: DataFrame, hours: DataFrame, load_time: str, days: Days = None
) -> DataFrame:
    """Web logins per hour, user and device; unknown devices count as -1."""
    return _counts(_web(logins, days), hours, load_time, {"login_device": known_device("device")})


def login_domain_hourly(
    logins: DataFrame,
    hours: DataFrame,
    load_time: str,
    days: Days = None,
    gateways: Sequence[str] = GATEWAY_HOSTS,
    strip_https: bool = True,
) -> DataFrame:
    """Web logins per hour, user and normalised domain."""
    domain = login_domain("domain", gateways, strip_https)
    return _counts(_web(logins, days), hours, load_time, {"login_domain": domain})


def login_platform_hourly(
    logins: DataFrame, hours: DataFrame, platforms: DataFrame, load_time: str, days: Days = None
) -> DataFrame:
    """Game-platform logins; the platform is looked up by its key without underscores.

    A login kind the dimension lacks is its own platform. Rows with no login kind are dropped.
    """
    rows = rows_of_run(
        logins.where(~F.col("login_game").isin(*NON_PLATFORM_LOGINS)), "login_time", days
    )
    dim = platforms.select(
        F.regexp_replace("id_sk", "_", "").alias("login_game"), F.col("platform").alias("_platform")
    )
    found = rows.join(dim, "login_game", "left")
    return _counts(
        found, hours, load_time, {"platform": F.coalesce(F.col("_platform"), F.col("login_game"))}
    )
