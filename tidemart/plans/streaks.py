"""Longest win streaks of users, with hedged rounds as breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import left_join_null_safe
from ..operators.ordered import longest_runs
from ..sinks.tables import write_csv

# The two sides of a round, the smallest stake that counts, and the reported lengths.
SIDES = (1, 2)
MIN_STAKE = 200
LONGEST, SHORTEST = 18, 5
REPORT_COLUMNS = ("日期", "连赢次数", "用户ID")


def round_bets(
    logs: DataFrame, product_id: str, platform: str, gametype: str, game_kind: int, first_day: str, last_day: str
) -> DataFrame:
    """Bets on a side of one game in a range of days; the range prunes the day partitions."""
    return logs.where(
        F.col("dt").between(first_day, last_day)
        & (F.col("product_id") == product_id)
        & (F.col("platform") == platform)
        & (F.col("gametype") == gametype)
        & (F.col("game_kind") == game_kind)
        & F.col("playtype").isin(*SIDES)
    )


def hedged_rounds(bets: DataFrame, keys: list[str], game: str = "gmcode") -> DataFrame:
    """Rounds in which a player bet on both sides: one combined row per player and round."""
    sides = [F.bool_or(F.coalesce(F.col("playtype") == s, F.lit(False))).alias(f"_side{s}") for s in SIDES]
    return (
        bets.groupBy(*keys, game).agg(*sides).where(F.col("_side1") & F.col("_side2")).select(*keys, game)
    )


def win_streak(
    bets: DataFrame,
    keys: list[str],
    order: list[str],
    game: str = "gmcode",
    min_stake: float = MIN_STAKE,
    longest: int = LONGEST,
    shortest: int = SHORTEST,
    **widths: int,
) -> DataFrame:
    """Longest streak per player, capped at ``longest``; shorter than ``shortest`` is left out.

    A loss or a hedged round ends a streak. A small stake or a zero result neither adds nor ends.
    ``keys`` is what identifies a player's sequence, such as (dt, user_id); ``order`` is a time and a
    tie-break.
    """
    hedged = hedged_rounds(bets, keys, game).withColumn("_hedged", F.lit(True))
    rows = left_join_null_safe(
        bets.select(*dict.fromkeys([*keys, game, *order, "account", "cus_account"])), hedged, [*keys, game]
    )
    won = F.coalesce(F.col("cus_account"), F.lit(0))
    stake = F.coalesce(F.col("account"), F.lit(0))
    reset = (won < 0) | F.coalesce(F.col("_hedged"), F.lit(False))
    hit = (stake >= min_stake) & (won != 0)
    runs = longest_runs(rows, keys, order, hit, reset, "streak", **widths)
    return runs.withColumn("streak", F.least("streak", F.lit(longest))).where(F.col("streak") >= shortest)


def streak_levels(streaks: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """One row for every length reached: a streak of 7 gives 5, 6 and 7."""
    return streaks.withColumn("streak", F.explode(F.sequence(F.lit(shortest), F.col("streak"))))


def write_streak_report(levels: DataFrame, path: str, day: Column | str = "dt", user: str = "user_id") -> None:
    """CSV report with its Chinese header, written by the executors."""
    names = dict(zip(REPORT_COLUMNS, (day, "streak", user), strict=True))
    write_csv(levels.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in names.items()]), path)
