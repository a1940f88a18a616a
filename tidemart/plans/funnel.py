"""Clickstream tag funnel: visitors and members per configured tag name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import base64_text, int_or
from ..functions.columns import col
from ..operators.lookups import as_of_version
from ..operators.uniques import ones, totals_and_uniques

# Name and game type of rows that only one side of the join has.
OTHER_TAG = "其他"
NO_GAME = "0"
COUNTS = (
    "visitors_count", "session_count", "member_count", "member_unique_count",
    "unique_session_member_count",
)


def visit_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Visitor and member counts of session_id and user_id; an empty user id is a visitor."""
    visitor = F.coalesce(F.col("user_id") == "", F.lit(False))
    return totals_and_uniques(
        rows,
        keys,
        {COUNTS[0]: ones(visitor), COUNTS[2]: ones(~visitor)},
        {"session_id": {COUNTS[1]: visitor, COUNTS[4]: ~visitor}, "user_id": {COUNTS[3]: ~visitor}},
    )


def split_label(label: Column | str) -> dict[str, Column]:
    """``name_stepN_detail`` → base64 name, step number (0 if none), base64 detail ('' if none)."""
    parts = F.split(col(label), "_")
    step = F.trim(F.regexp_replace(F.get(parts, F.lit(1)), "step", ""))
    return {
        "tag_name": base64_text(F.get(parts, F.lit(0))),
        "tag_step": int_or(step, 0),
        "tag_detail": F.coalesce(base64_text(F.get(parts, F.lit(2))), F.lit("")),
    }


def funnel_tags(
    clicks: DataFrame, config: DataFrame, runs: DataFrame | None = None, unique_per_name: bool = False
) -> DataFrame:
    """Funnel rows of many daily runs at once.

    ``clicks``: click_time, tag_id, session_id, user_id, p_id, game_type_sk, dt. ``config``:
    product_id, version, tag_name, tag. ``runs``: product_id, dt (default: all that have clicks); each
    run uses the latest config version not after its day. Tags without a config go to 其他, configured
    tags without clicks get zero counts. Unique counts are taken per tag and click day and added up over
    the tags of a name; ``unique_per_name=True`` counts a person once per name instead.
    """
    with_clicks = clicks.select(F.col("p_id").alias("product_id"), "dt").distinct()
    if runs is not None:
        clicks = clicks.join(
            runs.select(F.col("product_id").alias("p_id"), "dt").distinct(), ["p_id", "dt"], "left_semi"
        )
    days = (with_clicks if runs is None else runs.select("product_id", "dt")).distinct()
    chosen = as_of_version(days, config, ["product_id"], "dt")
    tags = (
        chosen.join(config, ["product_id", "version"])
        .select("product_id", "dt", "tag", "tag_name")
        .distinct()
    )
    rows = clicks.select(
        F.col("p_id").alias("product_id"), "dt", F.col("tag_id").alias("tag"),
        F.substring_index("click_time", "T", 1).alias("click_day"),
        F.col("game_type_sk").alias("game_type"), "session_id", "user_id",
    )
    run_tag, named = ["product_id", "dt", "tag"], ["product_id", "dt", "tag_name", "game_type"]
    if unique_per_name:
        known = rows.join(tags, run_tag, "left").fillna(OTHER_TAG, "tag_name")
        unseen = tags.join(rows.select(*run_tag).distinct(), run_tag, "left_anti")
        zeros = unseen.select(
            "product_id", "dt", "tag_name", F.lit(NO_GAME).alias("game_type"), *[F.lit(0).alias(c) for c in COUNTS]
        )
        counted = visit_counts(known, named).unionByName(zeros)
    else:
        counts = visit_counts(rows, [*run_tag, "click_day", "game_type"])
        counted = counts.join(tags, run_tag, "full").fillna(
            {"tag_name": OTHER_TAG, "game_type": NO_GAME, **dict.fromkeys(COUNTS, 0)}
        )
    summed = counted.groupBy(*named).agg(*[F.sum(c).alias(c) for c in COUNTS])
    return summed.select(
        *[c.alias(name) for name, c in split_label("tag_name").items()],
        *COUNTS,
        "game_type",
        "product_id",
        F.col("dt").alias("full_date"),
    )
