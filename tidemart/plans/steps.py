"""Process monitoring: enriched step events and their hourly fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import full_province
from ..functions.network import address_key
from ..functions.times import iso_hour, iso_millis
from ..operators.lookups import lookup_with_defaults
from ..operators.ordered import next_value
from ..operators.ranges import range_matches
from ..operators.uniques import ones, totals_and_uniques

# Text for anything unknown, the guest marker and the city suffix.
UNKNOWN = "未知"
GUEST = "null"
CITY_SUFFIX = "市"
PLACE = ("country", "province", "city")

DATA_SCHEMA = (
    "platform string, procedure_id string, customer_level string, hierarchy string, "
    "server_ip string, errCode string"
)
STEP_COLUMNS = (
    "product_id", "platform", "session_id", "procedure_id", "user_id", "star_level", "hierarchy",
    "tag_id", "page_url", "referer", "tag_name", "tag_step", "tag_detail", "click_time", "t_action",
    "app_id", "app_version", "device_type", "device_brand", "os_type", "os_version", "palcode", "isp",
    "mac", "network", "ip", "country", "province", "city", "server_ip", "server_country",
    "server_province", "server_city", "errCode", "load_time", "snapshot_date",
)
FACT_KEYS = (
    "product_id", "platform", "star_level", "hierarchy", "tag_name", "tag_step", "tag_detail",
    "tag_id", "page_url", "referer", "app_id", "app_version", "palcode", "os_type", "os_version",
    "country", "province", "city", "date_hour_sk",
)


def places_of(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """Country, province and city of the first address in each ``text``; texts without a place have no row.

    ``ranges``: ip_from, ip_to (see ``address_key``), country, province, city, not overlapping. Each distinct text is
    made a key and looked up once, however many rows and columns hold it.
    """
    keyed = texts.select("text").where("text is not null").distinct().withColumn("_key", address_key("text"))
    found = range_matches(keyed, "_key", ranges.select("ip_from", "ip_to", "country", "province", "city"), "ip_from", "ip_to")
    city = F.when(F.col("city").contains(CITY_SUFFIX), F.col("city")).otherwise(F.concat("city", F.lit(CITY_SUFFIX)))
    return found.select("text", "country", full_province("province").alias("province"), city.alias("city"))


def enrich_ips(df: DataFrame, addresses: dict[str, str], ranges: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Add country, province and city of the first address in each column; 未知 where there is none.

    ``addresses`` gives the column for each prefix of the new names. One table of places serves all of them; the facts
    meet it by equality of the raw text, where Spark splits a frequent one. ``texts`` may name the addresses from
    something cheaper to read than ``df``.
    """
    if texts is None:
        texts = df.select(F.explode(F.array(*addresses.values())).alias("text"))
    places = places_of(texts, ranges)
    for prefix, column in addresses.items():
        side = places.select(F.col("text").alias("_text"), *[F.col(c).alias(f"_{c}") for c in PLACE])
        named = {prefix + c: F.coalesce(f"_{c}", F.lit(UNKNOWN)) for c in PLACE}
        df = df.join(side, F.col(column) == F.col("_text"), "left").withColumns(named).drop("_text", *[f"_{c}" for c in PLACE])
    return df


def enrich_ip(df: DataFrame, ip: str, ranges: DataFrame, prefix: str = "") -> DataFrame:
    """The same for one column."""
    return enrich_ips(df, {prefix: ip}, ranges)


def action_seconds(df: DataFrame, **widths: int) -> DataFrame:
    """Add ``t_action``: seconds to the next step of the same session, procedure and tag name.

    Steps are taken in the order of step number, time and the remaining columns of the event; the
    last one gets 0.0.
    """
    timed = df.withColumn("_ms", iso_millis("click_time")).withColumn(
        "_tie", F.xxhash64("tag_id", "page_url", "referer", "user_id", "ip")
    )
    keys, order = ["session_id", "procedure_id", "tag_name"], ["tag_step", "_ms", "_tie"]
    return (
        next_value(timed, keys, order, F.col("_ms"), "_next", **{"tie_width": 1 << 50, **widths})
        .withColumn("t_action", F.coalesce((F.col("_next") - F.col("_ms")) / 1000.0, F.lit(0.0)))
        .drop("_ms", "_tie", "_next")
    )


def process_steps(
    staging: DataFrame, steps: DataFrame, ranges: DataFrame, load_time: str, **widths: int
) -> DataFrame:
    """Monitoring events with their JSON fields, configured step, step time and places.

    ``steps``: step_key, tag_name, tag_step, tag_detail (see ``step_config``). The key is the whole text
    ``tag_id,hierarchy,referer``, so a referer may hold commas; an event that lacks one of the three has no step.
    """
    data = F.from_json("data", DATA_SCHEMA)
    parsed = staging.withColumn("_d", data).select(
        *[c for c in staging.columns if c not in ("data", "depth", "agent", "event_time")],
        "_d.platform", "_d.procedure_id", "_d.hierarchy",
        F.col("_d.customer_level").cast("int").alias("star_level"),
        F.col("_d.errCode").cast("int").alias("errCode"),
        F.coalesce("_d.server_ip", "ip").alias("server_ip"),
        F.col("event_time").alias("click_time"),
        F.lit(load_time).alias("load_time"),
    )
    named = lookup_with_defaults(
        parsed.withColumn("step_key", F.concat_ws(",", "tag_id", "hierarchy", "referer")).withColumn(
            "step_key", F.when(F.concat("tag_id", "hierarchy", "referer").isNotNull(), F.col("step_key"))),
        steps, ["step_key"],
        {"tag_name": UNKNOWN, "tag_step": -1, "tag_detail": UNKNOWN},
    )
    timed = action_seconds(named, **widths)
    texts = parsed.select(F.explode(F.array("ip", "server_ip")).alias("text"))
    placed = enrich_ips(timed, {"": "ip", "server_": "server_ip"}, ranges, texts)
    return placed.select(*STEP_COLUMNS)


def process_hourly(steps: DataFrame, hours: DataFrame, load_time: str, day: str | None = None) -> DataFrame:
    """Page views, visitors, errors, terminations and action time per hour and step.

    The user id ``null`` is a guest. A termination is a last step without an error.
    """
    rows = steps.where(F.col("snapshot_date") == day) if day else steps
    keyed = rows.select(
        *[c for c in FACT_KEYS if c not in ("country", "province", "city", "date_hour_sk")],
        F.col("server_country").alias("country"),
        F.col("server_province").alias("province"),
        F.col("server_city").alias("city"),
        "user_id", "session_id", "t_action", "errCode", "snapshot_date",
        iso_hour("click_time").alias("full_date_hour"),
    ).join(hours.select("full_date_hour", "date_hour_sk", "hour_num"), "full_date_hour", "left")
    guest = F.coalesce(F.col("user_id") == GUEST, F.lit(False))
    error = F.col("errCode") == 1
    ended = (F.col("errCode") == 0) & (F.col("t_action") == 0.0)

    counted = totals_and_uniques(
        keyed,
        [*FACT_KEYS, "hour_num", "snapshot_date"],
        {
            "guest_pv": ones(guest),
            "mpv": ones(~guest),
            "err_pv": ones(error),
            "terminate_pv": ones(ended),
            "total_action_time": F.col("t_action").cast("decimal(18,3)"),
        },
        {
            "session_id": {"guest_uv": guest, "err_uv": error, "terminate_uv": ended},
            "user_id": {"muv": ~guest},
        },
    )
    return counted.select(
        *FACT_KEYS, "guest_pv", "guest_uv", "mpv", "muv", "err_pv", "err_uv", "terminate_pv",
        "terminate_uv", F.col("total_action_time").cast("double").alias("total_action_time"),
        "hour_num", F.lit(load_time).alias("load_time"), "snapshot_date",
    )
