"""One callable per operator and job of the library, on the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import codes, times
from tidemart.operators import lookups, matching, ordered
from tidemart.plans import banks, funnel, games, logins, missions, money, returns, steps, streaks
from tidemart.session import prepared, scratch_folder
from tidemart.sinks import tables as sinks
from tidemart.sources import relational, tables, text
from tidemart.streaming import events as streams

from . import standins as t
from .standins import LOAD_TIME, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round result ratios, so that the last bits of a division do not matter in a comparison."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- scans and filters -------------------------------------------------------------------------


@query
def scan_day(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").where(tables.on_days("ts", "2024-01-15"))
    return rows.select("event_id", "user_id", "event_type", "value")


@query
def scan_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").where(
        tables.on_days("ts", "2024-01-05", "2024-01-25") & F.col("event_type").isin("click", "purchase")
    )
    return rows.select("event_id", "user_id", "event_type", "value")


@query
def time_window_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.events(spark, sf).where(times.iso_between("iso", "2024-01-10", "2024-01-12"))
    return rows.select("event_id", F.substring_index("iso", "+", 1).alias("local_time"))


@query
def hour_key(spark: SparkSession, sf: str) -> DataFrame:
    return (
        t.events(spark, sf).groupBy(times.iso_hour("iso").alias("full_date_hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- scalar functions --------------------------------------------------------------------------


@query
def scalar_text(spark: SparkSession, sf: str) -> DataFrame:
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.get(words, F.lit(0)).alias("first_word"),
        F.get(words, F.lit(3)).alias("fourth_word"),
        F.regexp_replace("p_brand", "#", "").alias("brand"),
        F.col("p_name").contains("bolt").alias("is_bolt"),
        F.substring("p_type", 1, 3).alias("type_code"),
        codes.base64_text(F.concat_ws(" / ", "p_name", "p_type", "p_brand", "p_name", "p_name", "p_name")).alias("label"),
        codes.int_or(F.substring_index("p_brand", "#", -1), -1).alias("brand_number"),
        codes.int_or("p_type", -1).alias("type_number"),
    )


@query
def scalar_time(spark: SparkSession, sf: str) -> DataFrame:
    e = t.events(spark, sf)
    midnight = F.concat("dt", F.lit("T00:00:00.000+08:00"))
    return e.select(
        "event_id",
        ((times.iso_millis("iso") - times.iso_millis(midnight)) / 1000.0).alias("seconds_of_day"),
        times.five_minute_bucket("ts").alias("bucket"),
        times.two_hour_name(F.hour("ts")).alias("two_hours"),
        times.iso_text("ts").alias("iso_seconds"),
        F.date_format(F.date_sub("dt", 7), "yyyy-MM-dd").alias("week_before"),
        F.datediff(F.lit("2024-02-01").cast("date"), F.col("dt").cast("date")).alias("age"),
    )


@query
def scalar_json(spark: SparkSession, sf: str) -> DataFrame:
    k = F.from_json("props", "k int")["k"]
    return table(spark, sf, "events").select(
        "event_id", k.alias("k"), F.to_json(F.struct(k.alias("k"), "event_type")).alias("props_out")
    )


@query
def scalar_codes(spark: SparkSession, sf: str) -> DataFrame:
    short = [s for names in codes.PROVINCE_ALIASES.values() for s in names] + ["abroad"]
    pick = F.element_at(F.array(*[F.lit(s) for s in short]), (F.col("o_orderkey") % len(short) + 1).cast("int"))
    logs = t.order_credits(spark, sf).select("trans_code", "sub_type", "amount", "customer_id")
    orders = table(spark, sf, "orders").select("o_orderkey", pick.alias("short_name"))
    names = orders.groupBy(codes.full_province("short_name").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    channels = logs.groupBy(codes.deposit_channel("trans_code", "sub_type").cast("string").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hundred = codes.next_hundred(F.greatest(F.col("amount").cast("double") - 100000, F.lit(0.0)))
    hundreds = logs.groupBy(hundred.cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return (
        names.withColumn("kind", F.lit("province"))
        .unionByName(channels.withColumn("kind", F.lit("channel")))
        .unionByName(hundreds.withColumn("kind", F.lit("hundred")))
    )


# --- hourly facts ------------------------------------------------------------------------------

WEB = "case event_type when 'click' then 'vipMember' else 'web' end"
PLATFORM = (
    "case event_type when 'view' then 'web' when 'click' then 'vipMember' when 'signup' then 'AGQJ'"
    " when 'purchase' then 'PT01' else 'other' end"
)


def _event_hours(spark: SparkSession) -> DataFrame:
    return times.hour_dim(spark, *t.EVENT_DAYS)


def _order_hours(spark: SparkSession) -> DataFrame:
    return times.hour_dim(spark, *t.ORDER_DAYS)


@query
def login_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return logins.login_hourly(t.logins(spark, sf, WEB), _event_hours(spark), LOAD_TIME)


@query
def login_device_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return logins.login_device_hourly(t.logins(spark, sf, WEB), _event_hours(spark), LOAD_TIME)


@query
def login_domain_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return logins.login_domain_hourly(
        t.page_logins(spark, sf), _event_hours(spark), LOAD_TIME, gateways=t.GATEWAYS
    )


@query
def login_platform_hourly(spark: SparkSession, sf: str) -> DataFrame:
    dim = tables.inline_table(spark, ["id_sk", "product_id", "platform"], t.PLATFORMS)
    return logins.login_platform_hourly(t.logins(spark, sf, PLATFORM), _event_hours(spark), dim, LOAD_TIME)


@query
def deposit_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return money.deposit_hourly(
        t.order_credits(spark, sf), t.customers(spark, sf), _order_hours(spark), t.currencies(spark), LOAD_TIME
    )


@query
def deposit_hourly_large(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a limit that the customers exceed, so that sums are joined instead of lines."""
    return money.deposit_hourly(
        t.order_credits(spark, sf), t.customers(spark, sf), _order_hours(spark), t.currencies(spark), LOAD_TIME,
        broadcast_bytes=0,
    )


@query
def deposit_hourly_days(spark: SparkSession, sf: str) -> DataFrame:
    """The daily runs of a range of days in one call."""
    return money.deposit_hourly(
        t.order_credits(spark, sf), t.customers(spark, sf), _order_hours(spark), t.currencies(spark), LOAD_TIME,
        days=("1997-01-01", "1998-06-30"),
    )


@query
def withdraw_hourly(spark: SparkSession, sf: str) -> DataFrame:
    logs = t.line_credits(spark, sf, {"N": "111200", "R": "111202", "A": "111205"})
    return money.withdraw_hourly(
        logs, t.suppliers(spark, sf), _order_hours(spark), t.currencies(spark), LOAD_TIME
    )


@query
def rebate_hourly(spark: SparkSession, sf: str) -> DataFrame:
    logs = t.line_credits(spark, sf, {"R": "112501", "A": "112501"})
    return money.rebate_hourly(
        logs, t.suppliers(spark, sf), _order_hours(spark), t.currencies(spark), LOAD_TIME
    )


@query
def dim_lookup_strict(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation")
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    owners = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    known = per_customer.join(owners, "o_custkey")
    misses = lookups.lookup_misses(owners, nations, "c_nationkey", "n_nationkey").agg(F.count(F.lit(1)))
    named = lookups.strict_lookup(known, nations, F.col("c_nationkey"), "n_nationkey", "n_name", "nation")
    return named.groupBy("nation").agg(F.sum("n").alias("orders")).withColumn("misses", misses.scalar())


# --- rates and statistics ----------------------------------------------------------------------


@query
def user_return_rate(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(returns.user_return_rate(t.line_bets(spark, sf), LOAD_TIME, "2024-01-31"), 9, "return_rate")


@query
def zodiac_return(spark: SparkSession, sf: str) -> DataFrame:
    rates = returns.zodiac_return(
        t.event_bets(spark, sf), _event_hours(spark), t.sign_users(spark, sf), LOAD_TIME, "2024-01-31"
    )
    return rounded(rates, 6, "return_rate")


@query
def game_daily_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _game_stats(spark, sf, games.MEDIAN_USERS)


def _game_stats(spark: SparkSession, sf: str, most_users: int) -> DataFrame:
    stats = games.game_daily_stats(
        t.game_orders(spark, sf), t.game_platforms(spark, sf), t.product_platforms(spark), LOAD_TIME, "2024-01-31", most_users
    )
    rates = ["return_rate", "return_rate_mean", "return_rate_median", "return_rate_std", "return_rate_max", "return_rate_min"]
    wide = ["bet_avg", "monetary_mean", "monetary_std", "monetary_median", "cnt_mean", "cnt_median", "cnt_std"]
    return rounded(rounded(stats, 9, *rates), 4, *wide)


@query
def game_daily_stats_large(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a limit that most groups exceed, so that the distributed median is used."""
    return _game_stats(spark, sf, 50)


@query
def intraday_return(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(returns.intraday_return(t.day_orders(spark, sf)), 9, "rate")


@query
def return_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = returns.return_stats(returns.intraday_return(t.day_orders(spark, sf)), {"q1": 0.25, "p95": 0.95})
    return rounded(stats, 6, "max", "min", "std", "avg", "median", "q1", "p95")


@query
def active_days(spark: SparkSession, sf: str) -> DataFrame:
    days = t.events(spark, sf).select(F.concat(F.lit("A01_r"), F.col("user_id")).alias("user_fk"), "dt")
    return missions.active_days(days, "2024-01-30")


@query
def net_profit_rate(spark: SparkSession, sf: str) -> DataFrame:
    put = t.line_deposits(spark, sf, ("N",), "deposit_amount")
    taken = t.line_deposits(spark, sf, ("R", "A"), "withdraw_amount")
    return rounded(missions.net_profit_rate(put, taken), 9, "net_profit_rate")


@query
def gamma_segments(spark: SparkSession, sf: str) -> DataFrame:
    moments = missions.deposit_moments(t.order_deposits(spark, sf)).where("cnt > 1").drop("_in")
    fit = missions.gamma_segments(moments)
    return rounded(rounded(fit, 6, "alpha", "mode", "median", "dep_median"), 12, "beta")


@query
def mission_ladder(spark: SparkSession, sf: str) -> DataFrame:
    facts = t.order_deposits(spark, sf)
    taken = facts.selectExpr("user_fk", "dt", "if(o_orderstatus = 'P', deposit_amount, 0) as withdraw_amount")
    ladder = missions.mission_ladder(
        facts, facts, taken, t.mission_users(spark, sf), "A01", t.MISSION_RUN, t.MISSION_DAYS, t.MISSION_DAYS
    )
    wide = rounded(ladder, 6, "alpha", "mode", "median", "dep_median", "net_profit_rate")
    return rounded(rounded(wide, 12, "beta"), 4, "expected_earn")


# --- sequences ---------------------------------------------------------------------------------


@query
def win_streak(spark: SparkSession, sf: str) -> DataFrame:
    found = streaks.win_streak(t.streak_bets(spark, sf), ["user_id"], ["ts", "event_id"])
    return streaks.streak_levels(found)


@query
def streak_report(spark: SparkSession, sf: str) -> DataFrame:
    """Streaks per day and user of one game's bets on a side, as the report read back from its files."""
    logs = t.streak_bets(spark, sf).withColumns({
        "dt": F.date_format("ts", "yyyy-MM-dd"), "product_id": F.lit("A01"), "platform": F.lit("AGQJ"),
        "gametype": F.lit("BAC"), "game_kind": F.lit(5),
    })
    bets = streaks.round_bets(logs, "A01", "AGQJ", "BAC", 5, *t.EVENT_DAYS)
    found = streaks.win_streak(bets, ["dt", "user_id"], ["ts", "event_id"], shortest=1)
    path = scratch_folder(spark, "report")
    streaks.write_streak_report(streaks.streak_levels(found, 1), path)
    day, length, user = streaks.REPORT_COLUMNS
    return spark.read.option("header", True).csv(path).select(
        F.col(day).alias("dt"), F.col(length).cast("int").alias("streak"), F.col(user).cast("bigint").alias("user_id")
    )


@query
def hedged_rounds(spark: SparkSession, sf: str) -> DataFrame:
    return streaks.hedged_rounds(t.streak_bets(spark, sf), ["user_id"])


@query
def event_gap(spark: SparkSession, sf: str) -> DataFrame:
    timed = table(spark, sf, "events").select(
        "event_id", "user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms")
    )
    found = ordered.previous_value(timed, ["user_id"], ["ms", "event_id"], F.col("ms"), "before")
    return found.select("event_id", "user_id", "ms", (F.col("ms") - F.col("before")).alias("gap"))


# --- funnel, process monitoring, cleansing -----------------------------------------------------


@query
def funnel_tags(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.funnel_tags(t.clicks(spark, sf), t.tag_config(spark))


@query
def config_kv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "config")
    lines = table(spark, sf, "part").select(F.concat("p_name", F.lit("="), "p_type", F.lit(","), "p_brand"))
    sinks.write_text(lines, path)
    return text.read_tag_config(spark, path)


@query
def asof_config(spark: SparkSession, sf: str) -> DataFrame:
    e = t.events(spark, sf)
    day_number = F.date_format("ts", "yyyyMMdd").cast("int")
    # Days without a large value are versions of the year 9999, which no day of the table reaches.
    versions = e.select("event_type", F.when(F.col("value") > 200, day_number).otherwise(99990101).alias("version"))
    daily = e.groupBy("event_type", "dt").agg(F.count(F.lit(1)).alias("n"))
    return lookups.as_of_version(daily, versions, ["event_type"], "dt")


@query
def asof_files(spark: SparkSession, sf: str) -> DataFrame:
    """Configs written as one folder per event type and version, read back as of every day of the events.

    A version is the Monday of every second week; it lists the numbers seen per remainder of the users.
    """
    path = scratch_folder(spark, "versions")
    e = t.events(spark, sf)
    monday = F.trunc("dt", "week")
    lines = (
        e.where(F.weekofyear(monday) % 2 == 0)
        .groupBy(
            F.col("event_type").alias("product_id"), F.date_format(monday, "yyyyMMdd").alias("version"),
            F.concat(F.lit("n"), F.col("user_id") % 7).alias("name"),
        )
        .agg(F.concat_ws(",", F.collect_set((F.col("event_id") % 11).cast("string"))).alias("tags"))
        .select("product_id", "version", F.concat("name", F.lit("="), "tags").alias("value"))
    )
    lines.write.partitionBy("product_id", "version").text(path)
    asked = e.select(F.col("event_type").alias("product_id"), F.col("dt").alias("day"))
    return text.read_tag_config_as_of(spark, path, asked)


@query
def process_steps(spark: SparkSession, sf: str) -> DataFrame:
    config = text.step_config(t.step_lines(spark))
    return steps.process_steps(t.staging(spark, sf), config, t.ip_ranges(spark), LOAD_TIME)


@query
def process_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return steps.process_hourly(process_steps(spark, sf), _event_hours(spark), LOAD_TIME)


@query
def ip_enrich(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.events(spark, sf).select("event_id", F.expr(t.IP_EXPR).alias("ip"))
    return steps.enrich_ip(rows, "ip", t.ip_ranges(spark))


@query
def keyword_canon(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("name"))
    rows = [(k, v, i) for i, (k, v) in enumerate(t.KEYWORDS)]
    words = tables.inline_table(spark, ["keyword", "canon", "place"], rows)
    found = matching.contained_names(parts, "name", words, "keyword", [F.col("place")]).select("name", "canon")
    return parts.join(found, "name", "left").select(
        "p_partkey",
        codes.replace_first_match("name", t.KEYWORDS).alias("by_list"),
        F.coalesce("canon", "name").alias("by_table"),
    )


@query
def bank_cleanse(spark: SparkSession, sf: str) -> DataFrame:
    return banks.bank_cleanse(
        t.bank_cards(spark, sf), t.bank_customers(spark, sf), t.cities(spark), LOAD_TIME
    )


# --- snapshots, text sources, generators -------------------------------------------------------


@query
def snapshot_copy(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    return relational.snapshot_rows(table(spark, sf, "orders"), columns, ["o_orderdate"], "2024-01-31")


@query
def csv_nullable(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "delimited")
    table(spark, sf, "customer").select("c_name", "c_acctbal").write.csv(path)
    rows = text.read_delimited(spark, path, "name string, balance double")
    return rows.select("name", text.above_or_null("balance", 1.0).alias("balance"))


@query
def explode_const(spark: SparkSession, sf: str) -> DataFrame:
    segments = table(spark, sf, "customer").select("c_mktsegment").distinct()
    numbers = F.array(*[F.lit(n) for n in (2, 5, 8)])
    return segments.select("c_mktsegment", F.lit("const").alias("name"), F.explode(numbers).alias("age"))


# --- sinks -------------------------------------------------------------------------------------


@query
def sink_dynamic_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Write all days, then twice again the last week with doubled values."""
    path = scratch_folder(prepared(spark), "fact")
    name = "fact_" + path.rsplit("-", 1)[1]
    rows = t.events(spark, sf).select("event_id", "value", "dt")
    sinks.create_partitioned_table(spark, name, rows, ["dt"], path)
    sinks.insert_overwrite(rows, name)
    late = rows.where("dt >= '2024-01-24'").select("dt", (F.col("value") * 2).alias("value"), "event_id")
    for _ in range(2):
        sinks.insert_overwrite(late, name)
    spark.sql(f"drop table {name}")  # external: the files stay until the folder goes
    return spark.read.parquet(path).select("event_id", "value", F.col("dt").cast("string").alias("dt"))


@query
def sink_replace_key(spark: SparkSession, sf: str) -> DataFrame:
    """Daily order totals per status, with the totals of one status replaced twice."""
    path = scratch_folder(prepared(spark), "replace")
    name = "replace_" + path.rsplit("-", 1)[1]
    rows = table(spark, sf, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.col("o_orderstatus").alias("product_id"),
        F.lit("2001-08-02").alias("dt"),
        F.lit(7).alias("renewal_period"),
    ).agg(F.count(F.lit(1)).alias("n"))
    key = ["product_id", "dt", "renewal_period"]
    sinks.create_partitioned_table(spark, name, rows, key, path)
    sinks.insert_overwrite(rows, name)
    again = rows.where("product_id = 'F'").withColumn("n", F.col("n") * 10)
    for _ in range(2):
        sinks.replace_key(again, name, {"product_id": "F", "dt": "2001-08-02", "renewal_period": 7})
    spark.sql(f"drop table {name}")
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return spark.read.parquet(path).select("day", "n", *[F.col(c).cast(kinds[c]).alias(c) for c in key])


@query
def sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Both exports of the intraday report, read back and counted together."""
    report = returns.intraday_return(t.day_orders(spark, sf)).select(
        *returns.GAME_DAY, "plot_time_label", "monetary", "return"
    )
    csv, json = scratch_folder(spark, "csv"), scratch_folder(spark, "json")
    sinks.write_csv_and_json(report, csv, json)
    both = (
        spark.read.schema(report.schema).option("header", True).csv(csv)
        .unionByName(spark.read.schema(report.schema).json(json))
    )
    return both.groupBy(*report.columns).agg(F.count(F.lit(1)).alias("copies"))


# --- streams -----------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    return streams.read_event_files(spark, f"{sf.rstrip('/')}/{{events}}.parquet", schema)


@query
def stream_gap(spark: SparkSession, sf: str) -> DataFrame:
    timed = _event_stream(spark, sf).select(
        "user_id", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms")
    )
    path = scratch_folder(spark, "gaps")
    streams.write_appended(streams.gaps(timed, "user_id", "ms", "event_id"), path, path + "-state").awaitTermination()
    return spark.read.parquet(path).select("event_id", "user_id", "ms", "gap")


@query
def stream_gap_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps of at most two hours; the events arrive in three parts, and the stream is started again for each."""
    source, path = scratch_folder(spark, "gap-files"), scratch_folder(spark, "gap-batches")
    timed = table(spark, sf, "events").select(
        "user_id", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), F.to_date("ts").alias("day")
    )
    borders = (None, *t.STREAM_BORDERS, None)
    for first, end in zip(borders, borders[1:], strict=False):
        part = timed.where(F.coalesce(F.col("day") >= F.lit(first), F.lit(True)) & F.coalesce(F.col("day") < F.lit(end), F.lit(True)))
        part.drop("day").write.mode("append").parquet(source)
        stream = streams.read_event_files(spark, source, timed.drop("day").schema)
        found = streams.gaps(stream, "user_id", "ms", "event_id", idle=t.STREAM_IDLE)
        streams.write_appended(found, path, path + "-state").awaitTermination()
    return spark.read.parquet(path).select("event_id", "user_id", "ms", "gap")


@query
def stream_window(spark: SparkSession, sf: str) -> DataFrame:
    counts = streams.window_counts(_event_stream(spark, sf), "ts", ["event_type"])
    path = scratch_folder(spark, "windows")
    streams.write_changes(counts, path, path + "-state").awaitTermination()
    latest = streams.latest_changes(spark.read.parquet(path), ["window_start", "event_type"], "n")
    return latest.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n"
    )


@query
def stream_window_late(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per 20 seconds of events that arrive in three parts, the latest days first; every two batches are merged."""
    source, path = scratch_folder(spark, "late-files"), scratch_folder(spark, "late-windows")
    events = table(spark, sf, "events").select("ts", "event_type", F.to_date("ts").alias("day"))
    borders = (None, *t.STREAM_BORDERS, None)
    for first, end in reversed(list(zip(borders, borders[1:], strict=False))):
        part = events.where(F.coalesce(F.col("day") >= F.lit(first), F.lit(True)) & F.coalesce(F.col("day") < F.lit(end), F.lit(True)))
        part.drop("day").write.mode("append").parquet(source)
        stream = streams.read_event_files(spark, source, events.drop("day").schema)
        streams.write_window_parts(stream, "ts", ["event_type"], path, path + "-state", batches_per_merge=2).awaitTermination()
    return streams.read_window_parts(spark, path, ["event_type"]).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n"
    )


@query
def stream_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of time and value as a text stream of several micro-batches, counted per minute."""
    source, path = scratch_folder(spark, "lines"), scratch_folder(spark, "line-windows")
    lines = table(spark, sf, "events").select(
        F.concat_ws(" ", F.unix_seconds(F.col("ts").cast("timestamp")), "event_type").alias("value"), "event_type")
    lines.repartition(4, "event_type").select("value").write.text(source)
    schema = spark.createDataFrame([], "value string").schema
    timed = streams.timed_lines(streams.read_event_files(spark, source, schema, "text", max_bytes=1))
    counts = streams.window_counts(timed.withColumn("ts", F.timestamp_seconds("time")), "ts", ["value"], width="1 minute")
    streams.write_changes(counts, path, path + "-state").awaitTermination()
    latest = streams.latest_changes(spark.read.parquet(path), ["window_start", "value"], "n")
    return latest.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "value", "n")
