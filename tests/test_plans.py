"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemart.functions import times
from tidemart.operators import ordered, ranges
from tidemart.plans import money, steps
from tidemart.sources.text import step_config
from workload import standins

SF = "/root/testdata/sf0.001"
STREAMS_AND_SINKS = ("stream", "sink", "config_kv", "csv_nullable")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in contract.queries() if not n.startswith(STREAMS_AND_SINKS)])
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "InPandas", "ArrowEvalPython"):
        assert bad not in text


def test_day_filter_reaches_the_scan(spark):
    text = plan(contract.queries()["scan_day"](spark, SF))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "props" not in re.search(r"ReadSchema: (\S+)", text)[1]


def test_partition_filter_prunes(spark, tmp_path):
    from tidemart.sources.tables import scan_range

    path = str(tmp_path / "t")
    spark.range(10).withColumn("dt", F.concat(F.lit("2024-01-0"), F.col("id") % 3 + 1)).write.partitionBy("dt").parquet(path)
    text = plan(scan_range(spark.read.parquet(path), "2024-01-02", "2024-01-03"))
    assert re.search(r"PartitionFilters: \[.*dt", text)


def test_only_the_needed_columns_are_read(spark):
    text = plan(contract.queries()["hedged_rounds"](spark, SF))
    assert set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>", text)[1])) == {"ts", "user_id", "event_type"}


@pytest.mark.parametrize(("limit", "combines"), [(32 << 20, 2), (0, 4)])
def test_log_lines_are_reduced_before_a_large_customer_join(spark, limit, combines):
    facts = money.deposit_hourly(
        standins.order_credits(spark, SF), standins.customers(spark, SF),
        times.hour_dim(spark, *standins.ORDER_DAYS), standins.currencies(spark), "now", broadcast_bytes=limit,
    )
    assert plan(facts).count("sum(total") == combines


def test_ordered_operators_scan_and_shuffle_their_rows_once(spark):
    rows = standins.table(spark, SF, "events").select("user_id", "event_id", "ts")
    found = ordered.previous_value(rows, ["user_id"], ["ts", "event_id"], F.col("ts"), "p")
    assert found.count() == rows.count()
    found.collect()
    text = plan(found)
    final = text[text.index("== Final Plan =="):text.index("== Initial Plan ==")]
    # One scan, and one exchange of rows by key and slice that both readers use; the borders have exchanges of their own.
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final
    assert "strategy=broadcast" not in text


def test_a_range_over_all_addresses_is_one_row(spark):
    points = spark.range(100).select(F.lpad(F.hex("id"), 32, "0").alias("p"))
    dim = spark.createDataFrame([("0" * 32, "f" * 32, 1)], "lo string, hi string, v int")
    found = ranges.range_lookup(points, "p", dim, "lo", "hi")
    assert "strategy=broadcast" not in found._jdf.queryExecution().analyzed().toString()
    assert found.where("v = 1").count() == 100


def test_addresses_are_looked_up_once_for_both_columns(spark):
    config = step_config(standins.step_lines(spark))
    found = steps.process_steps(standins.staging(spark, SF), config, standins.ip_ranges(spark), "now")
    text = found._jdf.queryExecution().optimizedPlan().toString()
    # The facts are planned once: the window inside slices is there for the rows and for the borders, that over borders once.
    assert text.count("Window [") == 3


def test_a_caller_that_needs_few_columns_reads_the_facts_once_too(spark):
    found = contract.queries()["process_hourly"](spark, SF)
    found.collect()
    text = plan(found)
    final = text[text.index("== Final Plan =="):text.index("== Initial Plan ==")]
    # The rows and the borders read one shuffle; beside the steps, a scan of two columns may name the addresses.
    assert final.count("FileScan parquet") <= 2 and "ReusedExchange" in final
