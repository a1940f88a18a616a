"""Sources, sinks and streams."""

import random

import pytest
from pyspark.sql import functions as F

from tidemart.session import scratch_folder
from tidemart.sinks import tables as sinks
from tidemart.sources import relational, tables, text
from tidemart.streaming import events as streams


def test_key_values(spark, rows):
    lines = spark.createDataFrame([("a=1,2",), ("b=x=y",), ("nothing",), ("a=2,3",)], "value string")
    pairs = text.key_values(lines)
    assert rows(pairs) == [("a", "1,2"), ("a", "2,3"), ("b", "x=y")]
    assert rows(text.exploded_values(pairs, "name", "tag")) == [("a", "1"), ("a", "2"), ("a", "3"), ("b", "x=y")]


def test_versioned_config(spark, rows, tmp_path):
    for product, version, line in [("A01", "20180401", "n=t1,t2"), ("A01", "20180501", "m=t1"), ("A02", "20180401", "k=t9"), ("A02", "readme", "x=y")]:
        folder = tmp_path / product
        folder.mkdir(exist_ok=True)
        (folder / version).write_text(line + "\n")
    found = text.read_versioned_tag_config(spark, str(tmp_path))
    assert rows(found, "product_id", "version", "tag_name", "tag") == [
        ("A01", 20180401, "n", "t1"), ("A01", 20180401, "n", "t2"), ("A01", 20180501, "m", "t1"), ("A02", 20180401, "k", "t9"),
    ]


VERSIONS = [
    ("A01", "20180401", "n=t1,t2"), ("A01", "20180501", "m=t1"), ("A02", "20180401", "k=t9"), ("A02", "readme", "x=y"),
    ("20180402", "20180403", "z=t5"), ("A02", "20180601", "no pair"),
]


def write_versions(folder):
    for product, version, line in VERSIONS:
        (folder / product).mkdir(exist_ok=True)
        (folder / product / version).write_text(line + "\n")
    part = folder / "product_id=A03" / "version=20180401"
    part.mkdir(parents=True)
    (part / "part-00000.txt").write_text("p=t7\n")


def test_config_as_of_days(spark, rows, tmp_path):
    write_versions(tmp_path)
    asked = [
        ("A01", "2018-03-31"), ("A01", "2018-04-01"), ("A01", "2018-04-30"), ("A01", "2018-05-01"), ("A01", "2018-05-01"),
        ("A02", "2018-05-31"), ("A02", "2018-06-01"), ("A03", "2019-01-01"), ("A09", "2019-01-01"), ("20180402", "2019-01-01"),
        (None, "2019-01-01"), ("A01", None),
    ]
    found = text.read_tag_config_as_of(spark, str(tmp_path), spark.createDataFrame(asked, "product_id string, day string"))
    assert rows(found, "product_id", "day", "version", "tag_name", "tag") == [
        ("20180402", "2019-01-01", 20180403, "z", "t5"),
        ("A01", "2018-04-01", 20180401, "n", "t1"), ("A01", "2018-04-01", 20180401, "n", "t2"),
        ("A01", "2018-04-30", 20180401, "n", "t1"), ("A01", "2018-04-30", 20180401, "n", "t2"),
        ("A01", "2018-05-01", 20180501, "m", "t1"), ("A02", "2018-05-31", 20180401, "k", "t9"),
        ("A03", "2019-01-01", 20180401, "p", "t7"),
    ]
    none = text.read_tag_config_as_of(spark, str(tmp_path), spark.createDataFrame([("A09", "2019-01-01")], "product_id string, day string"))
    assert none.columns == found.columns and none.count() == 0


def test_only_the_chosen_versions_are_read(spark, tmp_path):
    write_versions(tmp_path)
    assert text.config_versions(spark, str(tmp_path)).count() == 6
    asked = spark.createDataFrame([("A01", "2018-05-02")], "product_id string, day string")
    found = text.read_tag_config_as_of(spark, str(tmp_path), asked)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = [line for line in scans if "FileScan text" in line]
    assert len(read) == 1 and "InMemoryFileIndex(1 paths)" in read[0] and "A01/20180501]" in read[0]
    assert all("ReadSchema: struct<path:string>" in line for line in scans if line not in read)
    assert found.count() == 1


def test_step_config_file(spark, rows, tmp_path):
    (tmp_path / "steps.conf").write_text("t,h,r=name,3,detail\n")
    assert rows(text.read_step_config(spark, str(tmp_path / "steps.conf"))) == [("t,h,r", "name", 3, "detail")]


def test_delimited(spark, rows, tmp_path):
    (tmp_path / "people.csv").write_text("ann,30\nbob,0.5\ncid,old\n")
    found = text.read_delimited(spark, str(tmp_path), "name string, age float")
    assert rows(found.select("name", text.above_or_null("age", 1).alias("age"))) == [("ann", 30.0), ("bob", None), ("cid", None)]


def test_snapshot_projection(spark, rows):
    df = spark.sql("select 1 as id, timestamp'2018-04-15 01:02:03' as t, cast(null as timestamp) as u")
    assert rows(relational.snapshot_rows(df, ["u", "id", "t"], ["t", "u"], "2018-04-16")) == [(None, 1, "2018-04-15T01:02:03.000+08:00", "2018-04-16")]
    assert len(relational.GAME_COLUMNS) == 43


def test_inline_table(spark, rows):
    df = tables.inline_table(spark, ["a", "b"], [("it's", 1), ("back\\slash", None)])
    assert sorted(rows(df)) == [("back\\slash", None), ("it's", 1)]


def test_insert_goes_by_name_and_keeps_other_partitions(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2")], "n int, s string, dt string")
    sinks.create_partitioned_table(spark, "t_insert", df.select("dt", "s", "n"), ["dt"], str(tmp_path / "t"))
    sinks.insert_overwrite(df, "t_insert")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for _ in range(2):
        sinks.insert_overwrite(spark.createDataFrame([("d2", 9, "z")], "dt string, n int, s string"), "t_insert")
    assert rows(spark.table("t_insert"), "n", "s", "dt") == [(1, "a", "d1"), (9, "z", "d2")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    spark.sql("drop table t_insert")


def test_overwrite_partitions_of_a_path(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "d1"), (2, "d2")], "n int, dt string")
    sinks.overwrite_partitions(df, path, ["dt"])
    for _ in range(2):
        sinks.overwrite_partitions(df.where("dt = 'd2'").withColumn("n", F.lit(7)), path, ["dt"])
    assert rows(spark.read.parquet(path), "n", "dt") == [(1, "d1"), (7, "d2")]


def test_exports(spark, rows, tmp_path):
    df = spark.createDataFrame([("x,1", None, 0.5), ("名", 2, None)], "s string, n int, d double")
    csv, json = str(tmp_path / "csv"), str(tmp_path / "json")
    for _ in range(2):
        sinks.write_csv_and_json(df, csv, json)
    assert rows(spark.read.schema(df.schema).option("header", True).csv(csv)) == rows(df)
    assert rows(spark.read.schema(df.schema).json(json)) == rows(df)


def test_scratch_folder_is_new_each_time(spark):
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")


def loop_gaps(batches):
    last, out = {}, []
    for batch in batches:
        for user, t, i in sorted(batch, key=lambda e: (e[1], e[2])):
            out.append((i, t - last[user] if user in last else None))
            last[user] = t
    return sorted(out, key=repr)


def test_stream_gaps_over_batches_and_a_restart(spark, rows, tmp_path):
    rnd = random.Random(1)
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "user_id long, t long, id long"
    batches, number = [], 0
    for start in (0, 1000, 2000):
        batch = []
        for _ in range(80):
            batch.append((0 if rnd.random() < 0.4 else rnd.randrange(5), start + rnd.randrange(1000), number))
            number += 1
        batches.append(batch)
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = streams.read_event_files(spark, source, spark.createDataFrame([], schema).schema)
        streams.write_appended(streams.gaps(stream, "user_id", "t", "id"), out, state).awaitTermination()
    assert rows(spark.read.parquet(out), "id", "gap") == loop_gaps(batches)


def test_stream_gaps_forget_idle_keys(spark, rows, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema, hour = "user_id long, t long, id long", 3_600_000
    kept = []
    # Keys 1 and 2 come once; key 3 comes again within the idle time, at its very end, one after it, and long after its state has ended.
    batches = [
        [(1, hour, 0), (2, hour, 1), (3, hour, 2), (3, 2 * hour, 3)], [(3, 4 * hour, 4), (3, 6 * hour + 1, 5)],
        [(4, 20 * hour, 6)], [(4, 20 * hour + 5, 7), (3, 20 * hour + 7, 8)], [(5, 60 * hour, 9)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = streams.read_event_files(spark, source, spark.createDataFrame([], schema).schema)
        query = streams.write_appended(streams.gaps(stream, "user_id", "t", "id", idle=2 * hour), out, state)
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert rows(spark.read.parquet(out), "id", "gap") == [
        (0, None), (1, None), (2, None), (3, hour), (4, 2 * hour), (5, None), (6, None), (7, 5), (8, None), (9, None)]
    assert max(kept) <= 3 and kept[-1] == 1


def test_stream_windows_over_batches(spark, rows, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "ts timestamp, kind string"
    for minute in ("00", "01"):
        stamps = [f"2024-01-01 00:{minute}:{s:02d}" for s in range(0, 60, 7)] + ["2024-01-01 00:00:05"]
        batch = spark.createDataFrame([(s, "a") for s in stamps], "ts string, kind string").select(F.to_timestamp("ts").alias("ts"), "kind")
        batch.coalesce(1).write.mode("append").parquet(source)
        stream = streams.read_event_files(spark, source, spark.createDataFrame([], schema).schema)
        streams.write_changes(streams.window_counts(stream, "ts", ["kind"]), out, state).awaitTermination()
    found = streams.latest_changes(spark.read.parquet(out), ["window_start", "kind"], "n")
    want = spark.read.parquet(source).groupBy(F.window("ts", "20 seconds")["start"].alias("window_start"), "kind").agg(F.count("*").alias("n"))
    assert rows(found, "window_start", "kind", "n") == rows(want, "window_start", "kind", "n")
    assert found.agg(F.sum("n")).first()[0] == 20


def test_window_parts_lose_nothing_and_stay_few(spark, rows, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], "ts timestamp, kind string").schema
    days = ["2024-01-05", "2024-01-05", "2024-01-01", "2023-06-01", "2024-01-09", "2024-01-05", "2024-01-02"]
    for i, day in enumerate(days):
        batch = spark.createDataFrame([(f"{day} 00:00:{s:02d}", k) for s in (0, 19, 20) for k in ("a", None)] + [(None, "a")], "s string, kind string")
        batch.select(F.to_timestamp("s").alias("ts"), "kind").coalesce(1).write.mode("append").parquet(source)
        stream = streams.read_event_files(spark, source, schema)
        query = streams.write_window_parts(stream, "ts", ["kind"], out, state, batches_per_merge=2)
        query.awaitTermination()
        assert not query.lastProgress["stateOperators"]
        want = spark.read.parquet(source).where("ts is not null").groupBy(F.window("ts", "20 seconds")["start"].alias("window_start"), "kind")
        found = streams.read_window_parts(spark, out, ["kind"])
        assert rows(found, "window_start", "kind", "n") == rows(want.agg(F.count("*").alias("n")), "window_start", "kind", "n")
        assert len([f for f in (tmp_path / "out").iterdir() if f.is_dir()]) <= 5
    # A merge that broke off before it was finished is not read.
    before = rows(found)
    (tmp_path / "out" / "merged=99").mkdir()
    assert rows(streams.read_window_parts(spark, out, ["kind"])) == before


def test_timed_lines(spark, rows):
    lines = spark.createDataFrame([("12 a",), ("x b",), ("13",)], "value string")
    assert rows(streams.timed_lines(lines)) == [(12, "a"), (13, None), (None, "b")]


@pytest.mark.parametrize(("first", "last", "n"), [("2024-01-15", None, 2), ("2024-01-14", "2024-01-15", 3)])
def test_on_days(spark, first, last, n):
    stamps = ["2024-01-14 23:59:59", "2024-01-15 00:00:00", "2024-01-15 23:59:59.999999", "2024-01-16 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    assert df.where(tables.on_days("ts", first, last)).count() == n
