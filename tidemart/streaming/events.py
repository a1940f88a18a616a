"""Streams of timed events: gaps between the events of a key, and counts per time window."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

MAX_BYTES_PER_TRIGGER = 1 << 30
INTERVAL = "20 seconds"
BATCHES_PER_MERGE = 50


def read_event_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    format: str = "parquet",
    max_bytes: int = MAX_BYTES_PER_TRIGGER,
    **options: str,
) -> DataFrame:
    """Stream of the files of a folder (or glob), oldest first.

    ``max_bytes`` bounds a micro-batch, and with it what one key can bring into one task.
    """
    return (
        spark.readStream.format(format)
        .schema(schema)
        .options(maxBytesPerTrigger=str(max_bytes), **options)
        .load(path)
    )


def timed_lines(lines: DataFrame) -> DataFrame:
    """``"<time> <value>"`` lines → time, value."""
    parts = F.split("value", " ")
    return lines.select(
        F.get(parts, F.lit(0)).try_cast("bigint").alias("time"), F.get(parts, F.lit(1)).alias("value")
    )


def gaps(
    events: DataFrame, key: str, time: str, tie: str, idle: int | None = None, delay: str = "1 hour"
) -> DataFrame:
    """Time since the previous event of the same key, across micro-batches; null on the first one.

    ``time`` and ``tie`` are whole numbers, ``key`` is a whole number or text. The state of a key is its
    greatest time so far. Within a micro-batch the events of a key are put in order; an event that arrives
    in a later batch than its successor gets a negative gap, as nothing waits for it, and leaves the state
    as it is.

    Without ``idle`` the state of a key is kept for ever. With it (``time`` in milliseconds then) an event more than
    ``idle`` after all earlier ones of its key counts as a first one, so the state of a key ends as soon as the watermark is
    that far past it, and the state holds the keys of that time only. The watermark is the greatest time less
    ``delay``; events at or before it when their batch begins are dropped.
    """
    columns = [key, time, tie]
    rows = events.select(*columns)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", gap bigint"
    if idle is not None:
        rows = rows.withColumn("_at", F.timestamp_millis(time)).withWatermark("_at", delay)

    def step(group: tuple, chunks: Iterator[Any], state: GroupState) -> Iterator[Any]:
        import numpy as np
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        parts = list(chunks)
        batch = parts[0] if len(parts) == 1 else pd.concat(parts)
        times, ties = batch[time].to_numpy(), batch[tie].to_numpy()
        order = np.lexsort((ties, times))
        times = times[order]
        first = state.get[0] if state.exists else times[0]
        gap = np.diff(times, prepend=first)
        missing = np.zeros(len(times), dtype=bool)
        missing[0] = not state.exists
        last = int(max(first, times[-1]))
        state.update((last,))
        if idle is not None:
            missing |= gap > idle
            state.setTimeoutTimestamp(max(last + idle, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame({
            key: batch[key].to_numpy()[order],
            time: times,
            tie: ties[order],
            "gap": pd.arrays.IntegerArray(gap, missing),
        })

    return rows.groupBy(key).applyInPandasWithState(
        step, schema, "last bigint", "append",
        GroupStateTimeout.NoTimeout if idle is None else GroupStateTimeout.EventTimeTimeout,
    )


def window_counts(
    events: DataFrame, time: str, keys: list[str], width: str = INTERVAL, delay: str | None = None
) -> DataFrame:
    """Events per tumbling window and keys.

    Every event counts, however late, and the state keeps every window. With ``delay`` windows older than
    that leave the state, and events that belong to them are no longer counted.
    """
    timed = events.withColumn("_time", F.col(time).cast("timestamp"))
    if delay:
        timed = timed.withWatermark("_time", delay)
    return (
        timed.groupBy(F.window("_time", width).alias("_window"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("_window.start").alias("window_start"), *keys, "n")
    )


def write_appended(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows to a parquet folder, once each, until the input is used up."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def write_changes(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the changed rows of every micro-batch in its own partition.

    A batch that is run again after a failure replaces its partition, so nothing is written twice.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_changes(changes: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The last written value per key of a folder of :func:`write_changes`."""
    return changes.groupBy(*keys).agg(F.max_by(value, "batch").alias(value))


def _counts(events: DataFrame, time: str, keys: list[str], width: str) -> DataFrame:
    window = F.window(F.col(time).cast("timestamp"), width)
    return events.groupBy(window["start"].alias("window_start"), *keys).agg(F.count(F.lit(1)).alias("n"))


def _merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy("window_start", *keys).agg(F.sum("n").alias("n"))


class _Parts:
    """The finished folders below a path: ``batch=N`` has the counts of a micro-batch, ``merged=N`` those of all up to N."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str) -> Any:
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def numbers(self, kind: str) -> list[int]:
        found = self.files.globStatus(self._at(f"{kind}=*/_SUCCESS")) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def current(self) -> list[str]:
        """The last merged folder and the batches after it."""
        last = max(self.numbers("merged"), default=-1)
        merged = [f"{self.path}/merged={last}"] if last >= 0 else []
        return merged + [f"{self.path}/batch={n}" for n in self.numbers("batch") if n > last]

    def drop_before(self, merged: int) -> None:
        """Remove what an earlier merged folder replaces, but not that folder, which a reader may have chosen."""
        kept = max((n for n in self.numbers("merged") if n < merged), default=-1)
        for kind, numbers in (
            ("batch", [n for n in self.numbers("batch") if n <= kept]),
            ("merged", [n for n in self.numbers("merged") if n < kept]),
        ):
            for n in numbers:
                self.files.delete(self._at(f"{kind}={n}"), True)


def write_window_parts(
    events: DataFrame, time: str, keys: list[str], path: str, checkpoint: str, width: str = INTERVAL,
    batches_per_merge: int = BATCHES_PER_MERGE,
) -> StreamingQuery:
    """Count the events of every micro-batch per window and keys, and keep the counts; see :func:`read_window_parts`.

    Counts add up, so the stream has no state: an event counts however late it is, and memory does not grow with
    the windows. Every ``batches_per_merge`` batches the folders are merged into one, and those that the merge before made
    needless go, so their number stays below twice that. A batch that is run again replaces its folder, and a merge that
    was finished is not made again. Finished folders are told by the marker that Spark's writer leaves.
    Events without a time are not counted.
    """

    def save(batch: DataFrame, number: int) -> None:
        parts = _Parts(batch.sparkSession, path)
        _counts(batch, time, keys, width).write.mode("overwrite").parquet(f"{path}/batch={number}")
        if (number + 1) % batches_per_merge:
            return
        if number not in parts.numbers("merged"):
            found = batch.sparkSession.read.parquet(*parts.current())
            _merged(found, keys).write.mode("overwrite").parquet(f"{path}/merged={number}")
        parts.drop_before(number)

    return (
        events.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_window_parts(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """``window_start``, the keys and ``n`` of all batches that :func:`write_window_parts` has finished."""
    return _merged(spark.read.parquet(*_Parts(spark, path).current()), keys)
