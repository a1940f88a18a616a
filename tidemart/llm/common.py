"""Helpers shared by the operators on documents."""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_folder


# What an operator keeps in a Python worker from task to task, by operator and key.
_KEPT: dict[str, dict[Hashable, Any]] = {}
# About what an entry of a dictionary costs besides its key and value.
ENTRY_BYTES = 36


def begin(operator: str) -> None:
    """Called where a task of an operator begins: what other operators keep in this Python worker goes."""
    others = [name for name in _KEPT if name != operator]
    for name in others:
        del _KEPT[name]
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()


def kept(operator: str, key: Hashable, make: Callable[[], Any]) -> Any:
    """What `make` returned when a task of the operator asked for this key first; one key at a time is kept."""
    begin(operator)
    mine = _KEPT.setdefault(operator, {})
    if key not in mine:
        mine.clear()
        mine[key] = make()
    return mine[key]


def end(operator: str) -> None:
    """Called where a task of an operator ends: what it keeps for one task only goes.

    An idle Python worker's memory counts as the executor's, next to that of the JVM and of other workers.
    """
    for thing in _KEPT.get(operator, {}).values():
        if hasattr(thing, "forget"):
            thing.forget()
    pa.default_memory_pool().release_unused()


class Bounded(dict):
    """A dictionary that takes no more entries once they hold so many bytes."""

    def __init__(self, limit: int):
        self.limit = self.room = limit

    def forget(self) -> None:
        self.clear()
        self.room = self.limit

    def keep(self, key: Any, value: Any) -> None:
        if self.room > 0:
            self.room -= sys.getsizeof(key) + sys.getsizeof(value) + ENTRY_BYTES
            self[key] = value


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written as Parquet to a folder of their own in the shared scratch folder, and read from there."""
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the two columns an operator needs, a null text as empty; other columns cannot clash."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )


def held_out() -> F.Column:
    """True for the fifth of the documents that no model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, operator: str | None = None
) -> DataFrame:
    """`work` on each Arrow batch; one batch in, one batch out, so memory is bounded by the batch."""
    operator = operator or work.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(operator)
        try:
            for batch in batches:
                if batch.num_rows:
                    yield from in_pieces(batch, work)
        finally:
            end(operator)

    return df.mapInArrow(run, schema)


def in_pieces(batch: pa.RecordBatch, work: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = 2000):
    """A batch in slices, so that temporary arrays stay small next to the batch itself."""
    for start in range(0, batch.num_rows, rows):
        yield work(batch.slice(start, rows))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def keep_rows(docs: DataFrame, decide: Callable[[list[str]], list[bool]]) -> DataFrame:
    """Rows whose text `decide` keeps (a null one counts as empty), with all their columns and without a shuffle."""
    return map_batches(docs, lambda batch: batch.filter(pa.array(decide(_texts(batch)), pa.bool_())), docs.schema, decide.__module__)


def change_texts(docs: DataFrame, change: Callable[[list[str]], list[str]]) -> DataFrame:
    """All rows with what `change` makes of their texts; a null one stays null."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = batch.column("text").is_null().to_pylist()
        new = [None if null else t for null, t in zip(known, change(_texts(batch)))]
        return batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(new, pa.string()))

    return map_batches(docs, work, docs.schema, change.__module__)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that a plan scans; sources of unknown size, which Spark gives as huge, count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < 1 << 62)
