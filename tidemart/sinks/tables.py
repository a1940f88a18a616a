"""Table and file writers. A rerun of a job leaves the same table behind, except for the relational append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _balanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of a partition together, with large partitions split over several tasks at run time."""
    return df.hint("rebalance", *[F.col(c) for c in by]) if by else df.hint("rebalance")


def _require_dynamic(spark: SparkSession) -> None:
    """Inserts into a catalog table follow the session's overwrite mode, not an option of the writer.

    It is not switched around a write, as two jobs in one session would meet: the session has to be dynamic.
    """
    name = "spark.sql.sources.partitionOverwriteMode"
    if spark.conf.get(name).lower() != "dynamic":
        raise ValueError(f"set {name} to dynamic (see tidemart.session.prepared)")


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only those partitions of ``path`` that occur in ``df``."""
    (
        _balanced(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def create_partitioned_table(
    spark: SparkSession, table: str, like: DataFrame, by: Sequence[str], path: str
) -> None:
    """External parquet table with the columns of ``like``, partition columns last."""
    columns = [f for f in like.schema.fields if f.name not in by]
    columns += [like.schema[c] for c in by]
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    keys = ", ".join(f"`{c}`" for c in by)
    spark.sql(f"create table {table} ({spec}) using parquet partitioned by ({keys}) location '{path}'")


def insert_overwrite(df: DataFrame, table: str) -> None:
    """Dynamic partition overwrite of a catalog table.

    The columns are put into the order of the table by name first, because the insert itself goes by
    position.
    """
    spark = df.sparkSession
    _require_dynamic(spark)
    target = spark.table(table)
    by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    aligned = _balanced(df.select(*target.columns), by)
    aligned.write.insertInto(table, overwrite=True)


def replace_key(df: DataFrame, table: str, key: dict[str, str | int]) -> None:
    """Replace all rows of one key of a table partitioned by it, also when ``df`` has none.

    ``key`` names all partition columns: a full partition is replaced alone in either mode.
    """
    spark = df.sparkSession
    _require_dynamic(spark)
    rest = [c for c in spark.table(table).columns if c not in key]
    spec = ", ".join(f"`{k}` = {v!r}" for k, v in key.items())
    spark.sql(
        f"insert overwrite table {table} partition ({spec}) select * from {{rows}}",
        rows=_balanced(df.select(*rest), []),
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header, replacing the folder."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, replacing the folder."""
    df.write.mode("overwrite").json(path)


def write_csv_and_json(df: DataFrame, csv_path: str, json_path: str) -> None:
    """Both exports from one computation of the result."""
    kept = df.persist()
    try:
        write_csv(kept, csv_path)
        write_json(kept, json_path)
    finally:
        kept.unpersist()


def write_text(df: DataFrame, path: str) -> None:
    """One text column as lines."""
    df.write.mode("overwrite").text(path)


def append_relational(df: DataFrame, url: str, table: str, connections: int = 8, **options: str) -> None:
    """Append rows to a relational table over a bounded number of connections; a rerun appends them again."""
    (
        df.repartition(connections)
        .write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .options(**options)
        .save()
    )
