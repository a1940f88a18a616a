"""Dimension lookups: strict (a miss stops the job), defaulted, and as-of a version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def one_row_per_key(dim: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Make a lookup unable to multiply rows: the greatest value of each key."""
    return dim.groupBy(*keys).agg(F.max(value).alias(value))


def strict_lookup(
    df: DataFrame, dim: DataFrame, key: Column, dim_key: str, value: str, out: str
) -> DataFrame:
    """Add ``out`` = the dimension's ``value`` for ``key``; a key the dimension lacks raises.

    A key that the dimension repeats counts once, with its greatest value, so facts are never multiplied.

    The check is a condition on the joined row, so it holds whether or not ``out`` is used later.
    No broadcast hint: Spark broadcasts the dimension when its size allows, and otherwise joins by
    sorting, with skewed keys split at run time.
    """
    side = dim.select(F.col(dim_key).alias("_dim_key"), F.col(value).alias("_dim_value"))
    side = one_row_per_key(side, ["_dim_key"], "_dim_value")
    keyed = df.withColumn("_key", key)
    message = F.concat(
        F.lit(f"no {value} for {dim_key} = "), F.coalesce(F.col("_key").cast("string"), F.lit("null"))
    )
    found = F.when(F.col("_dim_value").isNotNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    return (
        keyed.join(side, F.col("_key") == F.col("_dim_key"), "left")
        .where(found)
        .withColumn(out, F.col("_dim_value"))
        .drop("_key", "_dim_key", "_dim_value")
    )


def lookup_misses(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Rows whose key the dimension lacks (null keys included)."""
    side = dim.select(F.col(dim_key).alias("_dim_key")).distinct()
    return df.join(side, F.col(key) == F.col("_dim_key"), "left_anti")


def lookup_with_defaults(
    df: DataFrame, dim: DataFrame, keys: list[str], defaults: dict[str, object]
) -> DataFrame:
    """Left join on equally named ``keys``; a missing value of ``dim`` becomes its default."""
    joined = df.join(dim.select(*keys, *defaults), keys, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def as_of_version(
    df: DataFrame,
    versions: DataFrame,
    keys: list[str],
    at: str,
    version: str = "version",
    default: int = 0,
) -> DataFrame:
    """Add the greatest ``version`` that is not after ``at``, per ``keys``; ``default`` if none.

    The distinct ``(keys, at)`` pairs and the versions are merged in one ordered pass, so there is no
    range condition in a join; the pairs are then looked up by equality.
    """
    wanted = df.select(*keys, F.col(at).alias("_at")).distinct()
    asked = wanted.select(
        *keys, "_at", F.regexp_replace(F.col("_at").cast("string"), "-", "").cast("int").alias("_n"),
        F.lit(None).cast("int").alias("_v"),
    )
    known = versions.select(
        *keys, F.lit(None).cast(wanted.schema["_at"].dataType).alias("_at"),
        F.col(version).cast("int").alias("_n"), F.col(version).cast("int").alias("_v"),
    ).distinct()
    order = W.partitionBy(*keys).orderBy("_n").rangeBetween(W.unboundedPreceding, 0)
    found = (
        asked.unionByName(known)
        .withColumn("_best", F.coalesce(F.max("_v").over(order), F.lit(default)))
        .where(F.col("_at").isNotNull())
        .select(*keys, F.col("_at").alias(at), F.col("_best").alias(version))
    )
    return df.join(found, [*keys, at], "left")
