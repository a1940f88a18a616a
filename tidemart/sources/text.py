"""Text sources: ``key=value`` lines, delimited lines with a typed schema, versioned config folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import col
from ..operators.lookups import as_of_version

# Product and version in a path: folder and file ``A01/20240105``, or folders with part files below them, as Spark writes
# them; the names of partition columns (``version=20240105``) are passed over.
VERSION_PATH = r"/(?:[^/=]+=)?([^/]+)/(?:[^/=]+=)?(\d{8})(?:/(?!\d{8}$)[^/]+)?$"


def key_values(lines: DataFrame, line: str = "value") -> DataFrame:
    """``key=value`` lines → ``key``, ``value``; the value keeps any further ``=``."""
    parts = F.split(F.col(line), "=", 2)
    others = [c for c in lines.columns if c != line]
    return lines.where(F.col(line).contains("=")).select(
        *others, F.get(parts, F.lit(0)).alias("key"), F.get(parts, F.lit(1)).alias("value")
    )


def exploded_values(pairs: DataFrame, name: str, item: str) -> DataFrame:
    """``key``, ``a,b,c`` → one distinct row per item."""
    others = [c for c in pairs.columns if c not in ("key", "value")]
    return pairs.select(
        *others, F.col("key").alias(name), F.explode(F.split("value", ",")).alias(item)
    ).distinct()


def read_tag_config(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``name=tag1,tag2`` → distinct (tag_name, tag)."""
    return exploded_values(key_values(spark.read.text(path)), "tag_name", "tag")


def read_versioned_tag_config(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a tag config: files named ``yyyymmdd`` in ``path/<product_id>/``.

    The version comes from the file name and the product from the folder, so every version is a row
    set of one scan and choosing one is a lookup (:func:`~tidemart.operators.lookups.as_of_version`).
    """
    file = F.col("_metadata.file_path")
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.element_at(F.split(file, "/"), -2).alias("product_id"),
        F.element_at(F.split(file, "/"), -1).try_cast("int").alias("version"),
        "value",
    )
    return exploded_values(key_values(lines.where(F.col("version").isNotNull())), "tag_name", "tag")


def config_versions(spark: SparkSession, path: str) -> DataFrame:
    """``product_id``, ``version`` and ``path`` of the version files below ``path``, from their listing alone.

    Only the paths are selected, so no file is opened. Files whose path tells no version are left out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    found = files.select(
        F.regexp_extract("path", VERSION_PATH, 1).alias("product_id"),
        F.regexp_extract("path", VERSION_PATH, 2).try_cast("int").alias("version"),
        "path",
    )
    return found.where(F.col("version").isNotNull())


def read_tag_config_as_of(spark: SparkSession, path: str, asked: DataFrame) -> DataFrame:
    """The tag config in force for each (``product_id``, ``day``) of ``asked``: its version, names and tags.

    The version is the greatest one that is not after the day; a day before the first version, a day or product that
    is null and an unknown product have no rows. Versions come from the listing, and only the chosen files are read: their
    paths pass through the driver, which holds the listing anyway.
    """
    versions = config_versions(spark, path)
    days = asked.select("product_id", "day").where("product_id is not null and day is not null").distinct()
    chosen = as_of_version(days, versions, ["product_id"], "day").where("version > 0")
    used = versions.join(chosen.select("product_id", "version").distinct(), ["product_id", "version"])
    paths = [row["path"] for row in used.select("path").collect()]
    lines = spark.read.text(paths) if paths else spark.createDataFrame([], "value string")
    source = F.col("_metadata.file_path") if paths else F.lit("")
    tagged = lines.select(
        F.regexp_extract(source, VERSION_PATH, 1).alias("product_id"),
        F.regexp_extract(source, VERSION_PATH, 2).try_cast("int").alias("version"),
        "value",
    )
    return chosen.join(exploded_values(key_values(tagged), "tag_name", "tag"), ["product_id", "version"])


def read_step_config(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``tag_id,hierarchy,referer=name,step,detail``."""
    return step_config(key_values(spark.read.text(path)))


def step_config(pairs: DataFrame) -> DataFrame:
    """``step_key`` (the whole text before the first ``=``) and the parts of the value, one row per key.

    The name counts even when the step is missing or no number; the detail only after a good step.
    """
    value = F.split("value", ",")
    step = F.get(value, F.lit(1)).try_cast("int")
    return (
        pairs.groupBy(F.col("key").alias("step_key"))
        .agg(F.max("value").alias("value"))
        .select(
            "step_key",
            F.get(value, F.lit(0)).alias("tag_name"),
            step.alias("tag_step"),
            F.when(step.isNotNull(), F.get(value, F.lit(2))).alias("tag_detail"),
        )
    )


def read_delimited(spark: SparkSession, path: str, schema: StructType | str, **options: str) -> DataFrame:
    """Delimited text with a given schema; a value that does not fit its type becomes null."""
    return spark.read.schema(schema).options(mode="PERMISSIVE", **options).csv(path)


def above_or_null(value: Column | str, bound: float) -> Column:
    """The value when it is above the bound, else null."""
    return F.when(col(value) > bound, col(value))
