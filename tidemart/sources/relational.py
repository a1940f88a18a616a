"""Relational source: a daily snapshot of a table read over JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import iso_text

# Columns of the game catalog snapshot, in the order of the stored table.
GAME_COLUMNS = (
    "GameId", "GameProvider", "ProductId", "Display", "EnglishName", "ServerGameId", "ChineseName",
    "GameType", "GameStyle", "Paylines", "PlayerType", "Jackpot", "Trial", "Mobile", "Picture1",
    "Picture2", "Picture3", "Picture4", "Picture1_extension", "Likes", "MaxWinMultiple", "BetNumber",
    "MaxPrize", "PopularValue", "Score", "Star", "Remarks", "BonusUrl", "IsNew", "IsRecommend", "ID",
    "MarvelBonusUrl", "IsSpecialty", "Language", "IsHot", "IsPromotion", "createtime", "IsShare",
    "ShareType", "IsFree", "publish_state", "updateTime", "publishTime",
)
GAME_TIMES = ("createtime", "updateTime", "publishTime")


def snapshot_rows(
    df: DataFrame, columns: Sequence[str], times: Sequence[str], snapshot_date: str
) -> DataFrame:
    """Chosen columns with datetimes as ISO text, and the snapshot date as the last column."""
    return df.select(
        *[iso_text(c).alias(c) if c in times else F.col(c) for c in columns],
        F.lit(snapshot_date).alias("snapshot_date"),
    )


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """JDBC scan; Spark sends the column list and the filters to the database.

    With ``split_on`` and ``bounds`` the table is read by ``partitions`` tasks over ranges of a number.
    Credentials come from the caller's options.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if split_on and bounds:
        reader = reader.options(
            partitionColumn=split_on,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def read_game_snapshot(spark: SparkSession, url: str, table: str, snapshot_date: str, **options: object) -> DataFrame:
    """Daily snapshot of the game catalog; ``split_on``, ``bounds`` and ``partitions`` as in :func:`read_relational`."""
    source = read_relational(spark, url, table, **options)
    return snapshot_rows(source, GAME_COLUMNS, GAME_TIMES, snapshot_date)
