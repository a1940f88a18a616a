"""Text times, hour keys and clock buckets."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .columns import col

# The text format of times and the names of the two-hour periods.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS"
ISO_OFFSET = "+08:00"
TWO_HOUR_NAMES = ("子", "丑", "寅", "卯", "辰", "巳", "午", "未", "申", "酉", "戌", "亥")
OTHER_HOUR = "其他"


def days_before(day: str, n: int) -> str:
    """The date ``n`` days before ``day``, both as ``yyyy-MM-dd``."""
    return (date.fromisoformat(day) - timedelta(days=n)).isoformat()


def iso_day(t: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm…`` → ``yyyy-MM-dd``; by position, which is several times faster than splitting."""
    return F.substring(col(t), 1, 10)


def iso_hour(t: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm…`` → ``yyyy-MM-dd-HH``."""
    return F.concat(F.substring(col(t), 1, 10), F.lit("-"), F.substring(col(t), 12, 2))


def day_of_hour(hour: Column | str) -> Column:
    """``yyyy-MM-dd-HH`` → ``yyyy-MM-dd``."""
    return F.substring(col(hour), 1, 10)


def iso_text(t: Column | str) -> Column:
    """Timestamp → ISO text in whole seconds with the fixed offset."""
    return F.concat(F.date_format(col(t), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000" + ISO_OFFSET))


def iso_millis(t: Column | str) -> Column:
    """Epoch milliseconds of an ISO text; null when it does not parse."""
    return F.unix_millis(F.try_to_timestamp(col(t), F.lit(ISO_PATTERN + "XXX")))


def iso_between(t: Column | str, first_day: str, last_day: str) -> Column:
    """Text time inside whole days, comparing the part before the offset.

    The comparison is made on the raw column so that it can be pushed to the scan: what follows the
    compared part is ``+…``, which sorts before every character a longer time could go on with, and
    ``,`` is the character after ``+``.
    """
    c = col(t)
    return (c >= f"{first_day}T00:00:00.000") & (c < f"{last_day}T23:59:59.999,")


def five_minute_bucket(t: Column | str) -> Column:
    """1..288 inside the day."""
    ts = col(t)
    return (12 * F.hour(ts) + F.floor(F.minute(ts) / 5) + 1).cast("int")


def two_hour_name(hour: Column | str) -> Column:
    """23 and 0 → 子, 1 and 2 → 丑, … 21 and 22 → 亥; anything else → 其他."""
    h = col(hour)
    names = F.array(*[F.lit(n) for n in TWO_HOUR_NAMES])
    slot = (F.floor((h + 1) / 2) % 12 + 1).cast("int")
    return F.when(h.between(0, 23), F.get(names, slot - 1)).otherwise(OTHER_HOUR)


def hour_dim(spark: SparkSession, first_day: str, last_day: str) -> DataFrame:
    """Hour dimension of a day range: 24 rows per day, with a ``yyyyMMddHH`` surrogate key."""
    hours = F.sequence(
        F.to_timestamp(F.lit(f"{first_day} 00:00:00")),
        F.to_timestamp(F.lit(f"{last_day} 23:00:00")),
        F.expr("interval 1 hour"),
    )
    h = F.col("h")
    return spark.range(1).select(F.explode(hours).alias("h")).select(
        F.date_format(h, "yyyy-MM-dd-HH").alias("full_date_hour"),
        F.date_format(h, "yyyyMMddHH").cast("int").alias("date_hour_sk"),
        F.hour(h).alias("hour_num"),
        F.month(h).alias("month_num"),
    )
