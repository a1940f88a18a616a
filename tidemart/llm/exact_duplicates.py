"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then a hash of the whole.

Texts are equal when they are identical after lower-casing A-Z only. Each round splits the groups of the round before
by a dearer key, and a document that is alone in its group leaves:

1. The first scan takes the length in bytes and a hash of the first `PREFIX` characters of each text. Lengths that one
   document has leave, then pairs of length and beginning that one document has; each is a count added up in the tasks.
2. The second scan hashes the whole text of the documents whose length and beginning survived, and of no others. Groups
   are counted by length and whole hash (SHA-256).

What survives goes to the tasks of the next step as a bitmap of at most `BITS` bits (16 MB, however many documents
there are), the place of a key being a hash of it. A key that survived always has its bit, so no duplicate is lost; a
document whose bit another key has set is hashed for nothing and found alone afterwards. Texts are never shuffled:
what moves are lengths, hashes and ids, added up before they move. A text that a third of the documents share is one
row of each task in the counts, and its rows in the join back are split by Spark's skew handling.

The documents of round 2 are written to the shared scratch folder with a number for each row, so a lost executor gets
the same rows again and exactly one row of a group stays.

Of equal texts the row with the largest id stays (a null id is the smallest; of rows with the same id and text one
stays). Null text counts as empty, empty texts are equal to each other. Every row of the input gives one row. Other
columns are ignored, whatever their names; an empty table gives an empty result. Memory does not grow with a text
beyond the one row that holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, stored

PREFIX = 256
BITS = 1 << 27
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _shared(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys that more than one row has."""
    return rows.groupBy(*keys).agg(F.count("*").alias("held")).where("held > 1").select(*keys)


def _marked(df: DataFrame, *keys: str) -> DataFrame:
    """Add the place of a key in the bitmap: its part, and the bit in the part."""
    place = F.pmod(F.xxhash64(*keys), F.lit(BITS))
    return df.withColumn("part", F.bitmap_bucket_number(place)).withColumn("bit", F.bitmap_bit_position(place))


def survivors(rows: DataFrame, *keys: str) -> DataFrame:
    """Bitmap of the keys that more than one of `rows` has, a row for each 32,768 bits of it."""
    return _marked(_shared(rows, *keys), *keys).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _with_survival(df: DataFrame, bitmap: DataFrame, *keys: str) -> DataFrame:
    """Add `open`: whether the key may be one of the bitmap. It has at most `BITS` bits, so its size does not depend on the documents."""
    byte = "cast(conv(hex(substring(bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)"
    open_ = F.expr(f"coalesce(getbit({byte}, cast(bit % 8 as int)) = 1, false)")
    return _marked(df, *keys).join(F.broadcast(bitmap), "part", "left").withColumn("open", open_).drop("part", "bit", "bits")


def exact_duplicates(docs: DataFrame, text_digest: bool = False) -> DataFrame:
    """`doc_id`, `keep_id`, `group_size` and `kept` of every row.

    `text_digest` adds `text_sha256`, the hash of the lower-cased text in UTF-8, for every row: all texts are read for it.
    """
    texts = id_and_text(docs)
    keyed = texts.withColumn("n_bytes", F.octet_length("text").cast("long")).withColumn(
        "beginning", F.xxhash64(normalised(F.substring("text", 1, PREFIX))))
    first = stored(keyed.select("n_bytes", "beginning"), "beginnings")
    crowded = _with_survival(first, survivors(first, "n_bytes"), "n_bytes").where("open")
    asked = _with_survival(keyed, survivors(crowded, "n_bytes", "beginning"), "n_bytes", "beginning")
    whole = F.sha2(normalised(F.col("text")), 256)
    hashed = asked.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_bytes", F.when(F.col("open"), whole).alias("hash"),
        *([whole.alias("text_sha256")] if text_digest else []),
    )
    hashed = stored(hashed, "hashed")
    extra = ["text_sha256"] if text_digest else []

    alone = hashed.where("hash is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *extra)
    asked = hashed.where("hash is not null")
    last = F.max(F.struct("doc_id", "row")).alias("last")
    # Written, so that the join has exchanges of its own, whose large partitions Spark can split.
    groups = stored(asked.groupBy("n_bytes", "hash").agg(F.count("*").alias("group_size"), last), "groups")
    placed = asked.join(groups, ["n_bytes", "hash"]).select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("last.row")).alias("kept"), *extra)
    return alone.unionAll(placed)
