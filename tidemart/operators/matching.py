"""Matching a text against a table of names it may contain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Starts of pieces that are cut out of a text together; it bounds what is held for one row, not what is matched.
STRETCH = 512


def contained_names(
    texts: DataFrame, text: str, names: DataFrame, name: str, rank: list[Column], stretch: int = STRETCH
) -> DataFrame:
    """For each distinct text, the row of ``names`` whose ``name`` it contains and that ranks first.

    Result: ``text`` plus all columns of ``names``; texts without a match are left out. The pieces of a text of
    those lengths that names have are joined to the names by equality, so a text meets the names it contains
    and no others. Each distinct text is matched once, however many rows carry it.

    A long text is first cut into stretches that overlap by the longest name and become rows of their own, and
    pieces carry the SHA-256 of their text instead of the text. So memory follows the length of a text and not the number
    of its pieces, and the pieces of one text are spread over tasks by the join.
    """
    t = F.col(text)
    known = names.where(F.length(name) > 0)
    lengths = known.select(F.length(name).alias("_n")).agg(F.sort_array(F.collect_set("_n"))).scalar()
    part = F.col("_part")

    def pieces_of(length: Column) -> Column:
        starts = F.sequence(F.lit(1), F.least(F.length(part) - length + 1, F.lit(stretch)))
        return F.transform(starts, lambda i: part.substr(i, length))

    distinct = texts.select(text).where(t.isNotNull() & (F.length(t) > 0)).distinct().withColumn("_id", F.sha2(t, 256))
    firsts = F.sequence(F.lit(1), F.length(t), F.lit(stretch))
    wide = F.coalesce(F.array_max("_lengths"), F.lit(1)) + stretch - 1
    parts = distinct.withColumn("_lengths", lengths).select(
        "_id", "_lengths", F.explode(F.transform(firsts, lambda i: t.substr(i, wide))).alias("_part")
    )
    pieces = F.flatten(F.transform(F.filter("_lengths", lambda n: n <= F.length(part)), pieces_of))
    held = parts.select("_id", F.explode(F.array_distinct(pieces)).alias("_piece"))
    matched = held.join(known.withColumn("_piece", F.col(name)), "_piece")
    best = F.min_by(F.struct(*[F.col(c) for c in names.columns]), F.struct(*rank))
    found = matched.groupBy("_id").agg(best.alias("_best"))
    return distinct.join(found, "_id").select(text, "_best.*")


def longest_name_first(name: str) -> list[Column]:
    return [-F.length(name), F.col(name)]
