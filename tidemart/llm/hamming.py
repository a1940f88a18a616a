"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has a bit for each dimension, set where the value is above 0, in segments of `SEGMENT` bits. The index
lists codes by each of their segments. A query probes every segment with all values at distance 0, then 1, 2, ...; what
it finds is verified on whole codes. After radius r a code not yet found differs by more than r bits in each of the m
segments, so by m (r + 1) in all: once the k-th verified distance is below that, the answer is proven and the query
leaves. The search radii of all open queries grow together, one Spark job each; the answers so far are written to the
shared scratch folder between them.

Equal codes are one entry of the index with its k smallest ids, and equal queries are asked once, so a vector that a
third of the rows hold costs no more than another. Probing goes by distinct segment values, of which a segment has
65,536 at most, and only values that the index holds meet the queries. A candidate counts only in the segment (the first of equals) and at
the radius where it is nearest, so none is verified twice, and only if it beats the query's k-th distance so far.

Ties in distance go to the smaller id. Edge cases: a null vector, a null or NaN among its values, another number of
dimensions than `dims`, or a null id: the row is neither found nor asked; repeated rows count once; with fewer than k
rows all are returned; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SEGMENT = 16


def segments(vector: str, dims: int) -> F.Column:
    """Code of a vector column as an array of segments."""
    parts = []
    for low in range(0, dims, SEGMENT):
        bits = [f"if({vector}[{i}] > 0, {1 << (i - low)}, 0)" for i in range(low, min(low + SEGMENT, dims))]
        parts.append(" + ".join(bits))
    return F.expr(f"array({', '.join(parts)})")


def _coded(vectors: DataFrame, id_column: str, vector_column: str, dims: int) -> DataFrame:
    known = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v")).where(
        f"id is not null and size(v) = {dims} and not exists(v, x -> x is null or isnan(x))"
    )
    return known.select("id", segments("v", dims).alias("code"))


def _masks(bits: int, radius: int) -> F.Column:
    """All segment differences of so many bits, as one constant array."""
    found = sorted(sum(1 << b for b in chosen) for chosen in combinations(range(bits), radius))
    return F.from_json(F.lit(str(found)), "array<int>")


def _value_pairs(asked: DataFrame, values: DataFrame, widths: list[int], radius: int, most: int) -> DataFrame:
    """`segment`, `own`, `value`: each asked segment value with the index's values of that segment that differ in `radius` bits.

    A segment has at most 2^`SEGMENT` values, so whatever of `values` is sent to all tasks is bounded by the number of
    segments. Where all differences of so many bits are fewer than the values of a segment (`most`), they are tried one
    by one against the values, else the values themselves are looked through. Either way rows are made and dropped
    inside a task; no exchange follows before the values that the index does not have are gone.
    """
    if math.comb(max(widths), radius) < most:
        masks = _masks(widths[0], radius)
        if widths[-1] != widths[0]:  # only the last segment can be narrower than the others
            masks = F.when(F.col("segment") == len(widths) - 1, _masks(widths[-1], radius)).otherwise(masks)
        tried = asked.select("segment", "own", F.explode(masks).alias("mask")).select("segment", "own", F.expr("own ^ mask").alias("value"))
        return tried.join(F.broadcast(values), ["segment", "value"]).select("segment", "own", "value")
    all_values = values.groupBy("segment").agg(F.collect_list("value").alias("values"))
    near = F.explode(F.expr(f"filter(values, v -> bit_count(v ^ own) = {radius})"))
    return asked.join(F.broadcast(all_values), "segment").select("segment", "own", near.alias("value"))


def _distance(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), 0, (s, d) -> s + d)"


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query; Spark drops the rest before it shuffles."""
    order = Window.partitionBy("query").orderBy("distance", "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, dims: int = 64, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """`query_id`, `rank`, `neighbor_id`, `distance`: the k nearest rows of `vectors` for each row of `queries`."""
    spark = vectors.sparkSession
    widths = [min(SEGMENT, dims - low) for low in range(0, dims, SEGMENT)]

    rows = _coded(vectors, id_column, vector_column, dims).distinct()
    by_code = Window.partitionBy("code").orderBy("id")
    few = rows.withColumn("place", F.row_number().over(by_code)).where(F.col("place") <= k)
    index = stored(few.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "hamming-index")
    lists = stored(index.select(F.posexplode("code").alias("segment", "value"), "code", "ids"), "hamming-lists")
    values = stored(lists.select("segment", "value").distinct(), "hamming-values")
    most = values.groupBy("segment").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    asked = stored(_coded(queries, id_column, vector_column, dims).distinct(), "hamming-asked")

    answers = spark.createDataFrame([], "query array<int>, id long, distance int, rank int")
    open_queries = asked.select(F.col("code").alias("query")).distinct().withColumn("bound", F.lit(dims))
    apart = F.expr("zip_with(query, code, (x, y) -> bit_count(x ^ y))")
    for radius in range(max(widths) + 1):
        # Every table that a join reads is written, so what Spark may broadcast is known by its size and not by a guess.
        open_queries = stored(open_queries, "hamming-open")
        if open_queries.isEmpty():
            break
        probes = stored(open_queries.select("query", "bound", F.posexplode("query").alias("segment", "own")), "hamming-probes")
        pairs = stored(_value_pairs(probes.select("segment", "own").distinct(), values, widths, radius, most), "hamming-pairs")
        found = (
            probes.join(pairs, ["segment", "own"]).join(lists, ["segment", "value"])
            .withColumn("distance", F.expr(_distance("query", "code")))
            .where("distance <= bound")
            .withColumn("apart", apart)
            .where((F.array_min("apart") == radius) & (F.array_position("apart", radius) - 1 == F.col("segment")))
            .select("query", F.explode("ids").alias("id"), "distance")
        )
        answers = stored(_best(found.unionByName(answers.drop("rank")), k), "hamming-answers")
        state = answers.groupBy("query").agg(F.max("distance").alias("last"), F.count("*").alias("held"))
        bound = F.when(F.col("held") == k, F.col("last")).otherwise(dims)
        state = open_queries.select("query").join(state, "query", "left").select("query", bound.alias("bound"))
        open_queries = state.where(F.col("bound") >= len(widths) * (radius + 1))
    return asked.join(answers, asked.code == answers.query).select(
        asked.id.alias("query_id"), "rank", answers.id.alias("neighbor_id"), "distance")
