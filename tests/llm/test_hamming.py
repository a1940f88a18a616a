import math
import random

import pytest

from tidemart.llm import hamming


def plain(rows, asked, k, dims):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and len(v) == dims
            and all(x is not None and not math.isnan(x) for x in v)}
    codes = {(i, tuple(x > 0 for x in v)) for i, v in good}
    out = []
    for q, code in {(i, c) for i, c in codes if i in asked}:
        near = sorted((sum(a != b for a, b in zip(code, c)), i) for i, c in codes)[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("seed, dims, copies", [(1, 20, 0), (2, 33, 60)])
def test_equal_to_all_pairs(spark, seed, dims, copies):
    draw = random.Random(seed)
    vector = lambda: [draw.gauss(0, 1) for _ in range(dims)]
    same = vector()
    rows = [(i, vector()) for i in range(120)] + [(200 + i, same) for i in range(copies)]
    near = [(400 + i, [-x if draw.random() < 0.05 else x for x in same]) for i in range(20)]
    rows += near + [(5, rows[5][1]), (900, None), (901, [1.0]), (902, [None] * dims), (903, [math.nan] * dims), (None, same)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    asked = {i for i, _ in rows if i is not None and i % 25 == 0}
    queries = frame.where("vec_id % 25 = 0")
    found = hamming.top_k(frame, queries, k=7, dims=dims).collect()
    assert sorted((r.query_id, r.rank, r.neighbor_id, r.distance) for r in found) == plain(rows, asked, 7, dims)


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>, rank string, distance string, code string"
    frame = spark.createDataFrame([(1, [1.0, -1.0], "x", None, None), (2, [1.0, 1.0], None, "y", "z")], schema)
    found = hamming.top_k(frame, frame, k=5, dims=2).collect()
    assert sorted((r.query_id, r.rank, r.neighbor_id, r.distance) for r in found) == [(1, 1, 1, 0), (1, 2, 2, 1), (2, 1, 2, 0), (2, 2, 1, 1)]
    assert hamming.top_k(frame, frame.limit(0), k=5, dims=2).count() == 0
    assert hamming.top_k(frame.limit(0), frame, k=5, dims=2).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_both_ways_to_find_values(spark, radius):
    draw = random.Random(radius)
    widths = [16, 16, 3]
    part = lambda w: [draw.randrange(1 << w) for _ in range(60)]
    values = {(s, v) for s, w in enumerate(widths) for v in part(w)}
    asked = {(s, v) for s, w in enumerate(widths) for v in part(w)[:9]} | {(s, v) for s, v in values if v % 5 == 0}
    frame = spark.createDataFrame(sorted(values), "segment int, value int")
    wanted = spark.createDataFrame(sorted(asked), "segment int, own int")
    expected = sorted((s, a, v) for s, a in asked for t, v in values if s == t and (a ^ v).bit_count() == radius)
    for most in (0, 1 << 16):
        found = hamming._value_pairs(wanted, frame, widths, radius, most)
        assert sorted(map(tuple, found.collect())) == expected


def test_no_exploded_side_is_broadcast(spark):
    values = spark.range(1 << 17).selectExpr("cast(id % 2 as int) as segment", "cast(id div 2 as int) as value")
    asked = spark.range(64).selectExpr("0 as segment", "cast(id as int) as own")
    plan = hamming._value_pairs(asked, values, [16, 16], 4, 1 << 16)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("BroadcastExchange"):]
    assert "Generate" in plan and "Generate" not in below
