"""Operators against plain loops, with narrow and wide slices."""

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemart.operators import lookups, matching, ordered, ranges, uniques
from tidemart.functions.columns import money
from tidemart.operators.statistics import exact_medians

WAYS = [{}, {"width": 1, "tie_width": 1}, {"width": 7, "tie_width": 5}, {"width": 100}]
SHORT = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def skewed(seed, n=600, users=30):
    """Events where user 0 holds a third of the rows and the times have ties and gaps."""
    rnd = random.Random(seed)
    return [
        (i, 0 if rnd.random() < 0.33 else rnd.randrange(users), rnd.choice([rnd.randrange(50), rnd.randrange(10**9), 7_000_000 + i]))
        for i in range(n)
    ]


def by_user(events):
    groups = {}
    for e in sorted(events, key=lambda e: (e[2], e[0])):
        groups.setdefault(e[1], []).append(e)
    return groups


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("seed", [1, 2])
def test_previous_and_next(spark, rows, way, seed):
    events = skewed(seed)
    df = spark.createDataFrame(events, "id long, user long, t long")
    want_before, want_after = [], []
    for group in by_user(events).values():
        times = [e[2] for e in group]
        want_before += [(e[0], p) for e, p in zip(group, [None, *times])]
        want_after += [(e[0], p) for e, p in zip(group, [*times[1:], None])]
    before = ordered.previous_value(df, ["user"], ["t", "id"], F.col("t"), "p", **way)
    after = ordered.next_value(df, ["user"], ["t", "id"], F.col("t"), "p", **way)
    assert rows(before, "id", "p") == sorted(want_before, key=repr)
    assert rows(after, "id", "p") == sorted(want_after, key=repr)


@pytest.mark.parametrize("way", WAYS)
def test_null_keys_times_and_values(spark, rows, way):
    events = [(1, None, 5, "a"), (2, None, 6, None), (3, None, 7, "c"), (4, "u", None, "x"), (5, "u", 1, "y"), (6, "u", 2, "z")]
    df = spark.createDataFrame(events, "id long, user string, t long, v string")
    found = ordered.previous_value(df, ["user"], ["t", "id"], F.col("v"), "p", **way)
    assert rows(found, "id", "p") == [(1, None), (2, "a"), (3, None), (4, None), (5, "x"), (6, "y")]


@pytest.mark.parametrize("way", WAYS)
def test_order_with_a_leading_column(spark, rows, way):
    rnd = random.Random(3)
    events = [(i, rnd.randrange(2), rnd.randrange(-1, 4), rnd.randrange(1000)) for i in range(200)]
    df = spark.createDataFrame(events, "id long, user long, step int, t long")
    want = []
    for user in (0, 1):
        group = sorted((e for e in events if e[1] == user), key=lambda e: (e[2], e[3], e[0]))
        want += [(e[0], n) for e, n in zip(group, [*[e[0] for e in group[1:]], None])]
    found = ordered.next_value(df, ["user"], ["step", "t", "id"], F.col("id"), "n", **way)
    assert rows(found, "id", "n") == sorted(want, key=repr)


@pytest.mark.parametrize("way", WAYS)
@SHORT
@given(seed=st.integers(0, 10**6), hit=st.floats(0.3, 0.95))
def test_longest_runs(spark, rows, way, seed, hit):
    rnd = random.Random(seed)
    events = [(*e, rnd.choices(["hit", "reset", "none"], [hit, (1 - hit) / 2, (1 - hit) / 2])[0]) for e in skewed(seed, 300, 8)]
    df = spark.createDataFrame(events, "id long, user long, t long, kind string")
    want = []
    for user, group in by_user(events).items():
        best = now = 0
        for e in group:
            now = now + 1 if e[3] == "hit" else 0 if e[3] == "reset" else now
            best = max(best, now)
        want.append((user, best))
    found = ordered.longest_runs(
        df, ["user"], ["t", "id"], F.col("kind") == "hit", F.col("kind") == "reset", "best", **way
    )
    assert rows(found, "user", "best") == sorted(want, key=repr)


def test_slices_spread_a_hot_key_and_follow_its_order(spark):
    t = F.when(F.col("id") >= 2000, F.col("id") * 10)
    df = spark.range(10_000).select(F.lit(1).alias("user"), "id", t.alias("t"))
    cut = ordered.sliced(df, ["user"], ["t", "id"], width=1000, tie_width=100)
    sizes_of = cut.groupBy("_slice").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    assert sizes_of.agg(F.max("n")).first()[0] == 100
    bounds = [(r["low"], r["high"]) for r in sizes_of.orderBy("_slice").collect()]
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_running_sums(spark, rows):
    data = [("a", 1, 10), ("a", 2, 5), ("a", 4, 1), ("b", 3, 7)]
    df = spark.createDataFrame(data, "k string, bucket int, x int")
    found = ordered.running_sums(df, ["k"], "bucket", {"s": "x"})
    assert rows(found, "k", "bucket", "s") == [("a", 1, 10), ("a", 2, 15), ("a", 4, 16), ("b", 3, 7)]


@SHORT
@given(
    groups=st.lists(
        st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0, -1.0, 1e-9, 1e12])), max_size=60),
        min_size=1,
        max_size=4,
    )
)
def test_exact_medians(spark, rows, groups):
    data = [(g if g else None, v, i) for g, values in enumerate(groups) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "g int, v double, w int")
    want = []
    for g, values in enumerate(groups):
        known = [v for v in values if v is not None]
        if values:
            want.append((g if g else None, statistics.median(known) if known else None, statistics.median(range(len(values)))))
    found = {r["g"]: (r["v"], r["w"]) for r in exact_medians(df, ["g"], ["v", "w"]).collect()}
    assert found.keys() == {w[0] for w in want}
    for g, v, w in want:
        assert found[g][0] == (None if v is None else pytest.approx(v, rel=1e-12, abs=1e-12))
        assert found[g][1] == w


def test_strict_lookup(spark, rows):
    dim = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "code string, sk int")
    good = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    assert rows(lookups.strict_lookup(good, dim, F.col("c"), "code", "sk", "fk")) == [("a", 1), ("a", 1), ("b", 3)]
    for missing in ("z", None):
        bad = spark.createDataFrame([("a",), (missing,)], "c string")
        with pytest.raises(PySparkException, match="no sk for code = (z|null)"):
            lookups.strict_lookup(bad, dim, F.col("c"), "code", "sk", "fk").collect()
        assert rows(lookups.lookup_misses(bad, dim, "c", "code")) == [(missing,)]


def test_as_of_version(spark, rows):
    versions = spark.createDataFrame([("p", 20240105), ("p", 20240110), ("q", 20240101)], "k string, version int")
    days = [("p", d) for d in ("2024-01-04", "2024-01-05", "2024-01-09", "2024-01-10", "2025-01-01")]
    df = spark.createDataFrame([*days, ("q", "2024-01-01"), ("r", "2024-01-01"), ("p", "2024-01-04")], "k string, day string")
    assert rows(lookups.as_of_version(df, versions, ["k"], "day"), "k", "day", "version") == [
        ("p", "2024-01-04", 0), ("p", "2024-01-04", 0), ("p", "2024-01-05", 20240105),
        ("p", "2024-01-09", 20240105), ("p", "2024-01-10", 20240110), ("p", "2025-01-01", 20240110),
        ("q", "2024-01-01", 20240101), ("r", "2024-01-01", 0),
    ]


def test_strict_lookup_of_a_repeated_key_keeps_the_rows(spark, rows):
    dim = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "code string, sk int")
    facts = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    assert rows(lookups.strict_lookup(facts, dim, F.col("c"), "code", "sk", "fk")) == [("a", 2), ("a", 2), ("b", 3)]


def test_range_lookup_equals_a_loop(spark, rows):
    rnd = random.Random(4)
    key = "{:08x}".format
    bounds = sorted(rnd.sample(range(1 << 20), 80))
    table = [(bounds[i], bounds[i + 1] - 1, f"r{i}") for i in range(0, 80, 2)] + [(1 << 30, (1 << 30) + (1 << 20), "wide"), (1 << 31, 1 << 31, "one")]
    points = [rnd.randrange(1 << 20) for _ in range(300)] + [bounds[0], bounds[1] - 1, bounds[1], (1 << 30) + 70_000, 1 << 31, None] + [5] * 50
    df = spark.createDataFrame([(i, None if p is None else key(p)) for i, p in enumerate(points)], "i int, p string")
    dim = spark.createDataFrame([(key(lo), key(hi), n) for lo, hi, n in table], "lo string, hi string, name string")
    want = [(i, next((n for lo, hi, n in table if p is not None and lo <= p <= hi), None)) for i, p in enumerate(points)]
    found = ranges.range_lookup(df, "p", dim, "lo", "hi", digits=8)
    assert rows(found, "i", "name") == sorted(want, key=repr)
    everything = spark.createDataFrame([(key(0), "f" * 8, "all")], "lo string, hi string, name string")
    assert ranges.range_lookup(df.where("i < 5"), "p", everything, "lo", "hi", digits=8).where("name = 'all'").count() == 5


@pytest.mark.parametrize("stretch", [1, 3, matching.STRETCH])
def test_contained_names_equals_a_loop(spark, rows, stretch):
    rnd = random.Random(6)
    texts = ["".join(rnd.choices("abcde深圳", k=rnd.randrange(0, 12))) for _ in range(200)] + [None, "a"]
    names = list({"".join(rnd.choices("abcde深圳", k=rnd.randrange(1, 5))) for _ in range(25)})
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    dim = spark.createDataFrame([(n, n.upper()) for n in names], "name string, up string")
    want = []
    for t in {t for t in texts if t}:
        inside = sorted((n for n in names if n in t), key=lambda n: (-len(n), n))
        if inside:
            want.append((t, inside[0], inside[0].upper()))
    found = matching.contained_names(df, "t", dim, "name", matching.longest_name_first("name"), stretch)
    assert rows(found) == sorted(want, key=repr)
    assert matching.contained_names(df, "t", dim.limit(0), "name", matching.longest_name_first("name"), stretch).count() == 0


def test_contained_names_in_a_text_of_a_megabyte(spark):
    rnd = random.Random(8)
    plain = "".join(rnd.choices("abcdef深", k=1_000_000))
    cut = 512 * 1500
    texts = [plain[: cut - 3] + "needle" + plain[cut:] + "NEEDLE", "needle", "none"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    dim = spark.createDataFrame([("needle",), ("NEEDLES",), ("a needle",), ("x",)], "name string")
    found = matching.contained_names(df, "t", dim, "name", matching.longest_name_first("name"))
    hits = found.join(df, "t").select("i", "name").collect()
    assert sorted(tuple(r) for r in hits) == [(0, "needle"), (1, "needle")]


def test_totals_and_uniques(spark, rows):
    rnd = random.Random(7)
    data = [(rnd.choice(["a", "b", None]), rnd.choice([None, *"stuv"]), rnd.choice([None, 1, 2, 3]), rnd.randrange(3)) for _ in range(300)]
    df = spark.createDataFrame(data, "k string, session string, user int, x int")
    big, small = F.col("x") == 2, F.col("x") == 0
    found = uniques.totals_and_uniques(
        df, ["k"], {"n": uniques.ones(big), "total": F.col("x")},
        {"session": {"s_big": big, "s_small": small}, "user": {"u_big": big}},
    )
    want = []
    for k in ("a", "b", None):
        mine = [d for d in data if d[0] == k]
        want.append((
            k, sum(d[3] == 2 for d in mine), sum(d[3] for d in mine), len({d[1] for d in mine if d[3] == 2}),
            len({d[1] for d in mine if d[3] == 0}), len({d[2] for d in mine if d[3] == 2}),
        ))
    assert rows(found, "k", "n", "total", "s_big", "s_small", "u_big") == sorted(want, key=repr)


def test_strict_lookup_raises_whatever_is_read(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, other string")
    dim = spark.createDataFrame([(1, "one"), (3, None)], "k2 int, v string")
    found = lookups.strict_lookup(df, dim, F.col("k"), "k2", "v", "out")
    for read in (found.count, found.select("other").collect, found.collect):
        with pytest.raises(Exception, match="no v for k2 = 2"):
            read()
    known = lookups.strict_lookup(df.where("k = 1"), dim, F.col("k"), "k2", "v", "out")
    assert known.count() == 1 and known.first()["out"] == "one"


def test_money_keeps_all_digits_or_raises(spark):
    small = spark.range(1000).select(F.lit(0.004).alias("x"), F.lit("0.000000000000000001").alias("t"))
    row = small.agg(F.sum(money("x")).cast("double").alias("x"), F.sum(money("t")).cast("string").alias("t")).first()
    assert (row["x"], row["t"]) == (4.0, "0.000000000000001000")
    with pytest.raises(Exception, match="amount does not fit: 0.125"):
        spark.range(1).select(money(F.lit(0.125), 2)).collect()
    assert spark.range(1).select(money(F.lit(None).cast("double"))).first()[0] is None
