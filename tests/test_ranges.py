"""Skewed keys and intervals against plain Python, with keys that cross many partitions."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sightline.operators.intervals import merge_sorted, periods_and_gaps
from sightline.operators.ranges import profile, ranks


def stamp(n):
    return None if n is None else F.timestamp_micros(F.lit(n))


def rows_with_a_hot_key(seed, n=4000):
    r = random.Random(seed)
    keys = ["hot"] * (n // 2) + [r.choice(["a", "b", "c", None, "Zz", "é"]) for _ in range(n // 2)]
    return [(k, None if r.random() < 0.2 else r.randrange(500), i) for i, k in enumerate(keys)]


def test_profile(spark):
    data = rows_with_a_hot_key(1)
    df = spark.createDataFrame(data, "slug string, at_us long, id long").repartition(7).withColumn("at", F.timestamp_micros("at_us")).withColumn("n_rows", F.lit("clash"))
    got = {r["slug"]: tuple(r)[1:] for r in profile(df, "slug", "at", "id").collect()}
    for key in {k for k, _, _ in data}:
        times = sorted(t for k, t, _ in data if k == key and t is not None)
        gaps = [b - a for a, b in zip(times, times[1:])]
        assert got[key] == (sum(k == key for k, _, _ in data), len(times), times[0], times[-1], max(gaps)), key
    assert len(got) == 7


def test_profile_of_little(spark):
    empty = spark.createDataFrame([], "slug string, at timestamp, id long")
    assert profile(empty, "slug", "at", "id").count() == 0
    few = spark.createDataFrame([("a", None, 1), ("a", None, 1), ("b", 5, 2)], "slug string, u long, id long").withColumn("at", F.timestamp_micros("u"))
    assert {tuple(r) for r in profile(few, "slug", "at", "id").collect()} == {("a", 2, 0, None, None, None), ("b", 1, 1, 5, 5, None)}


def test_ranks(spark):
    data = rows_with_a_hot_key(2)
    df = spark.createDataFrame(data, "slug string, u long, id long").repartition(3).withColumns({c: F.lit("clash") for c in ("rank_in_key", "part", "Open", "base", "base_")})
    got = {r["id"]: r["rank_in_key"] for r in ranks(df, "slug", "u", "id").collect()}
    for key in {k for k, _, _ in data}:
        order = sorted((x for x in data if x[0] == key), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        assert [got[x[2]] for x in order] == list(range(1, len(order) + 1)), key
    assert ranks(df.limit(0), "slug", "u", "id").count() == 0


def brute(intervals):
    out = []
    for s, e in sorted(intervals):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out], [(a[1], b[0]) for a, b in zip(out, out[1:])]


def test_periods(spark):
    r = random.Random(3)
    for width, span in ((4, 200_000), (300, 20_000), (50_000, 60_000)):
        data = [(r.choice(["hot", "hot", "hot", "x", "y", f"e{i % 40}"]), s := r.randrange(span), s + r.randrange(-1, width)) for i in range(3000)]
        data += [(None, 1, 2), ("x", None, 3), ("x", 3, None), ("one", 5, 5), ("one", 5, 5)]
        df = spark.createDataFrame(data, "k string, s long, e long").repartition(6).withColumn("what", F.lit("clash"))
        got = {}
        for row in periods_and_gaps(df, "k", "s", "e").collect():
            got.setdefault((row["k"], row["what"]), []).append((row["start_us"], row["end_us"]))
        for key in {k for k, _, _ in data if k}:
            periods, gaps = brute([(s, e) for k, s, e in data if k == key and s is not None and e is not None and s <= e])
            assert sorted(got.get((key, "period"), [])) == periods, (key, width)
            assert sorted(got.get((key, "gap"), [])) == gaps, (key, width)


def test_periods_of_nothing(spark):
    assert periods_and_gaps(spark.createDataFrame([], "k string, s long, e long"), "k", "s", "e").count() == 0
    assert periods_and_gaps(spark.createDataFrame([("a", 3, 1)], "k string, s long, e long"), "k", "s", "e").count() == 0


@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.integers(0, 8)), max_size=40))
@settings(max_examples=200, deadline=None)
def test_merge(rows):
    import numpy as np

    rows = sorted((k, s, s + n) for k, s, n in rows)
    keys = np.array([k for k, _, _ in rows])
    new = np.ones(len(rows), bool)
    new[1:] = keys[1:] != keys[:-1]
    at, end = merge_sorted(new, np.array([s for _, s, _ in rows], np.int64), np.array([e for _, _, e in rows], np.int64))
    got = [(rows[i][0], rows[i][1], int(e)) for i, e in zip(at, end)]
    assert got == [(k, *x) for k in range(3) for x in brute([(s, e) for q, s, e in rows if q == k])[0]]
