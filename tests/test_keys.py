"""Group keys that hold bars and nulls, ranges of odd values, and categorical anchors with many levels."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift, evaluate, orientation, profile, ranks

KEYS = [("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), (None, None)]


def test_keys_stay_apart(spark):
    rows = [(a, b, float(i), 1 if (i % 2 == 0) ^ (k % 2 == 1) else 0, float(i * (1 if k % 2 else -1))) for k, (a, b) in enumerate(KEYS) for i in range(4)]
    df = spark.createDataFrame(rows, "k1 string, k2 string, s double, y int, z double")
    both = {(r.k1, r.k2): r.average_precision for r in evaluate.average_precision(df, "s", "y", ("k1", "k2")).collect()}
    assert set(both) == set(KEYS)
    for k, (a, b) in enumerate(KEYS):
        one = df.where(F.col("k1").eqNullSafe(F.lit(a)) & F.col("k2").eqNullSafe(F.lit(b)))
        assert both[a, b] == pytest.approx(evaluate.average_precision(one, "s", "y").first()[0])
    found = {(r.k1, r.k2): r.spearman for r in drift.spearman(df, "s", "z", ["k1", "k2"]).collect()}
    assert found == {key: pytest.approx(1.0 if k % 2 else -1.0) for k, key in enumerate(KEYS)}
    places = ranks.percentile_ranks(df.withColumnRenamed("s", "value"), ["k1", "k2"]).groupBy("k1", "k2").agg(F.max("position").alias("p"), F.max("different").alias("d")).collect()
    assert {(r.k1, r.k2) for r in places} == set(KEYS) and all((r.p, r.d) == (3, 4) for r in places)


def test_ranges_of_odd_values(spark):
    values = [-1e308, -5.0, -0.0, 1e-300, 1.0, 1.5, 1.5000001, 7e7, 1e308, float("inf"), float("-inf")]
    counts = spark.createDataFrame([("x", v, 1) for v in values] + [("flat", 3.0, 5), ("none", None, 2)], "feature string, value double, n int")
    got = {(r.feature, r.value): (r.c_n, r.t_n) for r in profile.cumulative(counts, ["n"]).collect()}
    assert [got["x", v][0] for v in sorted(values)] == list(range(1, len(values) + 1)) and got["flat", 3.0] == (5, 5) and len(got) == len(values) + 1


def test_large_category_is_joined(spark):
    rows = spark.createDataFrame([(i, f"level {i % 50}", i % 50 % 2, 1) for i in range(1000)] + [(1000, None, 1, 1)], "id long, c string, y int, period_idx int")
    few, many = (orientation.profiles(rows, [], ["c"], "y", orientation.OrientationLimits(levels=n)) for n in (100, 10))
    assert few[0].table is None and many[0].table is not None
    a = rows.select("id", few[0].score().alias("s"))
    b = orientation.looked_up(rows.withColumn("c", F.when(F.col("id") == 7, F.lit("unseen")).otherwise(F.col("c"))), many).select("id", many[0].score().alias("s"))
    a, b = ({r.id: r.s for r in x.collect()} for x in (a, b))
    assert len(b) == 1001 and all(a[i] == pytest.approx(b[i]) for i in a if i != 7) and b[7] == pytest.approx(many[0].default)
