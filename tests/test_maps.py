"""Percentile maps in blocks: as numpy, at the ends of blocks too; every knot of a large map; time that doesn't grow with knots times rows."""

import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import POOLED
from tidemark.operators import ranks
from tidemark.plans import preparation
from tidemark.sources.contract import ColumnContract


def plan_of(features, maps):
    empty = dict(numeric=[], categorical=[], dropped=[], codes={}, scales={}, offsets={}, remaps={}, evidence=[], thresholds={})
    return preparation.PreparationPlan(ColumnContract("id", "period_idx", "target"), features, ranked=features, reversed=features[:1], fills={f: 0.5 for f in features}, maps=maps, **empty)


@pytest.mark.parametrize("broadcast", [True, False])
def test_blocks_equal_numpy(spark, monkeypatch, broadcast):
    monkeypatch.setattr(ranks, "BLOCK", 4)
    if not broadcast:
        monkeypatch.setattr(preparation, "MOST_BROADCAST_KNOTS", 0)
    rng = np.random.default_rng(3)
    sizes = {"1": 1, "2": 3, "3": 4, "4": 5, "5": 8, "6": 9, "7": 30, POOLED: 13}
    maps = {(f, p): (np.unique(rng.normal(size=n)), np.sort(rng.uniform(size=n))) for f in ("x", "y") for p, n in sizes.items() if (f, p) != ("y", POOLED)}
    rows = []
    for period in [1, 2, 3, 4, 5, 6, 7, 99, None]:
        for f in ("x", "y"):
            knots = maps.get((f, str(period)), maps["x", POOLED])[0]
            values = [*knots, *(knots[:-1] + knots[1:]) / 2, knots[0] - 1, knots[-1] + 1, float("inf"), float("-inf"), None]
            rows += [(period, None if v is None else float(v)) for v in values]
    df = spark.createDataFrame([(i, p, v, v) for i, (p, v) in enumerate(rows)], "id long, period_idx int, x double, y double")
    plan = plan_of(["x", "y"], {"test": [(f, p, k.tolist(), h.tolist()) for (f, p), (k, h) in maps.items()]})
    got = {r.id: (r.x, r.y) for r in preparation.transform(df, plan, "test", ("id",)).collect()}
    assert len(got) == len(rows)
    for i, (period, v) in enumerate(rows):
        for f, g in zip("xy", got[i], strict=True):
            knots, heights = maps.get((f, str(period)), maps.get((f, POOLED), ([0.0], [0.5])))
            want = np.float32(0.5) if v is None else np.float32(np.interp(v, knots, heights))
            assert g == pytest.approx(np.float32(1) - want if f == "x" and v is not None else want, abs=1e-6), (f, period, v)


@pytest.mark.parametrize("broadcast", [True, False])
def test_whole_maps_give_the_ranks(spark, monkeypatch, broadcast):
    monkeypatch.setattr(ranks, "BLOCK", 16)
    if not broadcast:
        monkeypatch.setattr(preparation, "MOST_BROADCAST_KNOTS", 0)
    at = F.col("id")
    df = spark.range(2000).select("id", F.when(at % 17 > 0, at % 3).cast("int").alias("period_idx"), F.when(at % 11 > 0, at * 7919 % 601).cast("double").alias("x"))
    maps = ranks.whole_maps(df, ["x"])
    assert max(r.n for r in maps.table.select(F.size("knots").alias("n")).collect()) == 17 and maps.count("x") == maps.table.count()
    got = {r.id: r.x for r in preparation.transform(df, plan_of(["x"], {}), "test", ("id",), maps).collect()}
    own = ranks.with_percentile(df, "period_idx", "x", "p").where("period_idx IS NOT NULL")
    pooled = ranks.with_percentile(df.withColumn("one", F.lit(1)), "one", "x", "p").where("period_idx IS NULL")
    want = {r.id: np.float32(0.5) if r.p is None else np.float32(1) - np.float32(r.p) for part in (own, pooled) for r in part.select("id", "p").collect()}
    assert len(want) == 2000 and got == want


def test_large_map_in_bounded_time(spark):
    """40,000 rows and as many knots: a row that looks at each knot, or that carries the map, takes minutes."""
    n = 40_000
    df = spark.range(n).select("id", F.lit(1).alias("period_idx"), (F.col("id") * 7919 % n).cast("double").alias("x")).repartition(4)
    knots, heights = [float(i) for i in range(n)], [(i + 1) / n for i in range(n)]
    plan = plan_of(["x"], {"test": [("x", "1", knots, heights), ("x", POOLED, knots, heights)]})
    began = time.perf_counter()
    wrong = preparation.transform(df, plan, "test", ("id",)).where(F.col("x") != F.lit(1.0).cast("float") - ((F.col("id") * 7919 % n + 1) / n).cast("float")).count()
    assert wrong == 0 and time.perf_counter() - began < 40


def test_maps_deal_no_period_to_one_task(spark):
    """Without Spark's own broadcasts, knots are joined by range too, never by feature and period alone."""
    df = spark.range(100).select(F.lit(1).alias("period_idx"), F.col("id").cast("double").alias("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ranks.rank_map_knots(df, ["x"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[([^\]]*)\]", plan)
    assert joins and all("range#" in keys for keys in joins)
