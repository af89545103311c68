"""Evidence, policy, plan and transform on seeded frames with injected drift, positive and negative twins."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift, orientation, policy, profile, ranks, sampling
from tidemark.plans import preparation
from tidemark.sources.contract import ColumnContract, by_kind, chunk_rows, read_csv, rows_for_bytes, shared_features, with_period, without_target

CONTRACT = ColumnContract()
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug"]


def frames(spark, change=None, seed=1, n=260, width=3):
    """Eight months of training rows and one current month; change(pandas current frame, rng) injects drift."""
    rng = np.random.default_rng(seed)

    def rows(count, month, first, labelled):
        latent = rng.normal(size=count)
        data = {"CustomerID": np.arange(first, first + count), "Month": [month] * count}
        if labelled:
            data["ChurnStatus"] = np.where(latent + rng.normal(scale=0.65, size=count) > 0, "Yes", "No")
        data |= {f"x{i}": 6 + 3 * (latent + rng.normal(scale=0.55, size=count)) for i in range(width)}
        data["tier"] = rng.choice(["a", "b", "c"], size=count, p=[0.6, 0.3, 0.1])
        data["tier"] = np.where(latent > 0.8, "a", data["tier"])
        return pd.DataFrame(data)

    train = pd.concat([rows(n, f"25-{m}", i * 1000, True) for i, m in enumerate(MONTHS)], ignore_index=True)
    current = rows(900, "25-Sep", 100000, False)
    if change:
        change(current, rng)
    return spark.createDataFrame(train), spark.createDataFrame(current)


def evidence(train, current, numeric=None, categorical=None):
    train = preparation.check_target(with_period(train, CONTRACT), CONTRACT)
    current = with_period(current, CONTRACT)
    auto = by_kind(train, [f for f in shared_features(train, current, CONTRACT) if f not in ("period_idx", "__target")])
    found = drift.base_evidence(train, current, auto[0] if numeric is None else numeric, auto[1] if categorical is None else categorical, profile.history_blocks(train), "__target")
    return {r.feature: r for r in policy.choose_actions(drift.add_systemic(found).withColumns({"orientation_train": F.lit(0.0), "orientation_test": F.lit(0.0), "orientation_anchor_count": F.lit(0)})).collect()}


def test_stationary_keeps_all(spark):
    assert {r.action for r in evidence(*frames(spark)).values()} == {"KEEP"}


def test_scale_offset_and_relabelling(spark):
    def change(c, rng):
        c["x0"] *= 100
        c["x1"] += 400
        c["tier"] = "new_" + c["tier"]

    got = evidence(*frames(spark, change, width=8))
    assert (got["x0"].action, got["x1"].action, got["tier"].action) == ("REALIGN_SCALE", "REALIGN_OFFSET", "REMAP_CATEGORIES")
    assert got["x0"].scale_factor == pytest.approx(100, rel=0.1) and got["x1"].offset == pytest.approx(400, rel=0.03)
    assert got["tier"].category_mapping == {"new_a": "a", "new_b": "b", "new_c": "c"}


def test_missingness_drops_only_what_is_new(spark):
    def change(c, rng):
        c.loc[rng.random(len(c)) < 0.7, "x0"] = np.nan

    train, current = frames(spark, change, width=6)
    null_nan = lambda df: df.withColumn("x0", F.when(~F.isnan("x0"), F.col("x0")))
    got = evidence(train, null_nan(current))
    assert got["x0"].missing_shift > 0.6 and got["x0"].action == "DROP_NOVEL_UNRELIABLE"


def test_ks_and_spearman_equal_numpy(spark):
    train, current = frames(spark, lambda c, rng: c.__setitem__("x0", c["x0"].round(0) + 2), seed=3)
    got = evidence(train, current)["x0"]
    a = train.where(F.col("Month").isin("25-Jul", "25-Aug")).toPandas()["x0"].to_numpy()
    b = current.toPandas()["x0"].to_numpy()
    grid = np.union1d(a, b)
    ks = np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a) - np.searchsorted(np.sort(b), grid, "right") / len(b)).max()
    assert got.current_shift == pytest.approx(ks, abs=1e-12)
    t = train.toPandas()
    rho = abs(np.corrcoef(t["x0"].rank(), (t["ChurnStatus"] == "Yes").astype(float).rank())[0, 1])
    assert got.predictive_strength == pytest.approx(rho, abs=1e-9)


def test_partition_and_order_invariance(spark):
    train, current = frames(spark, seed=5)
    one = evidence(train, current)
    two = evidence(train.repartition(7).orderBy(F.rand(1)), current.repartition(5))
    for f in one:
        assert one[f].action == two[f].action
        assert one[f].current_shift == pytest.approx(two[f].current_shift, abs=1e-12)


def test_plan_and_transform(spark):
    def change(c, rng):
        c["x0"] *= 100
        c["tier"] = "new_" + c["tier"]

    train, current = frames(spark, change, width=4)
    current = current.withColumn("ChurnStatus", F.lit("Yes"))
    plan = preparation.build_plan(train, current)
    assert "CustomerID" not in plan.features and plan.remaps["tier"]["new_a"] == "a"
    again = preparation.PreparationPlan.from_json(plan.to_json())
    assert again.summary() == preparation.PreparationPlan.from_json(again.to_json()).summary()
    rows = preparation.transform(current, plan, "test", ("CustomerID",))
    whole = sorted(map(tuple, rows.collect()))
    parts = sorted(map(tuple, preparation.transform(current.repartition(17), again, "test", ("CustomerID",)).collect()))
    assert whole == parts
    medians = preparation.transform(train, plan, "train").agg(F.median("x0")).first()[0], rows.agg(F.median("x0")).first()[0]
    assert abs(medians[0] - medians[1]) < 1.0
    with pytest.raises(ValueError):
        preparation.transform(current, plan, "other")


def test_target_is_never_scanned(spark, tmp_path):
    train, current = frames(spark, n=40)
    path = str(tmp_path / "current.parquet")
    current.withColumn("ChurnStatus", F.lit("Yes")).write.parquet(path)
    plan = preparation.PreparationPlan(CONTRACT, ["x0"], ["x0"], [], [], [], [], {}, {"x0": 0.0}, {}, {}, {}, [], {})
    df = preparation.transform(without_target(spark.read.parquet(path), CONTRACT), plan, "test", ("CustomerID",))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ChurnStatus" not in text and "x0" in text


def test_reversal_against_anchors(spark):
    def change(c, rng):
        c["x0"] = -c["x0"] + 18 + rng.normal(scale=0.1, size=len(c))

    train, current = frames(spark, change, width=24)
    train = preparation.check_target(with_period(train, CONTRACT), CONTRACT)
    current = with_period(current, CONTRACT)
    numeric = [f"x{i}" for i in range(24)]
    found = orientation.detect_drift(train, current, numeric, [], profile.history_blocks(train), "__target")
    row = {r.feature: r for r in policy.choose_actions(found).collect()}["x0"]
    assert row.orientation_anchor_count >= 8 and row.orientation_train > 0.08 and row.orientation_test < -0.05
    assert row.action == "REVERSE_PERCENTILE"


def test_percentile_rank_and_rank_map(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (1, 7.0), (1, None), (2, 1.0), (None, 9.0)], "period_idx int, v double")
    got = sorted((r.period_idx or 0, r.v or 0, round(r.p or 0, 6)) for r in ranks.with_percentile(df, "period_idx", "v", "p").collect())
    assert got == [(0, 9.0, 1.0), (1, 0, 0), (1, 5.0, 0.5), (1, 5.0, 0.5), (1, 7.0, 1.0), (2, 1.0, 1.0)]
    many = spark.range(3000).select(F.lit(1).alias("period_idx"), F.col("id").cast("double").alias("x"))
    knots = ranks.rank_map_knots(many, ["x"], most=100).where("period = '1'")
    want = np.unique(np.linspace(0, 2999, 100).round().astype(int)).tolist()
    assert sorted(r.position for r in knots.collect()) == want


def test_samples(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("s"))
    a = {r.id for r in sampling.bottom_k(df, ["id"], 50).collect()}
    assert a == {r.id for r in sampling.bottom_k(df.repartition(9), ["id"], 50).collect()} and len(a) == 50
    assert {r["count"] for r in sampling.per_stratum(df, ["s"], ["id"], 20).groupBy("s").count().collect()} == {20}
    assert [r.row_ordinal for r in sampling.with_ordinal(df, ["id"]).orderBy("id").collect()] == list(range(1000))


def test_csv_null_tokens(spark, tmp_path):
    (tmp_path / "a.csv").write_text("CustomerID,Month,x,t\n1,25-Jan,1.5,NA\n2,25-Jan,None,b\n3,25-Feb,,nan\n")
    df = read_csv(spark, str(tmp_path / "a.csv"))
    assert dict(df.dtypes)["x"] == "double" and [r.x for r in df.orderBy("CustomerID").collect()] == [1.5, None, None]
    assert [r.t for r in df.orderBy("CustomerID").collect()] == [None, "b", None]


def test_budgets():
    assert chunk_rows(1) == 100_000 and chunk_rows(10**9) == 2_000 and rows_for_bytes(100, 1000, 50) == 10 and rows_for_bytes(10**9, 10, 50) == 1


def test_plan_rejects_bad_input(spark):
    train, current = frames(spark, n=20)
    with pytest.raises(ValueError, match="no column"):
        preparation.build_plan(train.drop("Month"), current)
    with pytest.raises(ValueError, match="no rows"):
        preparation.build_plan(train.limit(0), current)
    with pytest.raises(ValueError, match="period"):
        preparation.build_plan(train, current.withColumn("Month", F.lit("Sep-25")))
    with pytest.raises(ValueError, match="Yes and No"):
        preparation.build_plan(train.withColumn("ChurnStatus", F.lit("?")), current)
