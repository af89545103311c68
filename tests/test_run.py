"""The whole run, evaluation, documents, streaming and the entry module."""

import json

import pytest
from pyspark.sql import functions as F

from tests.test_drift import frames
from tidemark.operators import evaluate, report
from tidemark.plans import pipeline
from tidemark.plans.model import OnceFitted
from tidemark.plans.preparation import build_plan, check_target
from tidemark.streaming.score import write_scores


def test_average_precision(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 1), (0.2, 0), (0.8, 1)], "s double, y int")
    assert evaluate.average_precision(df, "s", "y").first()[0] == pytest.approx(1.0)
    tied = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.4, 1), (0.1, 0)], "s double, y int")
    assert evaluate.average_precision(tied, "s", "y").first()[0] == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3)


def test_evaluate_names_what_is_wrong(spark):
    good = spark.createDataFrame([(0, 1, 0.1), (1, 2, 0.9)], "row_ordinal long, id long, probability_score double")
    labels = spark.createDataFrame([(0, 1, "No"), (1, 2, "Yes")], "row_ordinal long, id long, y string")
    assert evaluate.evaluate(good, labels, "id", "y") == 1.0
    for change, what in (({"probability_score": F.lit(1.5)}, "bad scores"), ({"id": F.lit(1)}, "id mismatches")):
        with pytest.raises(ValueError, match=what):
            evaluate.evaluate(good.withColumns(change), labels, "id", "y")
    with pytest.raises(ValueError, match="row counts"):
        evaluate.evaluate(good.limit(1), labels, "id", "y")


def test_run_writes_everything(spark, tmp_path):
    train, current = frames(spark, lambda c, rng: c.__setitem__("x0", c["x0"] * 100), n=120)
    a, b, out = (str(tmp_path / n) for n in ("train.parquet", "current.parquet", "out"))
    train.write.parquet(a)
    current.write.parquet(b)
    seen = []
    metrics = pipeline.run(spark, a, b, out, on_phase=lambda name, what: seen.append(name), trees=3)
    assert metrics["success"], metrics
    assert metrics["fits"] == 1 and metrics["rows_scored"] == 900 and seen == ["read", "plan", "fit", "score"]
    scores = spark.read.option("header", True).csv(f"{out}/predictions")
    assert scores.columns == ["CustomerID", "probability_score"] and scores.count() == 900
    assert json.load(open(f"{out}/metrics.json"))["rows_scored"] == 900
    assert pipeline.run(spark, a, str(tmp_path / "none.parquet"), out)["success"] is False


def test_documents(tmp_path, spark):
    with pytest.raises(pipeline.ArtifactError):
        pipeline.validate_document({"schema": {"name": pipeline.SCHEMA, "version": "2.0.0"}})
    good = {"schema": {"name": pipeline.SCHEMA, "version": "1.4.0"}, "summary": {}, "run": {}, "features": []}
    pipeline.write_json(str(tmp_path / "d.json"), good)
    assert pipeline.load_document(str(tmp_path / "d.json")) == good
    assert "+--" in pipeline.phase_box("Phase", [("rows", 3)])


def test_report_tables(spark):
    table = spark.createDataFrame([("a", "Numeric", "Changed", 0.2, 0.1, 3.0, "Repair"), ("b", "Numeric", "Stable", 0.0, 0.1, 0.1, "Keep")], "feature string, type string, status string, current double, historical double, severity double, action string")
    assert [r.feature for r in report.filtered(table, search="A").collect()] == ["a"]
    assert [r.feature for r in report.needs_attention(table).collect()] == ["a"]
    assert report.selected(table, "zzz").first().feature == "a" and report.selected(table, "b").first().feature == "b"
    assert report.severity_scale(table.limit(0)).first()[0] == 1.0
    with pytest.raises(ValueError):
        report.most_severe(table, 0)


def test_stream_equals_batch(spark, tmp_path):
    train, current = frames(spark, n=60)
    plan = build_plan(train, current)
    model = OnceFitted(plan, trees=2).fit(check_target(train, plan.contract))
    with pytest.raises(RuntimeError):
        model.fit(train)
    source = str(tmp_path / "in")
    current.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(current.schema).option("maxFilesPerTrigger", 1).parquet(source)
    write_scores(stream, model, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = {r.CustomerID: r.probability_score for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r.CustomerID: r.probability_score for r in model.score(current).collect()}
    assert got == want


def test_entry_module(spark):
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) >= 55
    assert entry.entry(spark).columns == ["feature", "current_shift", "historical_max_shift", "novelty_ratio"]
