"""The whole run: read, plan, fit once, score, validate, write, and the artifacts that describe it."""

from __future__ import annotations

import json
import os
import resource
import time
import uuid
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate, report
from ..sources.contract import ColumnContract, read_table
from . import preparation
from .model import OnceFitted

SCHEMA, VERSION = "tidemark-run", "1.0.0"


class ArtifactError(ValueError):
    """A run document that cannot be used."""


def write_json(path: str, payload: dict) -> None:
    """Through a temporary file, so that a reader never sees half a document."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    scratch = f"{path}.tmp"
    Path(scratch).write_text(json.dumps(payload, indent=2, default=str), encoding="utf-8")
    os.replace(scratch, path)


def phase_box(title: str, rows: list[tuple[str, object]]) -> str:
    """A small text table for the console."""
    width = max([len(title), *(len(k) + len(str(v)) + 3 for k, v in rows)])
    rule = "+" + "-" * (width + 2) + "+"
    lines = [f"| {title.ljust(width)} |", *(f"| {(k + ' : ' + str(v)).ljust(width)} |" for k, v in rows)]
    return "\n".join([rule, lines[0], rule, *lines[1:], rule])


def write_predictions(scored: DataFrame, path: str, id_col: str) -> int:
    """Score once, validate and publish (id, probability_score) as CSV files.

    Rows go to a folder beside path and are counted and checked on their way; only a valid table takes path's place.
    """
    spark, seen = scored.sparkSession, Observation("scores")
    s, aside = F.col("probability_score"), f"{path.rstrip('/')}.unchecked-{uuid.uuid4().hex}"
    bad = F.count_if(s.isNull() | F.isnan(s) | ~s.between(0.0, 1.0))
    hadoop = spark._jvm.org.apache.hadoop.fs
    here, there = hadoop.Path(aside), hadoop.Path(path)
    files = there.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        scored.select(id_col, "probability_score").observe(seen, F.count(F.lit(1)).alias("row_count"), bad.alias("bad_scores")).write.option("header", True).csv(aside)
        found = seen.get
        if found["bad_scores"]:
            raise ValueError(f"{found['bad_scores']} of {found['row_count']} scores are outside [0, 1]")
        if not found["row_count"]:
            raise ValueError("there is nothing to score")
        files.delete(there, True)
        files.rename(here, there)
    finally:
        files.delete(here, True)
    return found["row_count"]


def run(spark: SparkSession, train_path: str, current_path: str, out: str, contract: ColumnContract = ColumnContract(), on_phase: Callable[[str, dict], None] | None = None, trees: int = 20) -> dict:
    """Writes predictions, metrics.json, plan.json and drift.json below out; returns the metrics.  Errors are reported, not raised."""
    started, phases = time.perf_counter(), {}

    def phase(name: str, since: float, **what) -> float:
        now = time.perf_counter()
        phases[name] = round(now - since, 3)
        if on_phase:
            on_phase(name, {"seconds": phases[name]} | what)
        return now

    try:
        for p in (train_path, current_path):
            if "://" not in p and not os.path.exists(p):
                raise FileNotFoundError(p)
        train, current = read_table(spark, train_path), read_table(spark, current_path)
        at = phase("read", started)
        plan = preparation.build_plan(train, current, contract)
        at = phase("plan", at, actions=plan.actions)
        labelled = preparation.check_target(train, contract)
        model = OnceFitted(plan, trees=trees).fit(labelled)
        train_score = evaluate.average_precision(model.score(labelled, "train", ("__target",)), "probability_score", "__target").first()[0]
        at = phase("fit", at, average_precision=train_score)
        scored = model.score(preparation.without_target(current, contract))
        n = write_predictions(scored, f"{out}/predictions", contract.id)
        at = phase("score", at, rows=n)
        actions = plan.actions
        metrics = {
            "success": True, "rows_scored": n, "fits": model.fits, "train_average_precision": train_score, "phases": phases, "seconds": round(at - started, 3),
            "peak_driver_mib": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024, "actions": {a: sorted(f for f in actions if actions[f] == a) for a in sorted(set(actions.values()))},
        }
        write_json(f"{out}/plan.json", plan.summary())
        write_json(f"{out}/drift.json", {"features": plan.evidence})
        write_json(f"{out}/metrics.json", metrics)
        return metrics
    except Exception as e:
        return {"success": False, "error": f"{type(e).__name__}: {e}"}


def history_series(plan_evidence: DataFrame) -> DataFrame:
    return plan_evidence.select("feature", "historical_max_shift", "current_shift")


def run_document(spark: SparkSession, plan: preparation.PreparationPlan, metrics: dict) -> dict:
    """The versioned document that a viewer reads."""
    shown = report.feature_table(spark.createDataFrame([(r["feature"], r["kind"], r["action"], r["current_shift"], r["historical_max_shift"], r["novelty_ratio"]) for r in plan.evidence], "feature string, kind string, action string, current_shift double, historical_max_shift double, novelty_ratio double"))
    features = [r.asDict() for r in shown.orderBy("feature").collect()]
    return {"schema": {"name": SCHEMA, "version": VERSION}, "generated_at_utc": datetime.now(UTC).isoformat(), "summary": {"features": len(features)}, "run": metrics, "features": features}


def validate_document(payload: dict) -> dict:
    """The document, if its schema is known and complete."""
    schema = payload.get("schema") or {}
    if schema.get("name") != SCHEMA or str(schema.get("version", "")).split(".")[0] != VERSION.split(".")[0]:
        raise ArtifactError(f"unknown schema {schema}")
    for key in ("summary", "run", "features"):
        if key not in payload:
            raise ArtifactError(f"the document has no {key}")
    for f in payload["features"]:
        missing = {"feature", "type", "status", "current", "historical", "severity", "action"} - set(f)
        if missing:
            raise ArtifactError(f"a feature lacks {sorted(missing)}")
    return payload


def load_document(path: str) -> dict:
    try:
        return validate_document(json.loads(Path(path).read_text(encoding="utf-8")))
    except (OSError, json.JSONDecodeError) as e:
        raise ArtifactError(str(e)) from e


def stage_table(spark: SparkSession, metrics: dict) -> DataFrame:
    """(stage, seconds): one row a phase."""
    return spark.createDataFrame([(k, float(v)) for k, v in metrics["phases"].items()], "stage string, seconds double").withColumn("seconds", F.round("seconds", 3))
