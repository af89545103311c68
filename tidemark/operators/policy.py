"""Mitigation policy: one CASE chain over the evidence; the first rule that holds decides."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .drift import REVIEW_MISSINGNESS, REVIEW_NOVEL

#: Actions, how they are shown, and how they repair.
KEEP, KEEP_DRIFTED, KEEP_SYSTEMIC = "KEEP", "KEEP_DRIFTED", "KEEP_SYSTEMIC_DRIFT"
REVERSE, SCALE, OFFSET, REMAP = "REVERSE_PERCENTILE", "REALIGN_SCALE", "REALIGN_OFFSET", "REMAP_CATEGORIES"
DROP = "DROP_NOVEL_UNRELIABLE"
KEEP_ACTIONS, REPAIR_ACTIONS = (KEEP, KEEP_DRIFTED, KEEP_SYSTEMIC), (REVERSE, SCALE, OFFSET, REMAP)
SHOWN = {
    KEEP: ("KEEP", "No mitigation applied"),
    KEEP_DRIFTED: ("KEEP", "Preserve same-semantic population drift"),
    KEEP_SYSTEMIC: ("KEEP", "Preserve systemic drift"),
    REVERSE: ("REPAIR", "Reverse percentile representation"),
    SCALE: ("REPAIR", "Scale realignment"),
    OFFSET: ("REPAIR", "Offset realignment"),
    REMAP: ("REPAIR", "Category remapping"),
    DROP: ("DROP", "Exclude unreliable feature"),
}


@dataclass(frozen=True)
class PolicyLimits:
    rank_distinct: int = 10
    anchors: int = 8
    reverse_train: float = 0.08
    reverse_test: float = 0.05
    reverse_novelty: float = 2.5
    reverse_predictive: float = 0.20
    reverse_support: float = 0.85
    keep_support: float = 0.80
    drop_support: float = 0.15
    drop_missing: float = 0.50


def rules(limits: PolicyLimits = PolicyLimits()) -> list[tuple[Column, str, str]]:
    """(condition, action, reason) in order."""
    c = F.col
    numeric, text = c("kind") == "numeric", c("kind") == "categorical"
    novel, lost = c("action") == REVIEW_NOVEL, c("action") == REVIEW_MISSINGNESS
    turned = (
        numeric & (c("unique_values") >= limits.rank_distinct) & (c("orientation_anchor_count") >= limits.anchors)
        & (F.signum("orientation_train") != F.signum("orientation_test")) & (F.abs("orientation_train") >= limits.reverse_train) & (F.abs("orientation_test") >= limits.reverse_test)
        & (c("novelty_ratio") >= limits.reverse_novelty) & (c("predictive_strength") >= limits.reverse_predictive) & (c("support_retention_ratio") >= limits.reverse_support)
    )
    safe = lambda name: F.coalesce(c(f"evidence_checks.{name}"), F.lit(False))
    return [
        (turned, REVERSE, "direction against stable anchors turned round, with enough novelty and signal"),
        (novel & numeric & c("scale_factor").isNotNull() & safe("scale_repair_safe"), SCALE, "spread changed by one large factor while the standardised shape stayed"),
        (novel & numeric & c("offset").isNotNull() & safe("offset_repair_safe"), OFFSET, "values moved by one large offset while spread and shape stayed"),
        (novel & text & c("category_mapping").isNotNull() & safe("category_remap_safe"), REMAP, "labels were replaced and their frequencies allow one mapping only"),
        (c("systemic_drift_active"), KEEP_SYSTEMIC, "a large share of features moved together"),
        (text & (c("known_category_support_ratio") >= limits.keep_support), KEEP_DRIFTED, "labels are known, only their shares changed"),
        (lost & (c("missing_shift") >= limits.drop_missing), DROP, "most values are newly missing and cannot be restored"),
        (text & (c("known_category_support_ratio") <= limits.drop_support), DROP, "most known labels are gone and no mapping is certain"),
        (F.lit(True), KEEP_DRIFTED, "moved unusually, but no safe repair and no clear loss"),
    ]


def choose_actions(evidence: DataFrame, limits: PolicyLimits = PolicyLimits()) -> DataFrame:
    """Rows under review get an action and its reason; other rows pass."""
    action, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
    for condition, name, why in reversed(rules(limits)):
        action, reason = F.when(condition, F.lit(name)).otherwise(action), F.when(condition, F.lit(why)).otherwise(reason)
    review = F.col("action").isin(REVIEW_NOVEL, REVIEW_MISSINGNESS)
    return evidence.withColumns({"action": F.when(review, action).otherwise(F.col("action")), "reason": F.when(review, reason).otherwise(F.lit(""))})


def family(action: Column) -> Column:
    return F.when(action.isin(*REPAIR_ACTIONS), F.lit("REPAIR")).when(action == DROP, F.lit("DROP")).otherwise(F.lit("KEEP"))


def method(action: Column) -> Column:
    out = F.lit(SHOWN[KEEP][1])
    for name, (_, how) in SHOWN.items():
        out = F.when(action == name, F.lit(how)).otherwise(out)
    return out
