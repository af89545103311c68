"""Report tables: histograms, category shares, history series, filters and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import canonical_category, histogram_bin, linspace, shares, title_case
from . import policy

BINS, CATEGORIES, OTHER = 20, 25, "Other"


def shared_edges(long: DataFrame, bins: int = BINS) -> DataFrame:
    """(feature, edges): equal bins from least to greatest finite value; half a unit around a constant; 0..1 without values."""
    v = F.when(~F.isnan("value") & (F.abs("value") < float("inf")), F.col("value"))
    e = long.groupBy("feature").agg(F.min(v).alias("low"), F.max(v).alias("high"))
    flat = F.col("high") - F.col("low") <= 1e-12
    low = F.when(F.col("low").isNull(), F.lit(0.0)).when(flat, F.col("low") - 0.5).otherwise(F.col("low"))
    high = F.when(F.col("low").isNull(), F.lit(1.0)).when(flat, F.col("low") + 0.5).otherwise(F.col("high"))
    return e.select("feature", linspace(low, high, bins + 1).alias("edges"))


def histograms(long: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """(feature, keys, bin, n): counts of finite values by bin; empty bins have no row.  edges: one row a feature."""
    placed = long.join(F.broadcast(edges), "feature").withColumn("bin", histogram_bin(F.col("value"), F.col("edges")))
    return placed.where("bin IS NOT NULL").groupBy("feature", *keys, "bin").agg(F.count("*").alias("n"))


def histogram_arrays(long: DataFrame, edges: DataFrame, keys: list[str], bins: int = BINS) -> DataFrame:
    """(feature, keys, counts, shares): dense arrays."""
    cells = histograms(long, edges, keys).groupBy("feature", *keys).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0)))
    return cells.select("feature", *keys, counts.alias("counts")).withColumn("shares", shares(F.col("counts")))


def category_shares(long: DataFrame, sides: list[str], most: int = CATEGORIES) -> DataFrame:
    """(feature, category, position, n_<side>, share_<side>): most frequent canonical levels over all sides, the rest as Other.

    long: (feature, value, side).  Ties by label.
    """
    level = canonical_category(F.col("value"))
    counts = long.groupBy("feature", level.alias("level")).agg(*[F.count_if(F.col("side") == s).alias(f"n_{s}") for s in sides])
    total = sum((F.col(f"n_{s}") for s in sides[1:]), F.col(f"n_{sides[0]}"))
    whole = counts.groupBy("feature").agg(F.count("*").alias("levels"), *[F.sum(f"n_{s}").alias(f"t_{s}") for s in sides])
    kept = F.when(F.col("levels") > most, F.lit(most - 1)).otherwise(F.lit(most))
    order = Window.partitionBy("feature").orderBy(F.desc(total), "level")
    first = counts.withColumn("position", F.row_number().over(order)).where(F.col("position") <= most)  # a group limit: each task passes on so many
    named = first.join(F.broadcast(whole), "feature").where(F.col("position") <= kept)
    shown = [*[f"n_{s}" for s in sides], *[f"t_{s}" for s in sides]]
    rest = named.where("levels > " + str(most)).groupBy("feature").agg(*[(F.max(f"t_{s}") - F.sum(f"n_{s}")).alias(f"n_{s}") for s in sides], *[F.max(f"t_{s}").alias(f"t_{s}") for s in sides])
    cells = named.select("feature", F.col("level").alias("category"), "position", *shown).unionByName(rest.select("feature", F.lit(OTHER).alias("category"), F.lit(most).alias("position"), *shown))
    return cells.select("feature", "category", "position", *[f"n_{s}" for s in sides], *[(F.col(f"n_{s}") / F.greatest(F.lit(1), F.col(f"t_{s}"))).alias(f"share_{s}") for s in sides])


def feature_table(evidence: DataFrame) -> DataFrame:
    """The seven columns of the feature list."""
    status = F.when(F.col("action") == policy.KEEP, F.lit("stable")).otherwise(F.lit("changed"))
    return evidence.select(
        "feature", title_case(F.col("kind")).alias("type"), title_case(status).alias("status"), F.col("current_shift").alias("current"),
        F.col("historical_max_shift").alias("historical"), F.col("novelty_ratio").alias("severity"), title_case(policy.family(F.col("action"))).alias("action"),
    )


def filtered(table: DataFrame, search: str = "", status: str = "All", kind: str = "All types", sort: str = "severity", descending: bool = True) -> DataFrame:
    """The list as a user narrows and sorts it; ties by feature."""
    out = table
    if search:
        out = out.where(F.contains(F.lower("feature"), F.lit(search.lower())))
    if status == "Changed":
        out = out.where(F.col("status") == "Changed")
    elif status in ("Repaired", "Dropped", "Kept"):
        out = out.where(F.col("action") == {"Repaired": "Repair", "Dropped": "Drop", "Kept": "Keep"}[status])
    if kind != "All types":
        out = out.where(F.col("type") == kind)
    return out.orderBy(F.desc(sort) if descending else F.asc(sort), "feature")


def needs_attention(table: DataFrame) -> DataFrame:
    return table.where(F.col("action") != "Keep")


def most_severe(table: DataFrame, k: int = 10) -> DataFrame:
    if k < 1:
        raise ValueError("the ranking needs one row at least")
    return table.select("feature", "severity", "action").orderBy(F.desc("severity"), "feature").limit(k)


def by_name(table: DataFrame, name: str) -> DataFrame:
    return table.where(F.col("feature") == name)


def selected(table: DataFrame, name: str | None) -> DataFrame:
    """The named feature if it is listed, else the first one, else no row."""
    return table.orderBy(F.when(F.col("feature") == F.lit(name), 0).otherwise(1), F.desc("severity"), "feature").limit(1)


def action_counts(evidence: DataFrame) -> DataFrame:
    """(action, features, n): sorted names by action; there is one name a feature."""
    return evidence.groupBy("action").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("feature")), ",").alias("features"))


def family_counts(evidence: DataFrame) -> DataFrame:
    return evidence.groupBy(policy.family(F.col("action")).alias("family")).agg(F.count("*").alias("n"))


def severity_scale(table: DataFrame) -> DataFrame:
    """One row: the largest finite positive severity, else 1."""
    s = F.when((F.col("severity") > 0) & (F.col("severity") < float("inf")), F.col("severity"))
    return table.agg(F.coalesce(F.max(s), F.lit(1.0)).alias("scale"))


def direction_known(evidence: DataFrame) -> DataFrame:
    """Features with a direction on both sides."""
    return evidence.where((F.col("orientation_anchor_count") > 0) & (F.col("orientation_train") != 0) & (F.col("orientation_test") != 0))
