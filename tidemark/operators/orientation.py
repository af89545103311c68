"""Direction evidence: does a feature still point the same way as a consensus of stable features?"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import canonical_category, lookup, number, right_closed_bucket
from . import drift, ranks
from .held import Hold, as_it_is, holding
from .profile import Blocks, cumulative, long_form


@dataclass(frozen=True)
class OrientationLimits:
    """anchors: the most that a consensus averages; levels: a categorical anchor with more is looked up by a join, not in a literal map.

    pairs: the fewest recent rows that an anchor can be validated on.
    """

    bins: int = 10
    smoothing: float = 200.0
    anchor_shift: float = 0.05
    anchor_novelty: float = 2.0
    validation: float = 0.01
    spread: float = 1e-8
    least_anchors: int = 8
    anchors: int = 32
    rank_distinct: int = 10
    levels: int = 10_000
    pairs: int = 3


def _smoothed(total: Column, n: Column, rate: Column, smoothing: float) -> Column:
    return (total + smoothing * rate) / (n + smoothing)


def numeric_edges(reference: DataFrame, features: list[str], bins: int = 10) -> DataFrame:
    """(feature, inner): inner decile edges.  Only features with three values and three different edges have a row."""
    long = long_form(reference, [], features, True).where("value IS NOT NULL")
    counts = long.groupBy("feature", "value").agg(F.count("*").alias("n"))
    q = cumulative(counts, ["n"]).groupBy("feature").agg(F.count("*").alias("distinct"), F.array(*[drift.quantile("n", i / bins) for i in range(bins + 1)]).alias("q"))
    edges = q.where("distinct >= 3").select("feature", F.array_distinct("q").alias("e")).where(F.size("e") >= 3)
    return edges.select("feature", F.slice("e", 2, F.size("e") - 2).alias("inner"))


def numeric_label_rates(reference: DataFrame, features: list[str], target: str, limits: OrientationLimits = OrientationLimits()) -> DataFrame:
    """(feature, bucket, n, rate): smoothed target rate of right-closed decile buckets; buckets count from 0."""
    edges = numeric_edges(reference, features, limits.bins)
    rate = reference.agg(F.avg(target).alias("g"))
    long = long_form(reference, [target], features, True).where("value IS NOT NULL").join(F.broadcast(edges), "feature")
    cells = long.groupBy("feature", right_closed_bucket(F.col("value"), F.col("inner")).alias("bucket")).agg(F.sum(target).alias("s"), F.count("*").alias("n"))
    return cells.crossJoin(F.broadcast(rate)).select("feature", "bucket", "n", _smoothed(F.col("s"), F.col("n"), F.col("g"), limits.smoothing).alias("rate"))


def category_label_rates(reference: DataFrame, features: list[str], target: str, limits: OrientationLimits = OrientationLimits()) -> DataFrame:
    """(feature, level, n, rate) by canonical level."""
    rate = reference.agg(F.avg(target).alias("g"))
    long = long_form(reference, [target], features, False).withColumn("level", canonical_category(F.col("value")))
    cells = long.groupBy("feature", "level").agg(F.sum(target).alias("s"), F.count("*").alias("n"))
    return cells.crossJoin(F.broadcast(rate)).select("feature", "level", "n", _smoothed(F.col("s"), F.col("n"), F.col("g"), limits.smoothing).alias("rate"))


@dataclass(frozen=True)
class Anchor:
    """A frozen lookup of one feature, with centre and spread of its scores over the recent rows.

    table: (level, rate) of a categorical feature with many levels; ``looked_up`` joins it to the rows that are scored.
    """

    feature: str
    inner: tuple[float, ...] | None
    rates: dict
    default: float
    validation: float = 0.0
    centre: float = 0.0
    spread: float = 1.0
    table: DataFrame | None = None

    @property
    def joined(self) -> str:
        return f"__rate_{self.feature}"

    def score(self) -> Column:
        if self.table is not None:
            return F.coalesce(F.col(f"`{self.joined}`"), F.lit(self.default))
        if self.inner is not None:
            v = number(F.col(f"`{self.feature}`"))
            inner = F.array(*[F.lit(float(e)) for e in self.inner])
            at = lookup({int(k): float(x) for k, x in self.rates.items()}, right_closed_bucket(v, inner), F.lit(self.default))
            return F.when(v.isNull(), F.lit(self.default)).otherwise(at)
        return lookup({str(k): float(x) for k, x in self.rates.items()}, canonical_category(F.col(f"`{self.feature}`")), F.lit(self.default))

    def standard(self) -> Column:
        return (self.score() - F.lit(self.centre)) / F.lit(self.spread)


def looked_up(rows: DataFrame, anchors: list[Anchor]) -> DataFrame:
    """rows with the rates of those anchors that are tables."""
    for a in anchors:
        if a.table is not None:
            table = a.table.select(F.col("level").alias("__level"), F.col("rate").alias(a.joined))
            rows = rows.join(table, canonical_category(F.col(f"`{a.feature}`")) == F.col("__level"), "left").drop("__level")
    return rows


def profiles(reference: DataFrame, numeric: list[str], categorical: list[str], target: str, limits: OrientationLimits = OrientationLimits()) -> list[Anchor]:
    """Frozen label-rate lookups of all features given: literal maps up to limits.levels levels, tables beyond."""
    g = reference.agg(F.avg(target)).first()[0] or 0.0
    out = []
    if numeric:
        inner = {r.feature: tuple(r.inner) for r in numeric_edges(reference, numeric, limits.bins).collect()}
        rates: dict[str, dict] = {}
        for r in numeric_label_rates(reference, list(inner), target, limits).collect() if inner else []:
            rates.setdefault(r.feature, {})[r.bucket] = r.rate
        out += [Anchor(f, inner[f], rates.get(f, {}), g) for f in numeric if f in inner]
    if categorical:
        table = category_label_rates(reference, categorical, target, limits)
        size = {r.feature: r.levels for r in table.groupBy("feature").agg(F.count("*").alias("levels")).collect()}
        rates = {}
        for r in table.where(F.col("feature").isin([f for f, n in size.items() if n <= limits.levels])).collect():
            rates.setdefault(r.feature, {})[r.level] = r.rate
        out += [Anchor(f, None, rates.get(f, {}), g, table=None if f in rates else table.where(F.col("feature") == f)) for f in categorical if f in size]
    return out


def anchor_candidates(evidence: DataFrame, limits: OrientationLimits = OrientationLimits()) -> DataFrame:
    """Stable features that are not under review as novel."""
    return evidence.where((F.col("action") != drift.REVIEW_NOVEL) & (F.col("current_shift") <= limits.anchor_shift) & (F.col("novelty_ratio") < limits.anchor_novelty))


def validated(recent: DataFrame, candidates: list[Anchor], target: str, order: list[str], limits: OrientationLimits = OrientationLimits()) -> list[Anchor]:
    """Anchors by |validation| (Spearman of score and target over the recent rows), strongest first, ties in feature order."""
    if not candidates:
        return []
    pairs = F.array(*[F.struct(F.lit(a.feature).alias("feature"), a.score().alias("value")) for a in candidates])
    long = looked_up(recent, candidates).select(F.col(target).alias("__y"), F.explode(pairs).alias("p")).select("__y", "p.*")
    counts = long.groupBy("feature", "value").agg(F.count("*").alias("n_train"), F.sum("__y").alias("pos"))
    strength = drift.rank_correlation_with_target(cumulative(counts, ["n_train"]), limits.pairs)
    at = counts.groupBy("feature").agg((F.sum(F.col("value") * F.col("n_train")) / F.sum("n_train")).alias("centre"))
    spread = counts.join(F.broadcast(at), "feature").groupBy("feature", "centre").agg(F.sqrt(F.sum(F.col("n_train") * (F.col("value") - F.col("centre")) ** 2) / F.sum("n_train")).alias("spread"))
    rows = {r.feature: r for r in strength.join(spread, "feature").collect()}
    good = [
        replace(a, validation=r.predictive_strength, centre=r.centre, spread=r.spread)
        for a in candidates
        if (r := rows.get(a.feature)) and r.predictive_strength >= limits.validation and r.spread > limits.spread
    ]
    return sorted(good, key=lambda a: (-a.validation, order.index(a.feature)))[: limits.anchors]


def consensus(anchors: list[Anchor]) -> Column:
    total = anchors[0].standard()
    for a in anchors[1:]:
        total = total + a.standard()
    return total / len(anchors)


def direction(rows: DataFrame, features: list[str], anchors: list[Anchor], period: str = "period_idx", hold: Hold = as_it_is) -> DataFrame:
    """(feature, spearman) of the rank within the period and the consensus."""
    long = long_form(looked_up(rows, anchors).withColumn("__consensus", consensus(anchors)), [period, "__consensus"], features, True).where("value IS NOT NULL")
    long = hold(long)
    table = ranks.percentile_ranks(long, ["feature", period]).select("feature", period, "value", "percentile")
    return drift.spearman(long.join(table, ["feature", period, "value"]), "percentile", "__consensus", ["feature"])


def add_orientation(evidence: DataFrame, train: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str], blocks: Blocks, target: str, limits: OrientationLimits = OrientationLimits(), period: str = "period_idx") -> DataFrame:
    """evidence with orientation_train, orientation_test and orientation_anchor_count; zeros where nothing is under review."""
    zero = {"orientation_train": F.lit(0.0), "orientation_test": F.lit(0.0), "orientation_anchor_count": F.lit(0)}
    with holding() as hold:
        return _add_orientation(evidence, train, current, numeric, categorical, blocks, target, limits, period, zero, hold)


def _add_orientation(evidence: DataFrame, train: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str], blocks: Blocks, target: str, limits: OrientationLimits, period: str, zero: dict, hold: Hold) -> DataFrame:
    review = evidence.where(F.col("action") == drift.REVIEW_NOVEL).select("feature", "kind", "unique_values").collect()
    if not review:
        return evidence.withColumns(zero)
    stable = {r.feature for r in anchor_candidates(evidence, limits).select("feature").collect()}
    latest = F.coalesce(F.col(period).isin(*blocks.recent_periods()), F.lit(False))
    recent, reference = train.where(latest), train.where(~latest)
    found = profiles(reference, [f for f in numeric if f in stable], [f for f in categorical if f in stable], target, limits)
    anchors = validated(recent, found, target, [c for c in train.columns if c in stable], limits)
    n = len(anchors)
    turned = [r.feature for r in review if r.kind == "numeric" and r.unique_values >= limits.rank_distinct]
    if n < limits.least_anchors or not turned:
        return evidence.withColumns(zero | {"orientation_anchor_count": F.when(F.col("action") == drift.REVIEW_NOVEL, F.lit(n)).otherwise(F.lit(0))})
    a = direction(recent, turned, anchors, period, hold).withColumnRenamed("spearman", "orientation_train")
    b = direction(current, turned, anchors, period, hold).withColumnRenamed("spearman", "orientation_test")
    counted = F.when(F.col("action") == drift.REVIEW_NOVEL, F.lit(n)).otherwise(F.lit(0))
    out = evidence.join(a, "feature", "left").join(b, "feature", "left")
    either = {c: F.coalesce(c, F.lit(0.0)) for c in ("orientation_train", "orientation_test")}
    return drift.frozen(out.withColumns(either | {"orientation_anchor_count": counted}))


def detect_drift(train: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str], blocks: Blocks, target: str, period: str = "period_idx") -> DataFrame:
    """Base evidence, systemic context, then direction."""
    evidence = drift.add_systemic(drift.base_evidence(train, current, numeric, categorical, blocks, target, period=period))
    return add_orientation(evidence, train, current, numeric, categorical, blocks, target, period=period)


def top_anchors(strength: DataFrame, most: int = 32) -> DataFrame:
    """(feature, predictive_strength, anchor_rank): the strongest first, ties by name."""
    return strength.withColumn("anchor_rank", F.row_number().over(Window.orderBy(F.desc("predictive_strength"), "feature"))).where(F.col("anchor_rank") <= most)
