"""Drift evidence for each feature, from value counts (see ``profile``): shift, novelty, missingness, support, signal, representation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MISSING, finite_or_zero, novelty
from . import profile as P
from .held import Hold, as_it_is, holding


@dataclass(frozen=True)
class Thresholds:
    """Fixed values that decide when a feature is reviewed and when a repair is safe."""

    current_shift: float = 0.10
    novelty: float = 2.0
    predictive: float = 0.06
    systemic_fraction: float = 0.40
    missing_shift: float = 0.10
    main_missing_share: float = 0.5
    main_missing_least: float = 0.05
    observations: int = 200
    distinct: int = 20
    spread_least: float = 1e-10
    shape_ks: float = 0.10
    scale_factor: float = 5.0
    alignment_error: float = 0.35
    offset_ratio_low: float = 0.80
    offset_ratio_high: float = 1.25
    offset_spreads: float = 6.0
    remap_levels: int = 25
    remap_support: float = 0.15
    remap_tv: float = 0.08
    remap_gap: float = 0.05
    level_count: int = 30
    level_share: float = 0.0004


LIMITS = Thresholds()
#: Features that evidence may have rows for on the driver.
MOST_FEATURES = 100_000
PROBABILITIES = (0.10, 0.25, 0.50, 0.75, 0.90)
REVIEW_NOVEL, REVIEW_MISSINGNESS, KEEP = "REVIEW_NOVEL", "REVIEW_MISSINGNESS", "KEEP"


def _greatest(texts: list[str]) -> Column:
    """The largest of SQL expressions, null as 0; 0 if there is none."""
    return F.expr(f"greatest(0D, 0D{''.join(f', coalesce({x}, 0D)' for x in texts)})")


def ks_between(a: str, b: str) -> Column:
    """Aggregate over a cumulative table: the two-sample Kolmogorov-Smirnov statistic of two counters; 0 if one is empty."""
    return F.expr(f"coalesce(max(abs(try_divide(c_{a}, t_{a}) - try_divide(c_{b}, t_{b}))), 0D)")


def total_variation_between(a: str, b: str, sums: dict[str, str]) -> Column:
    """Aggregate over level counts with totals t_*: half the sum of share differences."""
    share = lambda c: f"coalesce(try_divide({c}, {sums[c]}), 0D)"
    return F.expr(f"0.5D * sum(abs({share(a)} - {share(b)}))")


def quantile(counter: str, p: float) -> Column:
    """Aggregate over a cumulative table: the p quantile of a counter's values, linear between neighbours."""
    place = f"((t_{counter} - 1) * {float(p)!r}D)"
    low = f"floor({place})"
    at = lambda k: f"min(CASE WHEN c_{counter} >= {k} THEN value END)"
    a, b = at(f"{low} + 1"), at(f"least({low} + 2, t_{counter})")
    return F.expr(f"{a} + max({place} - {low}) * ({b} - {a})")


def with_totals(counts: DataFrame, counters: list[str]) -> DataFrame:
    """counts with t_<counter> of their feature; totals are a row for each feature, so they are broadcast."""
    totals = counts.groupBy("feature").agg(*[F.expr(f"sum({c}) AS t_{c}") for c in counters])
    return counts.join(F.broadcast(totals), "feature")


def adjacent(blocks: P.Blocks) -> list[tuple[str, str]]:
    return [(f"b{i}", f"b{i + 1}") for i in range(blocks.count - 1)]


def recent_counter(blocks: P.Blocks) -> str:
    return f"b{blocks.count - 1}"


def counters_of(blocks: P.Blocks) -> list[str]:
    return [f"b{i}" for i in range(blocks.count)] + ["n_current"]


def numeric_shift(counts: DataFrame, blocks: P.Blocks) -> DataFrame:
    """(feature, current_shift, historical_max_shift, shifts by adjacent pair) of value counts."""
    one = P.adjacent_gaps(counts, counters_of(blocks))
    past = [F.col("gaps")[i].alias(f"h_{a}") for i, (a, _) in enumerate(adjacent(blocks))]
    one = one.select("feature", F.col("gaps")[blocks.count - 1].alias("current_shift"), *past)
    return one.withColumn("historical_max_shift", _greatest([f"h_{a}" for a, _ in adjacent(blocks)]))


def categorical_shift(levels: DataFrame, blocks: P.Blocks) -> DataFrame:
    """The same for level counts, by total variation; the missing level is a level."""
    counters, pairs = counters_of(blocks), adjacent(blocks)
    totals = {c: f"t_{c}" for c in counters}
    one = with_totals(levels, counters).groupBy("feature").agg(
        total_variation_between(recent_counter(blocks), "n_current", totals).alias("current_shift"),
        *[total_variation_between(a, b, totals).alias(f"h_{a}") for a, b in pairs],
    )
    return one.withColumn("historical_max_shift", _greatest([f"h_{a}" for a, _ in pairs]))


def rank_correlation_with_target(cumulated: DataFrame, least: int = 20) -> DataFrame:
    """(feature, predictive_strength): |Spearman| of a feature and a 0/1 target, from counts alone; 0 for fewer rows than least.

    Ranks of a two-valued target are affine in it, so this is the correlation of the feature's average ranks with the
    target; both follow from n_train, its cumulative count and pos.
    """
    off = "(c_n_train - (n_train - 1) / 2 - (t_n_train + 1) / 2)"
    one = cumulated.where("n_train > 0").groupBy("feature").agg(
        F.expr("sum(n_train) AS n"), F.expr("sum(pos) AS p"), F.expr("count(*) AS d"), F.expr("max(value) - min(value) AS width"),
        F.expr(f"sum(pos * {off}) AS cov"), F.expr(f"sum(n_train * {off} * {off}) AS var"),
    )
    usable = f"n >= {least} AND d >= 2 AND width > 1e-12D AND p > 0 AND p < n"
    return one.selectExpr("feature", f"CASE WHEN {usable} THEN abs(cov / n / (sqrt(var / n) * sqrt(p / n * (1 - p / n)))) ELSE 0D END AS predictive_strength")


def level_rate_spread(levels: DataFrame, limits: Thresholds = LIMITS) -> DataFrame:
    """(feature, predictive_strength): weighted deviation of the target rate over levels that are frequent enough."""
    least = F.greatest(F.lit(limits.level_count), F.floor(F.col("t_n_train") * limits.level_share))
    kept = with_totals(levels.select("feature", "level", "n_train", "pos"), ["n_train"]).where((F.col("n_train") >= least) & (F.col("n_train") > 0))
    n, p = F.sum("n_train"), F.sum("pos")
    one = kept.groupBy("feature").agg(F.count("*").alias("d"), (F.sum(F.col("pos") * F.col("pos") / F.col("n_train")) / n - (p / n) * (p / n)).alias("v"))
    centred = F.when(F.col("d") >= 2, F.sqrt(F.greatest(F.col("v"), F.lit(0.0)))).otherwise(F.lit(0.0))
    return one.select("feature", centred.alias("predictive_strength"))


def known_support(levels: DataFrame, recent: str, missing: bool = True) -> DataFrame:
    """(feature, known_category_support_ratio): share of current rows whose level the recent block knows."""
    some = levels if missing else levels.where(F.col("level") != MISSING)
    known = F.sum(F.when(F.col(recent) > 0, F.col("n_current")).otherwise(0))
    return some.groupBy("feature").agg(F.coalesce(F.try_divide(known, F.sum("n_current")), F.lit(0.0)).alias("known_category_support_ratio"))


def representation(cumulated: DataFrame, recent: str, limits: Thresholds = LIMITS, ranges: int = P.RANGES, hold: Hold = as_it_is) -> DataFrame:
    """Scale and offset evidence: quantile alignment and the shape distance of the standardised values."""
    names = ["q10", "q25", "q50", "q75", "q90"]
    q = cumulated.groupBy("feature").agg(
        F.expr(f"max(t_{recent}) AS n_r"), F.expr("max(t_n_current) AS n_c"),
        F.expr(f"count_if({recent} > 0) AS d_r"), F.expr("count_if(n_current > 0) AS d_c"),
        *[quantile(recent, p).alias(f"r_{n}") for n, p in zip(names, PROBABILITIES, strict=True)],
        *[quantile("n_current", p).alias(f"c_{n}") for n, p in zip(names, PROBABILITIES, strict=True)],
    )
    q = hold(q.selectExpr("*", "r_q75 - r_q25 AS s_r", "c_q75 - c_q25 AS s_c"))
    enough = f"least(n_r, n_c) >= {limits.observations} AND least(d_r, d_c) >= {limits.distinct} AND least(s_r, s_c) > {limits.spread_least!r}D"
    fit = q.where(enough)
    std = cumulated.select("feature", "value", recent, "n_current").join(F.broadcast(fit.select("feature", "r_q50", "c_q50", "s_r", "s_c")), "feature")
    z = f"explode(array(struct((value - r_q50) / s_r AS value, {recent} AS a, 0L AS b), struct((value - c_q50) / s_c AS value, 0L AS a, n_current AS b))) AS z"
    counts = std.selectExpr("feature", z).select("feature", "z.*").where("a + b > 0").groupBy("feature", "value").agg(F.expr("sum(a) AS a"), F.expr("sum(b) AS b"))
    shape = P.adjacent_gaps(counts, ["a", "b"], ranges).select("feature", F.col("gaps")[0].alias("shape_ks"))
    ratio, offset = "(s_c / s_r)", "(c_q50 - r_q50)"
    worst = lambda by: f"greatest({', '.join(f'abs(c_{n} {by} - r_{n})' for n in names)}) / s_r"
    out = fit.join(shape, "feature").selectExpr(
        "feature", "shape_ks", f"{ratio} AS spread_ratio", f"{worst(f'/ {ratio}')} AS scale_alignment_error", f"{offset} AS offset_value",
        f"{worst(f'- {offset}')} AS offset_alignment_error", f"abs({offset}) / s_r AS offset_spread_multiples",
    )
    alike, factor, error = f"shape_ks <= {limits.shape_ks!r}D", limits.scale_factor, limits.alignment_error
    scale = f"{alike} AND (spread_ratio >= {factor!r}D OR spread_ratio <= {1 / factor!r}D) AND scale_alignment_error <= {error!r}D"
    within = f"spread_ratio BETWEEN {limits.offset_ratio_low!r}D AND {limits.offset_ratio_high!r}D AND offset_spread_multiples >= {limits.offset_spreads!r}D"
    out = out.selectExpr("*", f"{scale} AS scale_repair_safe", f"{alike} AND {within} AND offset_alignment_error <= {error!r}D AS offset_repair_safe")
    return q.select("feature").join(out, "feature", "left").selectExpr(
        "feature",
        "shape_ks IS NOT NULL AS enough_observations",
        "coalesce(shape_ks, 1D) AS shape_ks",
        "coalesce(spread_ratio, 0D) AS spread_ratio",
        "scale_alignment_error",
        "offset_alignment_error",
        "coalesce(offset_spread_multiples, 0D) AS offset_spread_multiples",
        "coalesce(scale_repair_safe, false) AS scale_repair_safe",
        "coalesce(offset_repair_safe, false) AS offset_repair_safe",
        "CASE WHEN scale_repair_safe THEN spread_ratio END AS scale_factor",
        "CASE WHEN offset_repair_safe THEN offset_value END AS `offset`",
    )


def ranked_levels(levels: DataFrame, counter: str) -> DataFrame:
    """(feature, level, share, rank): levels of a counter by share, most frequent first, ties by level; missing is none."""
    some = levels.where((F.col("level") != MISSING) & (F.col(counter) > 0))
    share = F.col(counter) / F.sum(counter).over(Window.partitionBy("feature"))
    return some.select("feature", "level", share.alias("share")).withColumn("rank", F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("share"), "level")))


def remap(levels: DataFrame, recent: str, limits: Thresholds = LIMITS) -> DataFrame:
    """Relabelling evidence and the mapping by frequency rank, current level -> reference level.

    Features with more levels than a mapping may have are left out before levels are ranked, so rank windows are small.
    """
    named = levels.where(F.col("level") != MISSING)
    base = named.groupBy("feature").agg(
        F.sum(recent).alias("n_r"), F.sum("n_current").alias("n_c"), F.count_if(F.col(recent) > 0).alias("d_r"), F.count_if(F.col("n_current") > 0).alias("d_c"),
        F.coalesce(F.try_divide(F.sum(F.when(F.col(recent) > 0, F.col("n_current")).otherwise(0)), F.sum("n_current")), F.lit(0.0)).alias("remap_support"),
    )
    fits = (F.least("n_r", "n_c") >= limits.observations) & F.col("d_r").between(2, limits.remap_levels) & (F.col("d_r") == F.col("d_c")) & (F.col("remap_support") <= limits.remap_support)
    base = base.withColumn("compatible_cardinality", fits)
    some = named.join(F.broadcast(base.where("compatible_cardinality").select("feature")), "feature")
    order = Window.partitionBy("feature").orderBy("rank")
    pairs = ranked_levels(some, recent).select("feature", "rank", F.col("level").alias("reference"), F.col("share").alias("p")).join(
        ranked_levels(some, "n_current").select("feature", "rank", F.col("level").alias("observed"), F.col("share").alias("q")), ["feature", "rank"]
    )
    gaps = pairs.withColumn("gap", F.least(F.lag("p").over(order) - F.col("p"), F.lag("q").over(order) - F.col("q"), F.lit(1.0)))
    found = gaps.groupBy("feature").agg(
        (0.5 * F.sum(F.abs(F.col("p") - F.col("q")))).alias("tv"), F.min("gap").alias("gap"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("observed", "reference")))).alias("mapping")
    )
    safe = F.coalesce((F.col("tv") <= limits.remap_tv) & (F.col("gap") >= limits.remap_gap), F.lit(False))
    sure = F.least(F.lit(1.0), F.col("gap") / (2 * limits.remap_gap)) * F.greatest(F.lit(0.0), 1 - F.col("tv") / limits.remap_tv)
    return base.join(found, "feature", "left").select(
        "feature",
        "remap_support",
        "compatible_cardinality",
        F.coalesce("tv", F.lit(1.0)).alias("frequency_structure_tv"),
        F.coalesce("gap", F.lit(0.0)).alias("minimum_frequency_gap"),
        safe.alias("category_remap_safe"),
        F.when(safe, sure).otherwise(F.lit(0.0)).alias("mapping_confidence"),
        F.when(safe, F.col("mapping")).alias("category_mapping"),
    )


def missing_shift(counts: DataFrame, blocks: P.Blocks) -> DataFrame:
    """(feature, missing_shift, historical_missing_shift, missing_novelty_ratio)."""
    rates = P.missing_rates(counts, counters_of(blocks))
    jump = lambda a, b: f"abs(m_{a} - m_{b})"
    past = _greatest([jump(a, b) for a, b in adjacent(blocks)])
    both = rates.select("feature", F.expr(jump(recent_counter(blocks), "n_current")).alias("missing_shift"), past.alias("historical_missing_shift"))
    return both.withColumn("missing_novelty_ratio", novelty(F.col("missing_shift"), F.col("historical_missing_shift")))


def decide_review(evidence: DataFrame, enough_history: bool, limits: Thresholds = LIMITS) -> DataFrame:
    """unusual_movement and the review action; missingness has priority."""
    enough, new = str(bool(enough_history)).lower(), f"missing_novelty_ratio >= {limits.novelty!r}D"
    by_missing = f"missing_shift >= greatest({limits.main_missing_least!r}D, {limits.main_missing_share!r}D * current_shift) AND {new}"
    unusual = f"({enough} AND current_shift >= {limits.current_shift!r}D AND novelty_ratio >= {limits.novelty!r}D AND NOT ({by_missing}))"
    signal = f"predictive_strength >= {limits.predictive!r}D"
    lost = f"{enough} AND missing_shift >= {limits.missing_shift!r}D AND {new} AND {signal}"
    action = f"CASE WHEN {lost} THEN '{REVIEW_MISSINGNESS}' WHEN {unusual} AND {signal} THEN '{REVIEW_NOVEL}' ELSE '{KEEP}' END"
    return evidence.withColumns({"unusual_movement": F.expr(unusual), "action": F.expr(action)})


def add_systemic(evidence: DataFrame, limits: Thresholds = LIMITS) -> DataFrame:
    """Share of varying features that moved unusually, on every row; one row is aggregated and broadcast."""
    share = F.coalesce(F.avg(F.when(F.col("unique_values") > 1, F.col("unusual_movement").cast("double"))), F.lit(0.0))
    return evidence.crossJoin(F.broadcast(evidence.agg(share.alias("systemic_drift_fraction")))).withColumn("systemic_drift_active", F.col("systemic_drift_fraction") >= limits.systemic_fraction)


CHECKS_NUMERIC = ("enough_observations", "shape_ks", "spread_ratio", "scale_alignment_error", "offset_alignment_error", "offset_spread_multiples", "scale_repair_safe", "offset_repair_safe")
CHECKS_TEXT = ("compatible_cardinality", "frequency_structure_tv", "minimum_frequency_gap", "category_remap_safe", "mapping_confidence")
EVIDENCE = (
    "feature", "kind", "current_shift", "historical_max_shift", "novelty_ratio", "predictive_strength", "unique_values", "recent_unique_values", "test_unique_values",
    "support_retention_ratio", "missing_shift", "historical_missing_shift", "missing_novelty_ratio", "known_category_support_ratio", "unusual_movement",
    "scale_factor", "offset", "category_mapping", "evidence_checks", "action",
)


def _joined(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, "feature", "left"), parts)


def frozen(evidence: DataFrame) -> DataFrame:
    """The same rows as a local table: one row for each feature, so that nothing is computed twice."""
    rows = evidence.limit(MOST_FEATURES + 1).collect()
    if len(rows) > MOST_FEATURES:
        raise ValueError(f"more than {MOST_FEATURES} features")
    return evidence.sparkSession.createDataFrame(rows, evidence.schema)


def base_evidence(train: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str], blocks: P.Blocks, target: str, limits: Thresholds = LIMITS, period: str = "period_idx") -> DataFrame:
    """One row for each feature: all evidence but orientation and systemic context.

    The value counts are cached (memory, then disk) while the evidence is worked out from them, and freed after.
    """
    with holding() as hold:
        return frozen(_base_evidence(train, current, numeric, categorical, blocks, target, limits, period, hold))


def _base_evidence(train: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str], blocks: P.Blocks, target: str, limits: Thresholds, period: str, hold: Hold) -> DataFrame:
    recent, parts = recent_counter(blocks), []
    empty_text = {c: F.expr(f"CAST(NULL AS {'boolean' if c in ('compatible_cardinality', 'category_remap_safe') else 'double'})") for c in CHECKS_TEXT}
    empty_number = {c: F.expr(f"CAST(NULL AS {'boolean' if c.endswith('safe') or c == 'enough_observations' else 'double'})") for c in CHECKS_NUMERIC}

    if numeric:
        counts = hold(P.counted(train, current, numeric, True, blocks, target, period))
        cum = hold(P.cumulative(counts.select("feature", "value", recent, "n_current", "n_train", "pos"), [recent, "n_current", "n_train"]))
        one = _joined([P.support(counts, recent), missing_shift(counts, blocks), numeric_shift(counts, blocks), rank_correlation_with_target(cum), representation(cum, recent, limits, hold=hold)])
        parts.append(
            one.withColumns({"kind": F.lit("numeric"), "known_category_support_ratio": F.lit(1.0), "category_mapping": F.lit(None).cast("map<string,string>"), **empty_text})
        )
    if categorical:
        counts = hold(P.counted(train, current, categorical, False, blocks, target, period))
        levels = hold(P.with_canonical(counts))
        one = _joined([P.support(counts, recent), missing_shift(counts, blocks), categorical_shift(levels, blocks), level_rate_spread(levels, limits), known_support(levels, recent), remap(levels, recent, limits)])
        parts.append(one.withColumns({"kind": F.lit("categorical"), "scale_factor": F.lit(None).cast("double"), "offset": F.lit(None).cast("double"), **empty_number}))
    checks = f"struct({', '.join((*CHECKS_NUMERIC, *CHECKS_TEXT))}) AS evidence_checks"
    flat = []
    for p in parts:
        for c in ("current_shift", "historical_max_shift", "predictive_strength"):
            p = p.withColumn(c, finite_or_zero(F.col(c)))
        p = p.withColumn("novelty_ratio", novelty(F.col("current_shift"), F.col("historical_max_shift")))
        flat.append(decide_review(p, blocks.enough, limits).selectExpr(*[checks if c == "evidence_checks" else f"`{c}`" for c in EVIDENCE]))
    if not flat:
        raise ValueError("there is no shared feature")
    return flat[0] if len(flat) == 1 else flat[0].unionByName(flat[1])


def average_ranks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(feature, value, rank, of): average ranks of the non-null values; feature is the struct of the keys, null keys included."""
    name = F.struct(*keys) if keys else F.lit("all")
    counts = df.where(F.col(value).isNotNull()).groupBy(name.alias("feature"), F.col(value).alias("value")).agg(F.count("*").alias("n"))
    rank = F.col("c_n") - (F.col("n") - 1) / 2
    return P.cumulative(counts, ["n"]).select("feature", F.col("value").alias(value), rank.alias("rank"), F.col("t_n").alias("of"))


def spearman(df: DataFrame, left: str, right: str, keys: list[str]) -> DataFrame:
    """(keys, spearman) over pairs with both values finite; 0 for fewer than three pairs or a constant side.  Null keys are keys."""
    fine = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    pairs = df.where(fine(left) & fine(right)).select(*keys, (F.struct(*keys) if keys else F.lit("all")).alias("feature_"), left, right)
    a = average_ranks(pairs, keys, left).select(F.col("feature").alias("feature_"), left, F.col("rank").alias("__a"))
    b = average_ranks(pairs, keys, right).select(F.col("feature").alias("feature_"), right, F.col("rank").alias("__b"))
    ranked = pairs.join(a, ["feature_", left]).join(b, ["feature_", right])
    out = ranked.groupBy(*keys).agg(
        F.count("*").alias("n"), F.max(left).alias("l1"), F.min(left).alias("l0"), F.max(right).alias("r1"), F.min(right).alias("r0"),
        F.covar_pop("__a", "__b").alias("cov"), F.stddev_pop("__a").alias("sa"), F.stddev_pop("__b").alias("sb"),
    )
    good = (F.col("n") >= 3) & (F.col("l1") - F.col("l0") > 1e-12) & (F.col("r1") - F.col("r0") > 1e-12)
    return out.select(*keys, F.when(good, F.try_divide(F.col("cov"), F.col("sa") * F.col("sb"))).otherwise(F.lit(0.0)).alias("spearman"))
