"""Profiles: every value of every feature with its counts by history block.

One aggregation by (feature, value) feeds shift, support, missingness, quantiles and rank correlation; no operator
looks at the rows again.  Cumulative counts use windows over (feature, range of values); the totals of ranges are summed
before, so no window holds a whole feature (see ``in_ranges``).

Wide lists of counters are SQL text: each Column operation costs calls to the JVM, a text costs one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import canonical_category, number

#: Value ranges of an octave for cumulative counts, and periods that a driver-side block list may have.
RANGES, MOST_PERIODS = 64, 4096


@dataclass(frozen=True)
class Blocks:
    """History blocks: periods in order, in groups of ``width``.  One entry for each period of the training table."""

    periods: tuple[int, ...]
    width: int

    @property
    def count(self) -> int:
        return -(-len(self.periods) // self.width)

    @property
    def enough(self) -> bool:
        """At least eight periods and four blocks."""
        return len(self.periods) >= 8 and self.count >= 4

    def members(self, block: int) -> tuple[int, ...]:
        return self.periods[block * self.width : (block + 1) * self.width]

    def of(self, period: Column) -> Column:
        """Number of the block; null for a period outside."""
        pairs = ", ".join(f"{p}, {i // self.width}" for i, p in enumerate(self.periods))
        return F.try_element_at(F.expr(f"map({pairs})"), period)

    def recent_periods(self) -> tuple[int, ...]:
        """The last two periods, or the last one of fewer than four."""
        return self.periods[-2:] if len(self.periods) >= 4 else self.periods[-1:]


def period_blocks(train: DataFrame, period: str = "period_idx") -> DataFrame:
    """(period_idx, position, block_idx): two periods a block from four periods on, else one."""
    seen = train.where(F.col(period).isNotNull()).select(F.col(period).alias("period_idx")).distinct()
    at = F.dense_rank().over(Window.orderBy("period_idx")) - 1
    n = F.count("*").over(Window.partitionBy())
    return seen.select("period_idx", at.alias("position"), F.floor(at / F.when(n >= 4, F.lit(2)).otherwise(F.lit(1))).cast("int").alias("block_idx"))


def history_blocks(train: DataFrame, period: str = "period_idx") -> Blocks:
    rows = train.where(F.col(period).isNotNull()).select(F.col(period).cast("int").alias("p")).distinct().limit(MOST_PERIODS + 1).collect()
    if not rows:
        raise ValueError("the training table has no period")
    if len(rows) > MOST_PERIODS:
        raise ValueError(f"more than {MOST_PERIODS} periods")
    periods = tuple(sorted(r.p for r in rows))
    return Blocks(periods, 2 if len(periods) >= 4 else 1)


def long_form(df: DataFrame, keep: list[str], features: list[str], numeric: bool) -> DataFrame:
    """(keep..., feature, value): one row for each row and feature, in one pass; value is double, or text as it is."""
    value = (lambda c: number(F.col(f"`{c}`"), df.schema[c].dataType)) if numeric else (lambda c: F.col(f"`{c}`").cast("string"))
    if not features:
        return df.select(*keep, F.lit("").alias("feature"), F.lit(None).cast("double" if numeric else "string").alias("value")).where(F.lit(False))
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), value(f).alias("value")) for f in features])
    return df.select(*keep, F.explode(pairs).alias("p")).select(*keep, "p.feature", "p.value")


def counted(train: DataFrame, current: DataFrame, features: list[str], numeric: bool, blocks: Blocks, target: str | None = None, period: str = "period_idx") -> DataFrame:
    """(feature, value, n_train, n_current, pos, b0, b1, ...): how often each value, null too, stands where.

    pos: training rows with target 1.  The partial aggregation folds repeated values before the only shuffle.
    """
    label = F.col(target).cast("long") if target else F.lit(None).cast("long")
    a = long_form(train.select("*", blocks.of(F.col(period).cast("int")).alias("__block"), label.alias("__pos"), F.lit(False).alias("__now")), ["__now", "__block", "__pos"], features, numeric)
    b = long_form(current.select("*", F.lit(None).cast("int").alias("__block"), F.lit(None).cast("long").alias("__pos"), F.lit(True).alias("__now")), ["__now", "__block", "__pos"], features, numeric)
    return a.unionByName(b).groupBy("feature", "value").agg(
        F.count_if(~F.col("__now")).alias("n_train"),
        F.count_if("__now").alias("n_current"),
        F.coalesce(F.sum("__pos"), F.lit(0)).alias("pos"),
        *[F.expr(f"count_if(__block = {i}) AS b{i}") for i in range(blocks.count)],
    )


def with_canonical(counts: DataFrame) -> DataFrame:
    """Counts by canonical level, (feature, level, ...), with how many raw values stand behind it in each counter."""
    own = [c for c in counts.columns if c not in ("feature", "value")]
    return counts.withColumn("level", canonical_category(F.col("value"))).groupBy("feature", "level").agg(*[F.expr(f"sum({c}) AS {c}") for c in own])


FINITE = "CASE WHEN abs(value) < double('infinity') THEN value END"


def _range_of(ranges: int) -> str:
    """SQL: the range of a value by its place u between low and high (halves of the ends); so many ranges in each octave of u."""
    u = "least(1D, greatest(0D, coalesce(try_divide(value / 2 - low, high - low), 0D)))"
    return f"CASE WHEN {u} <= 0 THEN 0 ELSE {ranges} * (51 + greatest(floor(log2({u})), -50)) + floor({ranges} * ({u} / pow(2D, greatest(floor(log2({u})), -50)) - 1)) END"


def in_ranges(counts: DataFrame, counters: list[str], ranges: int = RANGES, few: bool = False) -> DataFrame:
    """Non-null values with the number of the value range that each is in, and the feature's totals t_<counter>.

    A value's place between the feature's least and greatest finite value, a number of [0, 1], has so many ranges in each
    octave.  Least, greatest and totals are exact whatever the order of rows, so a repeated task finds the same ranges.  They
    are a row for each feature; names of features are as many as a table has columns, so that rows by name are broadcast.
    few: so are rows by other keys, which the caller knows to be few; else the join deals the values of a key to one task.
    """
    some = counts.where("value IS NOT NULL")
    ends = some.groupBy("feature").agg(F.expr(f"min({FINITE}) / 2 AS low"), F.expr(f"max({FINITE}) / 2 AS high"), *[F.expr(f"sum({c}) AS t_{c}") for c in counters])
    named = isinstance(counts.schema["feature"].dataType, T.StringType)
    return some.join(F.broadcast(ends) if named or few else ends, "feature").withColumn("range", F.expr(_range_of(ranges))).drop("low", "high")


def cumulative(counts: DataFrame, counters: list[str], ranges: int = RANGES, few: bool = False) -> DataFrame:
    """Adds c_<counter> (up to and with the value) and t_<counter> (total) for non-null values, by feature.

    ``feature`` can be a struct: nulls in it are values like any other.
    """
    ranged = in_ranges(counts, counters, ranges, few)
    by_range = ranged.groupBy("feature", "range").agg(*[F.expr(f"sum({c}) AS s_{c}") for c in counters])
    before = "PARTITION BY feature ORDER BY `range` ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    offsets = by_range.selectExpr("feature", "`range`", *[f"coalesce(sum(s_{c}) OVER ({before}), 0) AS o_{c}" for c in counters])
    joined = ranged.join(offsets, ["feature", "range"])
    own = [c for c in counts.columns if c != "feature"]
    return joined.selectExpr("feature", *[f"`{c}`" for c in own], *[f"t_{c}" for c in counters], *[f"o_{c} + sum({c}) OVER (PARTITION BY feature, `range` ORDER BY value) AS c_{c}" for c in counters])


def adjacent_gaps(counts: DataFrame, counters: list[str], ranges: int = RANGES) -> DataFrame:
    """(feature, gaps): for each counter but the last the Kolmogorov-Smirnov statistic of it and the next one; 0 if one is empty.

    Long, not wide: each value of a counter stands in the pairs with both neighbours, with its share as weight, positive in
    one and negative in the other; the statistic is the largest absolute sum of weights up to a value.
    """
    sides = ", ".join(f"struct({i} AS side, {c} AS n)" for i, c in enumerate(counters))
    long = counts.where("value IS NOT NULL").selectExpr("feature", "value", f"explode(filter(array({sides}), s -> s.n > 0)) AS s").select("feature", "value", "s.side", "s.n")
    each = long.groupBy("feature", "side").agg(F.sum("n").alias("t"), F.expr(f"min({FINITE}) / 2 AS low"), F.expr(f"max({FINITE}) / 2 AS high"))
    whole = "OVER (PARTITION BY feature)"
    totals = each.selectExpr("feature", "side", "t", f"min(low) {whole} AS low", f"max(high) {whole} AS high")
    placed = long.join(F.broadcast(totals), ["feature", "side"]).selectExpr("feature", "side", "value", "n / t AS share", f"{_range_of(ranges)} AS `range`")
    both = placed.selectExpr("feature", "`range`", "value", "explode(array(struct(side AS pair, share AS w), struct(side - 1 AS pair, -share AS w))) AS p").select("feature", "range", "value", "p.*")
    both = both.where((F.col("pair") >= 0) & (F.col("pair") < len(counters) - 1))
    by_range = both.groupBy("feature", "pair", "range").agg(F.sum("w").alias("s"))
    offsets = by_range.selectExpr("feature", "pair", "`range`", "coalesce(sum(s) OVER (PARTITION BY feature, pair ORDER BY `range` ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0D) AS o")
    summed = both.join(offsets, ["feature", "pair", "range"]).selectExpr("feature", "pair", "w", "abs(o + sum(w) OVER (PARTITION BY feature, pair, `range` ORDER BY value)) AS gap")
    most = summed.groupBy("feature", "pair").agg(F.expr("CASE WHEN min(w) < 0 AND max(w) > 0 THEN max(gap) ELSE 0D END AS gap"))
    most = most.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("pair", "gap"))).alias("m"))
    gaps = F.transform(F.sequence(F.lit(0), F.lit(len(counters) - 2)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)))
    return counts.select("feature").distinct().join(most, "feature", "left").select("feature", gaps.alias("gaps"))


def missing_rates(counts: DataFrame, counters: list[str]) -> DataFrame:
    """(feature, m_<counter>): share of nulls."""
    return counts.groupBy("feature").agg(*[F.expr(f"coalesce(try_divide(sum(CASE WHEN value IS NULL THEN {c} ELSE 0 END), sum({c})), 0D) AS m_{c}") for c in counters])


def support(counts: DataFrame, recent: str) -> DataFrame:
    """Distinct raw values (null is none): in training, recent and current rows, and how much of the support is left."""
    there = {"unique_values": "n_train", "recent_unique_values": recent, "test_unique_values": "n_current"}
    out = counts.groupBy("feature").agg(
        *[F.expr(f"count_if(value IS NOT NULL AND {c} > 0) AS {name}") for name, c in there.items()],
        F.expr("coalesce(sum(CASE WHEN value IS NOT NULL THEN n_current END), 0) AS current_non_missing"),
    )
    return out.withColumn("support_retention_ratio", F.expr("least(1D, test_unique_values / greatest(1, least(recent_unique_values, current_non_missing)))"))
