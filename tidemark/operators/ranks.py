"""Percentile representation: ranks within a period, and frozen percentile maps with linear interpolation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import POOLED
from . import profile as P
from .profile import long_form
from .sampling import with_ordinal

MOST_KNOTS = 8192

#: Consecutive knots that a row of a map in blocks has, and blocks whose first knots the driver may hold.
BLOCK, MOST_BLOCKS = 512, 4_000_000


def percentile_ranks(long: DataFrame, keys: list[str], value: str = "value", few: bool = False) -> DataFrame:
    """(keys, value, percentile, n, position, different): average rank of each non-null value within keys over the non-null count.

    position counts the different values of the keys from 0, different is how many there are; null keys are keys.

    It comes from counts of different values with cumulative sums over value ranges, so no window holds a whole key.
    few: keys are few enough to broadcast a row for each.
    """
    counts = long.where(F.col(value).isNotNull()).groupBy(F.struct(*keys).alias("feature"), F.col(value).alias("value")).agg(F.count("*").alias("n"), F.lit(1).alias("one"))
    rank = F.col("c_n") - (F.col("n") - 1) / 2
    return P.cumulative(counts, ["n", "one"], few=few).select(
        *[F.col("feature")[k].alias(k) for k in keys], F.col("value").alias(value), (rank / F.col("t_n")).alias("percentile"), "n", (F.col("c_one") - 1).alias("position"), F.col("t_one").alias("different")
    )


def with_percentile(df: DataFrame, period: str, feature: str, name: str) -> DataFrame:
    """df with the percentile of a feature within its period; null stays null."""
    table = percentile_ranks(df.select(F.col(period), F.col(feature).cast("double").alias("__v")), [period], "__v").select(period, "__v", F.col("percentile").alias(name))
    keyed = df.withColumn("__v", F.col(feature).cast("double"))
    return keyed.join(table, keyed[period].eqNullSafe(table[period]) & (keyed["__v"] == table["__v"]), "left").select(*[keyed[c] for c in df.columns], name)


def rank_map_knots(df: DataFrame, features: list[str], period: str = "period_idx", most: int | None = MOST_KNOTS) -> DataFrame:
    """(feature, period, position, value, percentile): knots of the pooled map and of each period's, thinned evenly; all if most is None."""
    long = long_form(df, [period], features, True).where("value IS NOT NULL").withColumn("period", F.col(period).cast("string"))
    both = long.select("feature", F.explode(F.array(F.lit(POOLED), F.col("period"))).alias("period"), "value").where("period IS NOT NULL")
    knots = percentile_ranks(both, ["feature", "period"], few=True)
    if most is not None:
        knots = knots.where((F.col("different") <= most) | is_thinned_position(F.col("position"), F.col("different"), most))
    return knots.select("feature", "period", F.col("position").cast("int").alias("position"), "value", "percentile")


def is_thinned_position(position: Column, count: Column, most: int) -> Column:
    """Is the position one of rint(linspace(0, count - 1, most))?  Only the two numbers of steps next to it can hit it."""
    step = (count - 1).cast("double") / (most - 1)
    near = F.floor(position / step)
    return F.coalesce(F.greatest(*[(F.rint((near + d) * step) == position).cast("int") for d in (-1, 0, 1, 2)]) == 1, F.lit(True))


def rank_maps(df: DataFrame, features: list[str], period: str = "period_idx", most: int = MOST_KNOTS) -> DataFrame:
    """(feature, period, knots, heights): at most ``most`` knots a row.  A feature without values has no row (see ``empty_map``)."""
    one = rank_map_knots(df, features, period, most).groupBy("feature", "period").agg(F.array_sort(F.collect_list(F.struct("value", "percentile"))).alias("k"))
    return one.select("feature", "period", F.col("k.value").alias("knots"), F.col("k.percentile").alias("heights"))


def empty_map() -> tuple[list[float], list[float]]:
    return [0.0], [0.5]


@dataclass(frozen=True)
class MapBlocks:
    """Percentile maps in blocks of consecutive knots, so that a row meets the block of its value and not the whole map.

    firsts has the first knot of each block, by feature and period.  table: (feature, period, block, knots, heights), where the
    first knot of the next block comes last, so that a block interpolates by itself.
    """

    firsts: dict[str, dict[str, list[float]]]
    table: DataFrame

    def count(self, feature: str) -> int:
        return sum(len(x) for x in self.firsts.get(feature, {}).values())


def blocks_of(spark: SparkSession, rows: list[tuple]) -> MapBlocks:
    """Blocks of a plan's maps: (feature, period, knots, heights) rows."""
    firsts: dict[str, dict[str, list[float]]] = {}
    table = []
    for feature, period, knots, heights in rows:
        firsts.setdefault(feature, {})[period] = list(knots[::BLOCK])
        table += [(feature, period, at // BLOCK, knots[at : at + BLOCK + 1], heights[at : at + BLOCK + 1]) for at in range(0, len(knots), BLOCK)]
    return MapBlocks(firsts, spark.createDataFrame(table, "feature string, period string, block int, knots array<double>, heights array<double>"))


def whole_maps(df: DataFrame, features: list[str], period: str = "period_idx") -> MapBlocks:
    """Blocks with every knot.  They stay a table, however many; the driver gets one number in ``BLOCK``."""
    knots = rank_map_knots(df, features, period, None)
    block, starts = F.floor(F.col("position") / BLOCK).cast("int"), F.col("position") % BLOCK == 0
    ends = knots.where(starts).groupBy("feature", "period").agg(F.array_sort(F.collect_list("value")).alias("firsts"))
    firsts: dict[str, dict[str, list[float]]] = {f: {} for f in features}
    held = 0
    for r in ends.toLocalIterator():
        firsts[r.feature][r.period] = r.firsts
        held += len(r.firsts)
        if held > MOST_BLOCKS:
            raise ValueError(f"percentile maps have more than {MOST_BLOCKS} blocks of {BLOCK} knots")
    home = F.when(starts & (F.col("position") > 0), F.array(block - 1, block)).otherwise(F.array(block))
    table = knots.select("feature", "period", F.explode(home).alias("block"), "value", "percentile").groupBy("feature", "period", "block").agg(F.array_sort(F.collect_list(F.struct("value", "percentile"))).alias("k"))
    return MapBlocks(firsts, table.select("feature", "period", "block", F.col("k.value").alias("knots"), F.col("k.percentile").alias("heights")))


def evenly_spaced(df: DataFrame, keys: list[str], value: str, order: list[str], most: int = 4096) -> DataFrame:
    """At most ``most`` non-null values of each key, evenly spaced in the given order: positions floor(i * (n - 1) / (most - 1)).

    Rows are numbered over all keys at once (see ``sampling.with_ordinal``); a key's first number and count are aggregated and
    joined, so no window holds the rows of a key.
    """
    numbered = with_ordinal(df.where(F.col(value).isNotNull()), [*keys, *order], "__o")
    ends = numbered.groupBy(F.struct(*keys).alias("__k")).agg(F.min("__o").alias("__first"), F.count("*").alias("__n"))
    placed = numbered.withColumn("__k", F.struct(*keys)).join(ends, "__k").withColumn("__at", F.col("__o") - F.col("__first"))
    step = (F.col("__n") - 1) / F.lit(most - 1)
    near = F.floor(F.col("__at") / step)
    hit = F.greatest(*[(F.floor((near + d) * step) == F.col("__at")).cast("int") for d in (-1, 0, 1, 2)]) == 1
    return placed.where((F.col("__n") <= most) | hit).drop("__k", "__o", "__first", "__at", "__n")
