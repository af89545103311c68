"""The preparation plan: evidence, actions and frozen parameters; and its application as a narrow projection.

All fitted state is in the plan, so transformed rows do not depend on how rows are partitioned or batched.  Small
parameters (codes, fills, factors, remaps) are literals; percentile maps are kept as a table of one row for each feature
and period, and joined in blocks of knots (see ``ranks.MapBlocks``), which are broadcast up to a number of knots.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.columns import POOLED, canonical_category, interpolate, lookup, number, place, yes_no
from ..operators import orientation, policy, profile, ranks
from ..operators.drift import LIMITS
from ..operators.sampling import with_ordinal
from ..sources.contract import ColumnContract, bad_periods, by_kind, require_columns, require_rows, shared_features, with_period, without_target

#: Levels that a literal code map may have, and knots (over all features and periods) that may be broadcast.
MOST_LEVELS, MOST_BROADCAST_KNOTS = 100_000, 4_000_000


@dataclass
class PreparationPlan:
    contract: ColumnContract
    features: list[str]
    numeric: list[str]
    categorical: list[str]
    dropped: list[str]
    ranked: list[str]
    reversed: list[str]
    codes: dict[str, dict[str, int]]
    fills: dict[str, float]
    scales: dict[str, float]
    offsets: dict[str, float]
    remaps: dict[str, dict[str, str]]
    evidence: list[dict]
    thresholds: dict[str, float]
    maps: dict[str, list[tuple]] = field(default_factory=dict)

    @property
    def actions(self) -> dict[str, str]:
        return {r["feature"]: r["action"] for r in self.evidence}

    def summary(self) -> dict:
        """Without the percentile maps: their number of knots only."""
        out = {k: v for k, v in asdict(self).items() if k != "maps"}
        out["map_knots"] = {side: {f"{f}/{p}": len(k) for f, p, k, _ in rows} for side, rows in self.maps.items()}
        return out

    def to_json(self) -> str:
        return json.dumps(asdict(self), default=str)

    @classmethod
    def from_json(cls, text: str) -> PreparationPlan:
        d = json.loads(text)
        d["contract"] = ColumnContract(**d["contract"])
        d["maps"] = {side: [tuple(r) for r in rows] for side, rows in d["maps"].items()}
        return cls(**d)


def category_codes(train: DataFrame, features: list[str]) -> DataFrame:
    """(feature, level, code): codes count sorted canonical levels from 0; levels of all features are numbered at once, over ranges."""
    levels = profile.long_form(train, [], features, False).select("feature", canonical_category(F.col("value")).alias("level")).distinct()
    numbered = with_ordinal(levels, ["feature", "level"], "__o")
    first = numbered.groupBy("feature").agg(F.min("__o").alias("__first"))
    return numbered.join(F.broadcast(first), "feature").select("feature", "level", (F.col("__o") - F.col("__first")).cast("int").alias("code"))


def fill_values(train: DataFrame, features: list[str]) -> DataFrame:
    """(feature, fill): the exact median of non-null values from cumulative counts; 0 without values."""
    from ..operators.drift import quantile

    long = profile.long_form(train, [], features, True)
    counts = long.groupBy("feature", "value").agg(F.count("*").alias("n"))
    found = profile.cumulative(counts, ["n"]).groupBy("feature").agg(quantile("n", 0.5).alias("fill"))
    return counts.select("feature").distinct().join(found, "feature", "left").select("feature", F.coalesce("fill", F.lit(0.0)).alias("fill"))


def check_target(train: DataFrame, contract: ColumnContract) -> DataFrame:
    """train with the target as 0/1 in ``__target``; texts other than Yes/No are an error."""
    kind = train.schema[contract.target].dataType.typeName()
    y = yes_no(F.col(f"`{contract.target}`")) if kind == "string" else F.col(f"`{contract.target}`").cast("int")
    out = train.withColumn("__target", y)
    wrong = out.where("__target IS NULL OR __target NOT IN (0, 1)").limit(1).collect()
    if wrong:
        raise ValueError("the training target has values other than Yes and No")
    return out


def build_plan(train: DataFrame, current: DataFrame, contract: ColumnContract = ColumnContract(), map_knots: int = ranks.MOST_KNOTS) -> PreparationPlan:
    """Validate, detect, decide, freeze."""
    require_columns(train, contract.all(), "the training table")
    require_columns(current, contract.all()[:2], "the current table")
    require_rows(train, "the training table")
    current = without_target(current, contract)
    require_rows(current, "the current table")
    if bad_periods(train, contract) or bad_periods(current, contract):
        raise ValueError("a period cannot be read")
    train = check_target(with_period(train, contract), contract)
    current = with_period(current, contract)
    features = [f for f in shared_features(train, current, contract) if f not in ("period_idx", "__target")]
    numeric, categorical = by_kind(train, features)
    blocks = profile.history_blocks(train)
    evidence = policy.choose_actions(orientation.detect_drift(train, current, numeric, categorical, blocks, "__target"))
    rows = sorted((r.asDict(recursive=True) for r in evidence.collect()), key=lambda r: features.index(r["feature"]))
    of = lambda action: [r["feature"] for r in rows if r["action"] == action]
    dropped, reverse = of(policy.DROP), of(policy.REVERSE)
    kept = [f for f in features if f not in dropped]
    numeric, categorical = [f for f in numeric if f in kept], [f for f in categorical if f in kept]
    codes: dict[str, dict[str, int]] = {f: {} for f in categorical}
    if categorical:
        table = category_codes(train, categorical).limit(MOST_LEVELS + 1).collect()
        if len(table) > MOST_LEVELS:
            raise ValueError(f"more than {MOST_LEVELS} category levels")
        for r in table:
            codes[r.feature][r.level] = r.code
    plain = [f for f in numeric if f not in reverse]
    fills = {r.feature: r.fill for r in fill_values(train, plain).collect()} if plain else {}
    fills = {f: 0.5 if f in reverse else fills.get(f, 0.0) for f in numeric}
    maps = {}
    if reverse:
        for side, df in (("train", train), ("test", current)):
            table = ranks.rank_maps(df, reverse, "period_idx", map_knots)
            maps[side] = [(r.feature, r.period, r.knots, r.heights) for r in table.collect()]
            if sum(len(r[2]) for r in maps[side]) > MOST_BROADCAST_KNOTS:
                raise ValueError("percentile maps are too large for a plan; lower map_knots")
    by = {r["feature"]: r for r in rows}
    return PreparationPlan(
        contract, kept, numeric, categorical, dropped, reverse, reverse, codes, fills,
        {f: by[f]["scale_factor"] for f in of(policy.SCALE)}, {f: by[f]["offset"] for f in of(policy.OFFSET)},
        {f: by[f]["category_mapping"] for f in of(policy.REMAP)}, rows, {k: float(v) for k, v in asdict(LIMITS).items()}, maps,
    )


def _percentile(plan: PreparationPlan, feature: str, side: str) -> Column:
    """Percentile from the joined maps; reversed on the test side after narrowing."""
    p = F.col(f"`__rank_{feature}`").cast("float")
    if side == "test" and feature in plan.reversed:
        p = (F.lit(1.0).cast("float") - p).cast("float")
    return F.coalesce(p, F.lit(plan.fills[feature]).cast("float"))


def encode_category(plan: PreparationPlan, feature: str, side: str) -> Column:
    level = canonical_category(F.col(f"`{feature}`"))
    if side == "test" and feature in plan.remaps:
        level = lookup(plan.remaps[feature], level, level)
    return lookup(plan.codes[feature], level, F.lit(-1)).cast("int")


def prepare_number(plan: PreparationPlan, feature: str, side: str, kind: DataType | None = None) -> Column:
    x = number(F.col(f"`{feature}`"), kind)
    if side == "test" and feature in plan.scales:
        x = x / F.lit(plan.scales[feature])
    elif side == "test" and feature in plan.offsets:
        x = x - F.lit(plan.offsets[feature])
    return F.coalesce(x, F.lit(plan.fills[feature])).cast("float")


def _with_ranks(df: DataFrame, plan: PreparationPlan, side: str, maps: ranks.MapBlocks | None = None) -> DataFrame:
    """A column ``__rank_<feature>`` for each ranked feature: the value in the map of the row's period, or in the pooled one.

    Two joins a feature: the first knots of the map give the block of the value, the block gives the percentile.
    """
    if not plan.ranked:
        return df
    spark = df.sparkSession
    out = with_period(df, plan.contract, "__period")
    maps = maps or ranks.blocks_of(spark, [r for r in plan.maps[side] if r[0] in plan.ranked])
    for f in plan.ranked:
        firsts, blocks = maps.firsts.get(f, {}), maps.table.where(F.col("feature") == f)
        if POOLED not in firsts:
            empty = ranks.blocks_of(spark, [(f, POOLED, *ranks.empty_map())])
            firsts, blocks = firsts | empty.firsts[f], blocks.unionByName(empty.table)
        value, period = number(F.col(f"`{f}`"), df.schema[f].dataType), F.col("__period").cast("string")
        own = [p for p in firsts if p != POOLED]
        keyed = out.withColumn("__p", F.when(period.isin(own), period).otherwise(F.lit(POOLED)))
        starts = spark.createDataFrame(list(firsts.items()), "__p string, __firsts array<double>")
        at = F.when(value.isNotNull(), F.greatest(place(value, F.col("__firsts")) - 1, F.lit(0)))
        found = keyed.join(F.broadcast(starts), "__p", "left").withColumn("__b", at).drop("__firsts")
        blocks = blocks.select(F.col("period").alias("__p"), F.col("block").alias("__b"), F.col("knots").alias("__knots"), F.col("heights").alias("__heights"))
        few = maps.count(f) * ranks.BLOCK <= MOST_BROADCAST_KNOTS
        joined = found.join(F.broadcast(blocks) if few else blocks, ["__p", "__b"], "left")
        out = joined.withColumn(f"__rank_{f}", interpolate(value, F.col("__knots"), F.col("__heights"))).drop("__p", "__b", "__knots", "__heights")
    return out


def transform(df: DataFrame, plan: PreparationPlan, side: str, keep: tuple[str, ...] = (), maps: ranks.MapBlocks | None = None) -> DataFrame:
    """keep columns, then the plan's features in order: int codes and floats.  side: train or test (repairs apply).

    maps: percentile maps that are too large for a plan, in place of the plan's.
    """
    if side not in ("train", "test"):
        raise ValueError("side is train or test")
    cols = []
    for f in plan.features:
        kind = df.schema[f].dataType
        c = encode_category(plan, f, side) if f in plan.categorical else _percentile(plan, f, side) if f in plan.ranked else prepare_number(plan, f, side, kind)
        cols.append(c.alias(f))
    return _with_ranks(df, plan, side, maps).select(*[F.col(f"`{k}`") for k in keep], *cols)


def evidence_frame(spark: SparkSession, plan: PreparationPlan) -> DataFrame:
    """The plan's evidence as rows (JSON text of the nested parts)."""
    rows = [(r["feature"], r["kind"], r["action"], r["reason"], float(r["current_shift"]), float(r["novelty_ratio"])) for r in plan.evidence]
    return spark.createDataFrame(rows, "feature string, kind string, action string, reason string, current_shift double, novelty_ratio double")
