"""One gradient-boosted classifier, fitted once, and batch scoring.

The booster is Spark ML's; its scores are its own.  The fit sees rows in a fixed layout (range-partitioned and sorted by
id), so that repeated fits agree.  Unseen category codes (-1) become one more level.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .preparation import PreparationPlan, transform


class OnceFitted:
    """Holds the model and how often it was fitted; a second fit is an error."""

    def __init__(self, plan: PreparationPlan, trees: int = 20, depth: int = 4, seed: int = 42, partitions: int = 8):
        self.plan, self.trees, self.depth, self.seed, self.partitions = plan, trees, depth, seed, partitions
        self.fits = 0
        self.model: GBTClassificationModel | None = None

    def _matrix(self, prepared: DataFrame) -> DataFrame:
        cols = [F.when(F.col(f"`{f}`") < 0, F.lit(len(self.plan.codes[f]))).otherwise(F.col(f"`{f}`")).alias(f) if f in self.plan.codes else F.col(f"`{f}`") for f in self.plan.features]
        rest = [c for c in prepared.columns if c not in self.plan.features]
        ready = prepared.select(*[F.col(f"`{c}`") for c in rest], *cols)
        return VectorAssembler(inputCols=self.plan.features, outputCol="__x", handleInvalid="keep").transform(ready)

    def fit(self, train: DataFrame, target: str = "__target") -> OnceFitted:
        """train: rows with the contract's columns and a 0/1 target."""
        if self.fits:
            raise RuntimeError("the model is fitted already")
        self.fits += 1
        id_col = self.plan.contract.id
        prepared = self._matrix(transform(train, self.plan, "train", (id_col, target)))
        share = prepared.agg(F.avg(target)).first()[0] or 0.0
        weight = F.when(F.col(target) == 1, F.lit((1 - share) / share if 0 < share < 1 else 1.0)).otherwise(F.lit(1.0))
        laid = prepared.select(id_col, "__x", F.col(target).cast("double").alias("__y"), weight.alias("__w"))
        laid = laid.repartitionByRange(self.partitions, id_col).sortWithinPartitions(id_col, "__y")
        booster = GBTClassifier(featuresCol="__x", labelCol="__y", weightCol="__w", maxIter=self.trees, maxDepth=self.depth, seed=self.seed, maxBins=64)
        self.model = booster.fit(laid)
        return self

    def score(self, rows: DataFrame, side: str = "test", keep: tuple[str, ...] = ()) -> DataFrame:
        """(id, keep..., probability_score): the probability of 1 as a float."""
        if self.model is None:
            raise RuntimeError("the model is not fitted")
        id_col = self.plan.contract.id
        x = self._matrix(transform(rows, self.plan, side, (id_col, *keep)))
        p = vector_to_array(F.col("probability")).getItem(1).cast("float")
        return self.model.transform(x).select(id_col, *keep, p.alias("probability_score"))
