"""Evaluation: average precision, the prediction contract, duplicate ids, score checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import lenient_label
from . import profile as P


def average_precision(df: DataFrame, score: str, label: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, average_precision): sum of recall steps times precision over the different scores, highest first.

    Scores are counted first; cumulative sums go over ranges of scores, so equal scores are one step and no window holds
    all rows.  Without a positive row the result is 0.  Null keys are keys.
    """
    name = F.struct(*keys) if keys else F.lit("all")
    counts = df.where(F.col(score).isNotNull()).groupBy(name.alias("feature"), (-F.col(score)).alias("value")).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("p"))
    cum = P.cumulative(counts, ["n", "p"])
    step = F.try_divide(F.col("p"), F.col("t_p")) * F.col("c_p") / F.col("c_n")
    out = cum.groupBy(*(["feature"] if keys else [])).agg(F.coalesce(F.sum(step), F.lit(0.0)).alias("average_precision"))
    return out.select(*[F.col("feature")[k].alias(k) for k in keys], "average_precision")


def score_violations(predictions: DataFrame, score: str = "probability_score") -> DataFrame:
    """One row: rows, and how many scores are null, not finite, or outside [0, 1]."""
    s = F.col(score)
    bad = s.isNull() | F.isnan(s) | ~s.between(0.0, 1.0)
    return predictions.agg(F.count("*").alias("row_count"), F.count_if(bad).alias("bad_scores"))


def duplicate_ids(df: DataFrame, id_col: str) -> DataFrame:
    return df.groupBy(id_col).agg(F.count("*").alias("copies")).where("copies > 1")


def prediction_contract(predictions: DataFrame, labelled: DataFrame, id_col: str, target: str, score: str = "probability_score", ordinal: str = "row_ordinal") -> DataFrame:
    """One row: row counts, places whose ids differ, duplicate and null ids, bad scores, bad labels."""
    a = predictions.select(F.col(ordinal).alias("o"), F.col(id_col).alias("a"), F.col(score).alias("s"))
    b = labelled.select(F.col(ordinal).alias("o"), F.col(id_col).alias("b"), lenient_label(F.col(target)).alias("y"))
    both = a.withColumn("in_a", F.lit(1)).join(b.withColumn("in_b", F.lit(1)), "o", "full")
    one = both.agg(
        F.count("in_a").alias("prediction_rows"), F.count("in_b").alias("labelled_rows"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("id_mismatches"),
        F.count_if(F.col("in_a").isNotNull() & F.col("a").isNull()).alias("null_ids"),
        F.count_if(F.col("in_a").isNotNull() & (F.col("s").isNull() | F.isnan("s") | ~F.col("s").between(0.0, 1.0))).alias("bad_scores"),
        F.count_if(F.col("in_b").isNotNull() & F.col("y").isNull()).alias("bad_labels"),
    )
    twice = duplicate_ids(predictions, id_col).agg(F.count("*").alias("duplicate_ids"))
    return one.crossJoin(F.broadcast(twice))


def evaluate(predictions: DataFrame, labelled: DataFrame, id_col: str, target: str, score: str = "probability_score", ordinal: str = "row_ordinal") -> float:
    """Average precision of a prediction table that keeps its contract; an error names what it breaks."""
    row = prediction_contract(predictions, labelled, id_col, target, score, ordinal).first()
    if row.prediction_rows != row.labelled_rows:
        raise ValueError(f"row counts differ: {row.prediction_rows} and {row.labelled_rows}")
    for name in ("id_mismatches", "null_ids", "duplicate_ids", "bad_scores", "bad_labels"):
        if row[name]:
            raise ValueError(f"{row[name]} {name.replace('_', ' ')}")
    joined = predictions.select(ordinal, score).join(labelled.select(ordinal, lenient_label(F.col(target)).alias("__y")), ordinal)
    return average_precision(joined, score, "__y").first()[0]


def rows_by_batch(df: DataFrame) -> DataFrame:
    """Rows of each partition: a metric of a running layout."""
    return df.groupBy(F.spark_partition_id().alias("batch")).agg(F.count("*").alias("rows"))
