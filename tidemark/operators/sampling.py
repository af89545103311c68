"""Deterministic samples: bottom-k by a hash of the row, nested samples, and so many rows of each stratum.

The hash is md5 text, whose order is the same in any engine.  Bottom-k is ``orderBy().limit()``: each task keeps k rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 21


def priority(columns: list[str], seed: int = SEED) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def bottom_k(df: DataFrame, columns: list[str], k: int, seed: int = SEED) -> DataFrame:
    """The k rows of least priority; ties by the columns."""
    p = "__priority"
    return df.withColumn(p, priority(columns, seed)).orderBy(p, *columns).limit(k).drop(p)


def nested_samples(df: DataFrame, columns: list[str], model_rows: int = 200_000, analysis_rows: int = 75_000, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(model sample, analysis sample within it); the second one has priorities of its own."""
    model = bottom_k(df, columns, model_rows, seed)
    return model, bottom_k(model, columns, analysis_rows, seed + 1)


def per_stratum(df: DataFrame, strata: list[str], columns: list[str], k: int, seed: int = SEED) -> DataFrame:
    """At most k rows of each stratum, by priority.  Rows beyond k are dropped before the shuffle (group limit)."""
    w = Window.partitionBy(*strata).orderBy(priority(columns, seed), *columns)
    return df.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= k).drop("__k")


def with_ordinal(df: DataFrame, order: list[str], name: str = "row_ordinal") -> DataFrame:
    """Dense row numbers from 0 in the given order, without one window over all rows.

    Rows are range-partitioned; a partition's first number is the sum of the sizes before it (one number a partition).
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = parts.groupBy("__part").agg(F.count("*").alias("__n"))
    first = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__first"))
    return parts.join(F.broadcast(first), "__part").withColumn(name, F.col("__first") + F.col("__at")).drop("__part", "__at", "__first")
