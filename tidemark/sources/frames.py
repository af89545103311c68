"""Training and current frames in the contract's shape, from the star-schema and event tables.

All rows take part: training rows are those before 2001-01, current rows the rest; periods are month numbers.  A side's filter is
on a scanned column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import period_of

SPLIT = "2001-01-01"
ORDER_NUMBERS, ORDER_TEXTS = ["o_totalprice", "c_acctbal"], ["o_orderpriority", "c_mktsegment", "n_name"]
LINE_NUMBERS, LINE_TEXTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], ["l_linestatus"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_target() -> Column:
    """1 for orders that are large, with noise from the key: related to the price, but not a function of it."""
    return (F.col("o_totalprice") + 200.0 * F.pmod(F.col("o_orderkey") * 7919, F.lit(1000)) > 300000).cast("int")


def orders_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, period_idx, now, target, features: both sides in one frame."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    now = F.col("o_orderdate") >= SPLIT
    return joined.select(F.col("o_orderkey").alias("id"), period_of(F.col("o_orderdate")).alias("period_idx"), now.alias("now"), order_target().alias("target"), *ORDER_NUMBERS, *ORDER_TEXTS)


def lines_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem")
    now = F.col("l_shipdate") >= SPLIT
    return x.select(
        F.col("l_orderkey").alias("id"), period_of(F.col("l_shipdate")).alias("period_idx"), now.alias("now"), (F.col("l_returnflag") == "R").cast("int").alias("target"), *LINE_NUMBERS, *LINE_TEXTS
    )


def sides(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(training, current); the current side has no target."""
    return frame.where("NOT now").drop("now"), frame.where("now").drop("now", "target")
