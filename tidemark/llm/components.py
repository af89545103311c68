"""Connected components of a link table, by alternating large and small stars.

Each round is two aggregations with partial sums and two joins; the links are checkpointed in the shared folder after
every round.  Nothing is collected but two numbers a round.  Links must be (u, v) of longs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, tidy


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above u links to the least of u and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and every neighbour below it link to the least of those."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("m").alias("u"), "v")
    return moved.union(least.select(F.col("m").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct()


#: Links of a partition, about; small tables in many partitions would leave many small files on disk.
LINKS = 100_000


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node of the component; nodes without a link have no row."""

    def sign(df):
        with tidy(df.sparkSession):
            return df.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()

    edges = materialize(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct())
    before = sign(edges)
    while before[0]:
        edges = materialize(_small_star(_large_star(edges.coalesce(1 + before[0] // LINKS))))
        after = sign(edges)
        if tuple(after) == tuple(before):
            break
        before = after
    edges = edges.coalesce(1 + before[0] // LINKS)
    roots = edges.select("u").distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(roots.select(F.col("u").alias("node"), F.col("u").alias("root")))
