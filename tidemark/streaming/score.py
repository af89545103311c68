"""Continuous scoring with a frozen plan.

The transformation is a projection without state, so any micro-batching gives the rows of the batch run.  A drift monitor
over event-time windows with a watermark is an extension of the batch profile.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.model import OnceFitted
from ..plans.preparation import PreparationPlan, transform


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below spark.checkpoint.dir, which a cluster must name; one of our own on a single machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{(base or tempfile.mkdtemp(prefix='tidemark-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def is_folder(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


def transformed_stream(stream: DataFrame, plan: PreparationPlan, keep: tuple[str, ...] = ()) -> DataFrame:
    return transform(stream, plan, "test", (plan.contract.id, *keep))


def scored_stream(stream: DataFrame, model: OnceFitted) -> DataFrame:
    return model.score(stream)


def write_scores(stream: DataFrame, model: OnceFitted, path: str, checkpoint: str, once: bool = True):
    """Parquet files by micro-batch; a batch that is repeated overwrites its own folder."""

    def sink(batch: DataFrame, number: int) -> None:
        model.score(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed_profile(stream: DataFrame, time: str, value: str, window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(start, n, missing, mean) by tumbling window; rows later than the watermark are left out."""
    x = F.col(value).cast("double")
    return (
        stream.withWatermark(time, late)
        .groupBy(F.window(time, window).alias("w"))
        .agg(F.count("*").alias("n"), F.count_if(x.isNull()).alias("missing"), F.avg(x).alias("mean"))
        .select(F.col("w.start").alias("start"), "n", "missing", "mean")
    )
