"""Helpers that the operators of this subpackage share.

Memory of Python workers is bounded by bytes, not rows: ``bounded_batches`` limits the Arrow batches that Spark sends, and
``slices`` cuts them further where texts become Python objects.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an Arrow batch sent to a worker, and of the texts that are Python objects at once (a longer text is alone).
BATCH_BYTES, SLICE_BYTES = 4 << 20, 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bounded_batches(df: DataFrame) -> DataFrame:
    """df, after its session sends Arrow batches of BATCH_BYTES at most; a lower limit of the session stays."""
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_LIMIT).rstrip("bB")) > BATCH_BYTES:  # Spark gives it in bytes
        conf.set(BATCH_LIMIT, BATCH_BYTES)
    return df


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names.  Only a session on one machine gets one of its own where none is set."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


_MADE: set[str] = set()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder; what is there goes when the driver ends, or by ``remove``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
    if not _MADE:
        atexit.register(remove_all)
    _MADE.add(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``shared_path``; nothing that is still to be computed may read it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _MADE.discard(path)


def remove_all() -> None:
    """Delete all folders of ``shared_path`` that are left, if the session still runs."""
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        for path in sorted(_MADE):
            remove(spark, path)


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession):
    """What is planned and run within removes its shuffle files when it ends, not when the driver next collects garbage.

    Nothing reads them again after a checkpoint, a written table or a count.  The session's own setting comes back.
    """
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    with tidy(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # planned anew, within


def spill_table(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder."""
    return spilled(df, name)[0]


def spilled(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The table of ``spill_table`` and its folder, for ``remove``."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    with tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


#: Rows of two or three longs that may be broadcast: about 20 MB at most.
FEW_ROWS = 500_000


def joined_to_few(big: DataFrame, few: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """big joined to a computed table of narrow rows: broadcast if it has FEW_ROWS at most, so that big is not shuffled; else as any other join."""
    with tidy(few.sparkSession):
        fits = few.limit(FEW_ROWS + 1).count() <= FEW_ROWS
    return big.join(F.broadcast(few) if fits else few, key, how)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that clashes with none of df, upper and lower case taken alike."""
    have = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in have:
        name += "_"
    return name


def doc_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), null text as the empty text: no other column can clash with results."""
    return bounded_batches(df).select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def slices(batch, rows: int = 512, column: int = 1, most: int = SLICE_BYTES):
    """Cut an Arrow batch so that few texts, and few bytes of texts, are Python objects at once."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    values = batch.column(column)
    size = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    ends = np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + most, side="right"))))
        yield batch.slice(at, to - at)
        at = to


def parts_by_size(texts: list, rows: int = 512, most: int = SLICE_BYTES):
    """(start, end) of runs of a list of texts, each with few texts and few characters."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > at and (i - at >= rows or size + n > most):
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)
