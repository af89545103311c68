"""Approximate nearest neighbours by shifted space-filling curves.

Largest inner product is turned into nearness on a sphere: a candidate gets one more coordinate, sqrt(M^2 - |v|^2) with
M the largest norm, and a query is scaled to norm M with 0 there.  Each curve projects the vectors at random to a few
dimensions, spreads them over the unit cube, shifts them and orders them along a Hilbert curve.  Spark range-partitions
the orders; a place in an order is a number.  A query looks at all candidates within a window of places around its own,
on every curve; what the windows find is merged and ranked by exact inner products in double precision.

The window is no fixed number: a bounded sample of queries is answered by a pass over all vectors, and the window is set
so that it holds the wanted share of their true neighbours on some curve.  Data without structure get wide windows (up
to all of the order), clustered data narrow ones.

Equal vectors are folded to one class with its smallest ids before the search (a limit for each group that acts before
the shuffle), so copies neither crowd windows nor gather in a task.  Blocks of an order have a fixed number of rows.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do those of
another length than most; rows of equal id and vector count once; a query with fewer candidates returns all of them;
ties go to the smaller vec_id; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


@dataclass(frozen=True)
class CurveSettings:
    """curves orders over dims projected coordinates of bits each.  fit_rows and fit_queries bound what is fitted on.

    recall is the share of true neighbours that the window is set for; block the rows of a block of an order.
    """

    curves: int = 5
    dims: int = 4
    bits: int = 15
    recall: float = 0.965
    fit_rows: int = 2048
    fit_queries: int = 96
    block: int = 4096
    queries_at_once: int = 4096
    seed: int = 17


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of n x d points (unsigned, below 2 ** bits) on a Hilbert curve; bits * d is 63 at most.

    The coordinates are transformed from the highest bit down (exchange or invert the lower bits of the first one), then
    Gray-coded and interleaved.
    """
    x = points.astype(np.uint64).T.copy()
    d, one = len(x), np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        q = one << np.uint64(bit)
        low = q - one
        for i in range(d):
            on = (x[i] & q) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        q = one << np.uint64(bit)
        flip ^= np.where((x[d - 1] & q) != 0, q - one, np.uint64(0))
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << one | x[i] >> np.uint64(bit) & one
    return key.astype(np.int64)


class Curves:
    """Random projections, their spread over a sample, and shifts."""

    def __init__(self, sample: np.ndarray, largest: float, settings: CurveSettings):
        rng, d = np.random.default_rng(settings.seed), sample.shape[1] + 1
        self.largest, self.settings = largest, settings
        self.axes, self.mean, self.spread, self.shift = [], [], [], []
        rows = self._raised(sample)
        for _ in range(settings.curves):
            a = np.linalg.qr(rng.standard_normal((d, min(d, settings.dims))))[0]
            y = rows @ a
            self.axes.append(a)
            self.mean.append(y.mean(axis=0))
            self.spread.append(y.std(axis=0) + 1e-12)
            self.shift.append(rng.random(a.shape[1]))

    def _raised(self, v: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.largest**2 - (v * v).sum(axis=1), 0))
        return np.concatenate([v, rest[:, None]], axis=1)

    def keys(self, v: np.ndarray, query: bool) -> list[np.ndarray]:
        if query:
            v = v * (self.largest / np.sqrt((v * v).sum(axis=1)))[:, None]
            rows = np.concatenate([v, np.zeros((len(v), 1))], axis=1)
        else:
            rows = self._raised(v)
        out, top = [], 1 << self.settings.bits
        for a, mean, spread, shift in zip(self.axes, self.mean, self.spread, self.shift, strict=True):
            unit = 1 / (1 + np.exp(-1.7 * np.clip((rows @ a - mean) / spread, -20, 20)))
            out.append(hilbert_keys(np.minimum((unit + shift) / 2 * top, top - 1).astype(np.uint64), self.settings.bits))
        return out


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    one = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    one = one.where(v.isNotNull() & F.col("id").isNotNull()).where(~F.coalesce(bad, F.lit(True))).where(F.exists(v, lambda x: x != 0))
    lengths = one.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    return one.where(F.size("v") == (lengths.n if lengths else 0))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(cid, v, ids, is_query): each different vector with its k + 1 smallest ids; checkpointed, as cid is a row number."""
    order = Window.partitionBy("v").orderBy("id")
    few = rows.select("id", "v").withColumn("r", F.dense_rank().over(order)).where(F.col("r") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    asked = rows.where("id % 20 = 0").select("v").distinct().withColumn("asked", F.lit(True))
    out = few.join(asked, "v", "left").select(F.monotonically_increasing_id().alias("cid"), "v", "ids", F.coalesce("asked", F.lit(False)).alias("is_query"))
    return materialize(out)


def _matrix(column) -> np.ndarray:
    """n x d doubles of an Arrow list column."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _orders(different: DataFrame, curves: Curves) -> DataFrame:
    """(curve, place, cid, is_query, v, ids): candidates (is_query false) and queries in every order, with their places."""
    spark = different.sparkSession

    def keyed(batches):
        import pyarrow as pa

        for batch in batches:
            v = _matrix(batch.column(1))
            asked = np.flatnonzero(batch.column(3).to_numpy(zero_copy_only=False))
            for query, rows in ((False, np.arange(len(v))), (True, asked)):
                if len(rows):
                    part = batch.take(pa.array(rows))
                    for c, key in enumerate(curves.keys(v[rows], query)):
                        n = len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, c, np.int32)), pa.array(key), part.column(0), pa.array(np.full(n, query)), part.column(1), part.column(2)],
                            ["curve", "key", "cid", "is_query", "v", "ids"],
                        )

    def numbered(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), {}
        for batch in batches:
            curve = batch.column(0).to_numpy()
            place = np.empty(len(curve), np.int64)
            for c in np.unique(curve).tolist():
                own = curve == c
                place[own] = np.arange(own.sum()) + at.get(c, 0)
                at[c] = at.get(c, 0) + int(own.sum())
            cols = [batch.column(0), pa.array(np.full(len(curve), part, np.int32)), pa.array(place), *(batch.column(i) for i in range(2, 6))]
            yield pa.RecordBatch.from_arrays(cols, ["curve", "part", "place", "cid", "is_query", "v", "ids"])

    rows = "cid long, is_query boolean, v array<double>, ids array<long>"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = different.select("cid", "v", "ids", "is_query").mapInArrow(keyed, f"curve int, key long, {rows}").repartitionByRange(n, "curve", "key", "cid", "is_query")
    local = materialize(ordered.sortWithinPartitions("curve", "key", "cid", "is_query").mapInArrow(numbered, f"curve int, part int, place long, {rows}"))
    starts, so_far = [], {}
    for r in sorted(local.groupBy("curve", "part").agg(F.count("*").alias("n")).collect()):  # one row for each partition and curve
        starts.append((r.curve, r.part, so_far.get(r.curve, 0)))
        so_far[r.curve] = so_far.get(r.curve, 0) + r.n
    first = spark.createDataFrame(starts, "curve int, part int, first long")
    return local.join(F.broadcast(first), ["curve", "part"]).select("curve", (F.col("place") + F.col("first")).alias("place"), "cid", "is_query", "v", "ids")


def best_of(scores: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k best by (score descending, first ascending)."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((first[some], -scores[some]))[:k]]


def _window(different: DataFrame, orders: DataFrame, settings: CurveSettings, k: int) -> int:
    """Places on each side that hold settings.recall of the sampled queries' true neighbours on some curve."""
    spark = different.sparkSession
    few = different.where("is_query").orderBy(F.xxhash64("cid", F.lit(settings.seed))).limit(settings.fit_queries).select("cid", "v").collect()
    own, q = np.array([r.cid for r in few]), np.array([r.v for r in few])

    def nearest(batches):
        import pyarrow as pa

        for batch in batches:
            cid, s = batch.column(0).to_numpy(), q @ _matrix(batch.column(1)).T
            for i in range(len(q)):
                pick = best_of(s[i], cid, k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pick), own[i])), pa.array(cid[pick]), pa.array(s[i][pick])], ["q", "cid", "s"])

    ranked = different.select("cid", "v").mapInArrow(nearest, "q long, cid long, s double").where("q <> cid")
    order = Window.partitionBy("q").orderBy(F.desc("s"), "cid")
    true = ranked.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("q", "cid").collect()
    if not true:
        return 1
    wanted = spark.createDataFrame(sorted({(int(x), x in set(own.tolist())) for r in true for x in r} | {(int(x), True) for x in own}), "cid long, own boolean")
    wanted = wanted.groupBy("cid").agg(F.max("own").alias("own"))
    at = orders.join(F.broadcast(wanted), "cid").where("own OR NOT is_query").select("curve", "cid", "is_query", "place").collect()
    places: dict = {}
    for r in at:
        places[r.curve, r.cid, r.is_query] = r.place
    miss = [min(abs(places[c, r.q, True] - places[c, r.cid, False]) for c in range(settings.curves)) for r in true]
    return int(np.quantile(miss, settings.recall) * 1.05) + 32


def nearest_neighbours(rows: DataFrame, k: int = 20, settings: CurveSettings = CurveSettings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by 20 its k nearest rows found."""
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    part = usable(rows, id_col, vector_col)
    different = classes(part, k)
    largest = different.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    if not largest.n or different.where("is_query").isEmpty():
        return spark.createDataFrame([], schema)
    sample = different.orderBy(F.xxhash64("cid", F.lit(settings.seed))).limit(settings.fit_rows).select("v").collect()
    curves = Curves(np.array([r.v for r in sample]), float(np.sqrt(largest.m)), settings)
    orders = _orders(different, curves)
    window = _window(different, orders, settings, k)

    size, last = settings.block, orders.groupBy().agg(F.max("place")).first()[0]
    shares = max(1, -(-(size + 2 * window) // (20 * settings.queries_at_once)))  # so a task's queries stay bounded
    block = (F.col("place") / size).cast("long")
    low, high = F.greatest(((F.col("place") - window) / size).cast("long"), F.lit(0)), F.least(((F.col("place") + window) / size).cast("long"), F.lit(last // size))
    asked = orders.where("is_query").select("curve", "place", "cid", "v", F.pmod(F.xxhash64("cid"), F.lit(shares)).cast("int").alias("share"), F.explode(F.sequence(low, high)).alias("block"))
    given = orders.where("NOT is_query").select("curve", block.alias("block"), "place", "cid", "v", "ids", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))

    def search(asked_part, given_part):
        """The best k + 1 classes in reach of each query."""
        import pyarrow as pa

        names = ["cid", "found"]
        kind = pa.list_(pa.struct([("score", pa.float64()), ("cid", pa.int64()), ("ids", pa.list_(pa.int64()))]))
        if not asked_part.num_rows or not given_part.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], kind)], names)
        q, c = (_matrix(t["v"].combine_chunks()) for t in (asked_part, given_part))
        q_place, c_place, cid = asked_part["place"].to_numpy(), given_part["place"].to_numpy(), given_part["cid"].to_numpy()
        ids = given_part["ids"].to_pylist()
        first = np.array([x[0] for x in ids])
        found = []
        for at in range(0, len(q), 256):
            s = q[at : at + 256] @ c.T
            s[np.abs(q_place[at : at + 256, None] - c_place[None, :]) > window] = -np.inf
            for i in range(len(s)):
                pick = best_of(s[i], first, k + 1)
                pick = pick[np.isfinite(s[i][pick])]
                exact = np.einsum("ij,j->i", c[pick], q[at + i])
                found.append([{"score": e, "cid": int(cid[p]), "ids": ids[p]} for e, p in zip(exact.tolist(), pick.tolist(), strict=True)])
        return pa.table([asked_part["cid"].combine_chunks(), pa.array(found, kind)], names)

    def merge(t):
        """One list of (score, id), the best k + 1 ids, of all lists of a query."""
        import pyarrow as pa

        each: dict = {}
        for found in t["found"].to_pylist():
            for f in found:
                each[f["cid"]] = (f["score"], f["ids"])
        best = sorted((-s, i) for s, ids in each.values() for i in ids)[: k + 1]
        kind = pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64())]))
        return pa.table([pa.array([t["cid"][0].as_py()], pa.int64()), pa.array([[{"score": -s, "id": i} for s, i in best]], kind)], ["cid", "best"])

    keys = ["curve", "block", "share"]
    asked, given = asked.toDF(*asked.columns), given.toDF(*given.columns)  # both come from one table: give each side columns of its own
    some = asked.groupBy(*keys).cogroup(given.groupBy(*keys)).applyInArrow(search, "cid long, found array<struct<score:double,cid:long,ids:array<long>>>")
    best = some.groupBy("cid").applyInArrow(merge, "cid long, best array<struct<score:double,id:long>>")
    members = part.where("id % 20 = 0").distinct().join(different.where("is_query").select("cid", "v"), "v").select("cid", "id")
    other = F.slice(F.filter("best", lambda x: x["id"] != F.col("id")), 1, k)
    return members.join(best, "cid").select(F.col("id").alias("query_id"), F.posexplode(other).alias("at", "b")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"), F.col("b.score").alias("score"))
