"""Links between texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash bits are too coarse for this bound: at similarity 0.8 two fingerprints of 64 bits differ in about ten, and no split
of 64 bits into segments finds ten differing bits without comparing most pairs.  So the candidates of the fingerprints
(``simhash.links``) are joined by those of min-wise hashes: BANDS keys, each of ROWS minima of the shingle hashes.  A pair of
similarity s shares a key with probability 1 - (1 - s^ROWS)^BANDS, which is 0.9996 at 0.8.  Every candidate is verified
by the exact similarity of the two sets, so no link is below the bound.

Words are hashed once (XXH64); a shingle's hash mixes those of its words.

Equal sets are one node.  Each node is compared with the least node that it shares a bucket with.  In small buckets that are
not one component then, the open pairs are compared, each in the first bucket it shares.  In larger ones the largest component
is the body; only nodes outside it are compared with others, first with the WINDOW nodes of lowest hashes, then with 64 times as
many, until the bucket is one component or all its open pairs have been compared.  For that, both sides are dealt into blocks
of bounded bytes, by size class, and each block of the one meets each block of the other in one task, which emits only
links between different components: a set is sent once for a block, not once for a pair.  Sets are made again from the texts of
those nodes only that share a bucket; sets whose sizes rule out the similarity are not compared.  For the comparison a shingle
is the lower half of its hash (two different shingles of a pair of texts with 1,000 each are taken for one another with
probability 0.0002).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined_to_few, materialize, spill_table
from .components import connected_components

SHINGLE, SEED, SIMILARITY = 5, 42, 0.8
BANDS, ROWS, SMALL, WINDOW = 20, 5, 16, 64
#: Sets of a block at most, and their bytes, about.
BLOCK, BLOCK_BYTES = 1024, 4 << 20
SIGNATURE = "struct<set_id:bigint,size:bigint,fp:bigint,bands:array<bigint>>"


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Hashes (unsigned) of the shingles, repeats included; a text of fewer words is one shingle, an empty one has none."""
    from xxhash import xxh64_intdigest

    from .simhash import WORD

    words = WORD.findall((text or "").encode().lower())
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter((xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    size = min(size, len(own))
    out = np.full(len(own) - size + 1, size, np.uint64)
    for k, times in enumerate(_odd(size, SEED)):
        out += own[k : len(own) - size + 1 + k] * times
    return _mixed(out)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted different hashes of the shingles."""
    return np.unique(shingle_hashes(text, size))


def majority_bits(hashes: np.ndarray) -> int:
    """The SimHash fingerprint: a bit is 1 if it is set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        counts += np.unpackbits(hashes[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


@lru_cache(maxsize=1)
def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    one, two, three = np.split(_odd(3 * BANDS * ROWS, SEED), 3)
    return one[:, None], two[:, None], three.reshape(BANDS, ROWS)


def bands(hashes: np.ndarray) -> np.ndarray:
    """The BANDS keys of a set of hashes; none of the empty set."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    times, plus, mix = _constants()
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        mixed = hashes[None, at : at + 512] * times
        mixed += plus
        mixed ^= mixed >> np.uint64(32)
        np.minimum(least, mixed.min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS)
    key = ((rows ^ (rows >> np.uint64(29))) * mix).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * mix[0, 0]
    return (key ^ (key >> np.uint64(31))).view(np.int64)


def signature_column(text: Column) -> Column:
    """set_id (a hash of the whole set), its size, the SimHash fingerprint of the shingles, and the band keys."""

    @F.pandas_udf(SIGNATURE)
    def run(texts):
        import pandas as pd
        from xxhash import xxh64_intdigest

        ids, sizes, fps, keys = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.uint64), []
        for k, text in enumerate(texts):  # one set at a time in memory
            every = shingle_hashes(text)
            own = np.unique(every)
            ids[k], sizes[k], fps[k] = xxh64_intdigest(own.tobytes(), SEED), len(own), majority_bits(every)
            keys.append(bands(own))
        return pd.DataFrame({"set_id": ids.view(np.int64), "size": sizes, "fp": fps.view(np.int64), "bands": keys})

    return run(text)


def _set_column(text: Column) -> Column:
    @F.pandas_udf("binary")
    def run(texts):
        import pandas as pd

        return pd.Series([np.unique(shingle_hashes(t).astype(np.uint32)).tobytes() for t in texts], dtype=object)

    return run(text)


def _similar(a: Column, b: Column, least: float) -> Column:
    """Whether the sets' Jaccard similarity is at least so large; empty sets are equal."""

    @F.pandas_udf("boolean")
    def run(left, right):
        import pandas as pd

        out = []
        for x, y in zip(left, right, strict=True):
            x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
            if min(len(x), len(y)) < least * max(len(x), len(y)):
                out.append(False)
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both >= least * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    return run(a, b)


def close_sets(ones: list[np.ndarray], others: list[np.ndarray], least: float):
    """For each of the sorted sets, the places of the others with that Jaccard similarity or more."""
    sizes = np.array([len(o) for o in others])
    flat, owner = np.concatenate(others), np.repeat(np.arange(len(others)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    for one in ones:
        start = np.searchsorted(flat, one, "left")
        found = np.searchsorted(flat, one, "right") - start
        at = np.repeat(start - np.cumsum(found) + found, found) + np.arange(found.sum())
        both = np.bincount(owner[at], minlength=len(others))
        yield np.nonzero(both >= least * (len(one) + sizes - both))[0]


def _block_links(left, right, least: float):
    """Links (u, v) between the sets of two blocks that join different components, by union-find over their roots."""
    import pyarrow as pa

    parent: dict[int, int] = {}

    def find(a):
        while (up := parent.get(a, a)) != a:
            parent[a] = parent.get(up, up)
            a = up
        return a

    out = []
    if left.num_rows and right.num_rows:
        ones, others = ([np.frombuffer(s, np.uint32) for s in t.column("s").to_pylist()] for t in (left, right))
        h, root = (right.column(c).to_numpy() for c in ("h", "root"))
        nodes = zip(left.column("h").to_pylist(), left.column("root").to_pylist(), close_sets(ones, others, least), strict=True)
        for u, own, near in nodes:
            roots, at = np.unique(root[near], return_index=True)
            for r, j in zip(roots.tolist(), near[at].tolist(), strict=True):
                if (a := find(own)) != (b := find(r)):
                    parent[a] = b
                    out.append((u, int(h[j])))
    u, v = zip(*out, strict=True) if out else ((), ())
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _block_rows(level: Column) -> Column:
    """Sets of a block of sizes below 2^(level + 1)."""
    return F.greatest(F.lit(1.0), F.least(F.lit(float(BLOCK)), F.floor(F.lit(BLOCK_BYTES) / F.pow(F.lit(2.0), level + 3))))


def _met_in_blocks(some: DataFrame, sets: DataFrame, low: int, high: int, least: float) -> DataFrame:
    """(u, v): links of the nodes outside the body with those whose place is in the window.

    some: (key, h, size, n, place, root, body, outside), outside being the number of nodes outside the body.
    """
    level = lambda size: F.floor(F.log2(size)).cast("int")
    rows = _block_rows(F.col("level"))
    deals = F.greatest(F.lit(1.0), F.ceil(F.col("outside") / rows))
    windows = F.greatest(F.lit(1.0), F.ceil((F.least(F.col("n"), F.lit(high)) - low) / rows))
    upto = lambda n: F.explode(F.sequence(F.lit(0), n.cast("int") - 1))
    x = some.where("root <> body").join(sets.select("h", "s"), "h").withColumn("level", level(F.col("size")))
    x = x.withColumn("i", F.pmod(F.xxhash64("h"), deals.cast("long")).cast("int")).withColumn("j", upto(windows))
    y = some.where((F.col("place") >= low) & (F.col("place") < high)).join(sets.select("h", "s"), "h")
    # every level that a set of a size allowed by the similarity can have: one or two
    y = y.withColumn("level", F.explode(F.sequence(level(F.greatest(F.lit(1.0), F.floor(F.col("size") * F.lit(least)))), level(F.ceil(F.col("size") / F.lit(least))))))
    y = y.withColumn("j", F.least(windows - 1, F.floor((F.col("place") - low) / rows)).cast("int")).withColumn("i", upto(deals))
    by, columns = ["key", "level", "i", "j"], ["key", "level", "i", "j", "h", "root", "s"]
    blocks = x.select(*columns).groupBy(*by).cogroup(y.select(*columns).toDF(*columns).groupBy(*by))
    return blocks.applyInArrow(lambda left, right: _block_links(left, right, least), "u long, v long")


def links(nodes: DataFrame, texts: DataFrame, more: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(u, v): verified links, enough to connect all candidates that are linked.

    nodes: (h, size, bands, at), h different; texts: (at, text); more: further candidates (u, v).
    """
    keyed = nodes.select("h", F.explode("bands").alias("key"))
    buckets = materialize(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("h").alias("leader")).where("n > 1"))
    members = spill_table(joined_to_few(keyed, buckets, "key"), "members")
    ends = more.select(F.col("u").alias("h")).union(more.select("v")).union(members.select("h")).distinct()
    wanted = materialize(joined_to_few(nodes.select("h", "at", "size", "bands"), materialize(ends), "h"))
    sets = spill_table(joined_to_few(texts, wanted.select("h", "at", "size"), "at").select("h", "size", _set_column(F.col("text")).alias("s")), "shingles")

    def verified(pairs: DataFrame) -> DataFrame:
        left, right = sets.select(F.col("h").alias("u"), F.col("s").alias("a"), F.col("size").alias("n")), sets.select(F.col("h").alias("v"), F.col("s").alias("b"), F.col("size").alias("m"))
        fit = F.least("n", "m") >= F.lit(least) * F.greatest("n", "m")
        return materialize(pairs.join(left, "u").join(right, "v").where(fit).where(_similar(F.col("a"), F.col("b"), least)).select("u", "v"))

    # first, each node with the least leader of its buckets: one candidate for each node at most, however large the bucket
    first = members.groupBy("h").agg(F.min("leader").alias("u")).where("u < h").select("u", F.col("h").alias("v"))
    found = verified(first.union(more.select("u", "v")).distinct())
    roots = connected_components(found).select(F.col("node").alias("h"), "root")
    here = members.join(roots, "h", "left").select("key", "h", "n", F.coalesce("root", "h").alias("root"))
    parts = here.groupBy("key", "root").agg(F.count("*").alias("c"))
    # the body is the component of this node from now on: it only grows, so that a pair outside it was never left out
    bodies = materialize(parts.groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("of"), F.count("*").alias("parts")).where("parts > 1").select("key", "of"))
    some = materialize(joined_to_few(here, bodies, "key").drop("of").join(wanted.select("h", "size", "bands"), "h"))

    # small buckets at once: every open pair in the first bucket that both are in
    little = some.where(F.col("n") <= SMALL)
    other = little.select("key", F.col("h").alias("u"), F.col("root").alias("own"), F.col("size").alias("of"), F.col("bands").alias("b"))
    alike = F.least("size", "of") >= F.lit(least) * F.greatest("size", "of")
    once = F.expr("element_at(filter(zip_with(bands, b, (x, y) -> if(x = y, x, null)), x -> x IS NOT NULL), 1) = key")
    found = found.union(verified(little.join(other, "key").where("u < h AND root <> own").where(alike).where(once).select("u", F.col("h").alias("v"))))

    place = F.least((F.col("h") / F.lit(2.0**64) + 0.5) * F.col("n"), F.col("n") - 0.5)  # hashes are even: the number of lower nodes in the bucket, about
    some, low, high = some.where(F.col("n") > SMALL).select("key", "h", "size", "n", place.alias("place")), 0, WINDOW
    while not some.isEmpty():
        roots = materialize(connected_components(found).select(F.col("node").alias("h"), "root"))
        now = bodies.join(roots.select(F.col("h").alias("of"), F.col("root").alias("body")), "of", "left").select("key", F.coalesce("body", "of").alias("body"))
        here = joined_to_few(some.join(roots, "h", "left").withColumn("root", F.coalesce("root", "h")), materialize(now), "key")
        here = materialize(here)
        open_ = materialize(here.groupBy("key").agg(F.count_if(F.col("root") != F.col("body")).alias("outside")).where("outside > 0"))
        here = materialize(joined_to_few(here, open_, "key"))
        found = found.union(materialize(_met_in_blocks(here, sets, low, high, least)))
        some = here.where(F.col("n") > high).select("key", "h", "size", "n", "place")
        low, high = high, 64 * high
    return found
