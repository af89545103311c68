"""SimHash near-duplicates with Golay-code fuzzy hashing.

Fingerprint: XXH64 (seed 42) of every 3-word shingle, ASCII letters in lower case; a bit is 1 if it is set in over half
of the hashes.  Fingerprints link at two differing bits or fewer.

Search: a fingerprint is cut into segments of 23, 23 and 18 bits.  By the pigeonhole principle two linked fingerprints
agree in one segment at least, and the others differ in two bits at most, so that their Golay keys (see ``golay``) have
one in common.  The join key is one exact segment with one Golay key of the next segment: at most 18 keys for each
different fingerprint.  Copies share a fingerprint and are folded before, by a partial aggregation.  Buckets of two are
verified by an expression; in larger ones each task emits a spanning forest of the verified links instead of all pairs.
A bucket above ``hot`` fingerprints is dealt out further by the Golay keys of its third segment, which loses no link.

Defined results: null and empty texts have fingerprint zero and link like any other; equal rows share a component; a
component without a non-null doc_id has a null component_id; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import golay, similar
from .common import bounded_batches, doc_text, free_name, joined_to_few, materialize, spill_table
from .components import connected_components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SHINGLE, SEED, DISTANCE, HOT = 3, 42, 2, 4096
SEGMENTS = ((0, 23), (23, 23), (46, 18))


def fingerprint(text: str | None) -> int:
    """As an unsigned number.  bytes.lower() folds A-Z only."""
    from xxhash import xxh64_intdigest

    words = WORD.findall((text or "").encode().lower())
    if not words:
        return 0
    if len(words) <= SHINGLE:
        return xxh64_intdigest(b" ".join(words), SEED)
    counts, n = np.zeros(64, np.int64), len(words) - SHINGLE + 1
    for at in range(0, n, 8192):
        end = min(n, at + 8192)
        hashes = np.array([xxh64_intdigest(b" ".join(words[i : i + SHINGLE]), SEED) for i in range(at, end)], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column) -> Column:
    """The fingerprint as a (signed) long."""

    @F.pandas_udf("long")
    def run(texts):
        import pandas as pd

        return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    return run(text)


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    return [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.uint32) for at, n in SEGMENTS]


def _keyed(fps: DataFrame) -> DataFrame:
    """(key, fp): the segment's number, the exact segment and one Golay key of the next, in one long."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                raw = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False)
                seg = _segments(raw.view(np.uint64))
                for k in range(3):
                    rows, near = golay.distinct_keys(seg[(k + 1) % 3])
                    key = (k << 40) | (seg[k][rows].astype(np.int64) << 12) | near.astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(raw[rows])], ["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def _dealt_by_third(hot: DataFrame) -> DataFrame:
    """(key, sub, fp) of (key, fp): one row for each Golay key of the third segment."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            key, raw = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            seg, third = _segments(raw.view(np.uint64)), (key >> 40) + 2
            own = np.choose(third % 3, seg)
            for at in range(0, len(raw), 4096):
                rows, near = golay.distinct_keys(own[at : at + 4096])
                yield pa.RecordBatch.from_arrays([pa.array(key[at:][rows]), pa.array(near.astype(np.int64)), pa.array(raw[at:][rows])], ["key", "sub", "fp"])

    return hot.select("key", "fp").mapInArrow(run, "key long, sub long, fp long")


def forest(fps: np.ndarray, distance: int = DISTANCE, block: int = 1024) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints within the distance; blocks of rows against all, union-find."""
    order = np.sort(np.unique(fps).view(np.int64))
    raw, n = order.view(np.uint64), len(order)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for at in range(0, n, block):
        rows = raw[at : at + block]
        for to in range(at, n, block):
            close = np.bitwise_count(rows[:, None] ^ raw[None, to : to + block]) <= distance
            for i, j in zip(*(x.tolist() for x in np.nonzero(close)), strict=True):
                if (a := root(at + i)) != (b := root(to + j)):
                    parent[max(a, b)] = min(a, b)
                    out.append((int(order[at + i]), int(order[to + j])))
    return out


def _forests(buckets: DataFrame, keys: list[str]) -> DataFrame:
    def run(pdf):
        import pandas as pd

        return pd.DataFrame(forest(pdf["fp"].to_numpy()), columns=["u", "v"], dtype="int64")

    return buckets.groupBy(*keys).applyInPandas(run, "u long, v long")


def links(fps: DataFrame, hot: int = HOT) -> DataFrame:
    """(u, v): verified links between different fingerprints, enough to connect all that are linked."""
    keyed = _keyed(fps)
    buckets = materialize(keyed.groupBy("key").agg(F.min("fp").alias("u"), F.max("fp").alias("v"), F.count("*").alias("n")).where("n > 1"))
    twos = buckets.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE).select("u", "v")
    more = buckets.where("n > 2")
    if more.isEmpty():
        return twos.distinct()
    members = keyed.join(more.select("key", "n"), "key")
    out = twos.union(_forests(members.where(F.col("n") <= hot), ["key"]))
    if not more.where(F.col("n") > hot).isEmpty():
        out = out.union(_forests(_dealt_by_third(members.where(F.col("n") > hot)), ["key", "sub"]))
    return out.distinct()


def classes(fingerprints: DataFrame) -> DataFrame:
    """(fp, least) of a table (doc_id, fp): the least doc_id of the component for each different fingerprint."""
    different = materialize(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    roots = connected_components(links(different)).select(F.col("node").alias("fp"), "root")
    of = different.join(roots, "fp", "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    return of.join(of.groupBy("root").agg(F.min("doc_id").alias("least")), "root").select("fp", "least")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable): one row for each row of docs."""
    one = doc_text(docs, id_col, text_col).select("doc_id", fingerprint_column(F.col("text")).alias("fp"))
    one = spill_table(one, "fingerprints")
    return one.join(classes(one), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float | None = None) -> DataFrame:
    """The rows of docs without near-duplicates: of each component the row with the least id stays (nulls last; of equal ids one).

    Without a similarity, near-duplicates are those of ``near_duplicates``.  With one, they are texts whose five-word
    shingles have that Jaccard similarity or more (see ``similar``).

    Row numbers are frozen in a table of the shared folder, so that a repeated task cannot choose another row.
    """
    r, g = free_name(docs, "row"), free_name(docs, "signature")
    text = F.col(f"`{text_col}`")
    signature = similar.signature_column(text) if similarity is not None else F.struct(fingerprint_column(text).alias("fp"))
    frozen = spill_table(bounded_batches(docs).withColumn(r, F.monotonically_increasing_id()).withColumn(g, signature), "near-duplicates")
    own = F.col(g)
    one = frozen.select(F.col(f"`{id_col}`").alias("doc_id"), own["fp"].alias("fp"), own["fp" if similarity is None else "set_id"].alias("node"), F.col(r).alias("r"))
    order = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "r")
    best = materialize(one.groupBy("node").agg(F.min(order).alias("best"), F.min("fp").alias("fp"), F.count("*").alias("copies")))
    if similarity is None:
        linked = links(best)
    else:
        ones = best.select(F.col("best.r").alias("at"), F.col("node").alias("h"))
        nodes = frozen.select(F.col(r).alias("at"), own["size"].alias("size"), own["bands"].alias("bands")).join(ones, "at")
        first = materialize(best.groupBy("fp").agg(F.min("node").alias("h")))
        near = links(first).join(first.select(F.col("fp").alias("u"), F.col("h").alias("a")), "u").join(first.select(F.col("fp").alias("v"), F.col("h").alias("b")), "v")
        texts = frozen.select(F.col(r).alias("at"), text.alias("text"))
        linked = similar.links(nodes, texts, near.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")), similarity)
    roots = connected_components(linked)
    placed = best.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    winners = placed.groupBy("root").agg(F.min("best").alias("best"))
    # rows that go: all of a node but its best one, and the best one too where the component has a better one
    beaten = placed.join(winners.select("root", F.col("best.r").alias("first")), "root").select("node", F.col("best.r").alias("own"), "first", "copies")
    beaten = materialize(beaten.where("copies > 1 OR own <> first").select("node", "first"))
    gone = joined_to_few(one.select("node", "r"), beaten, "node").where("r <> first").select(F.col("r").alias(r))
    return joined_to_few(frozen, materialize(gone), r, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
