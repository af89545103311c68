"""Token-id files with bit-plane shuffling.

File format (little-endian), one file for each shard, shards in ascending doc_id order:

    "TPLN" u32 version=1
    chunk*      the planes of a block of BLOCK ids (the last one may be shorter), each plane compressed with zstandard
    index       zstandard of: u64 number of chunks, then for each chunk u64 offset, u32 ids, u32 planes, planes * u32 compressed bytes
    documents   zstandard of: u64 number of documents, doc_id i64 each, null flag u8 each, ids u64 each
    footer      u64 offset of index, u64 bytes of index, u64 offset of documents, u64 bytes of documents, "NLPT"

A block of n ids is an n x 32 matrix of bits; its transpose gives 32 bit planes of n bits each (bit k of every id,
packed).  Only planes up to the highest bit set in the block are kept.  With ``plane_bits=8`` whole byte planes are
kept instead.  Files go to the shared folder under a temporary name and are renamed, so a repeated task replaces its
own file by an equal one.

Defined results: null text counts as empty; null doc_ids come first; equal doc_ids follow one another, by text hash;
every row keeps its end id; an empty table writes no file and gives no rows.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, materialize, shared_path, slices
from .word_ids import default_tokenizer, encoder

MAGIC, TAIL, VERSION, BLOCK = b"TPLN", b"NLPT", 1, 1 << 16


def split_planes(ids: np.ndarray, plane_bits: int = 1) -> list[bytes]:
    """The planes of a block, lowest first."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    top = int(ids.max()).bit_length() if len(ids) else 0
    if plane_bits == 8:
        return [raw[:, k].tobytes() for k in range(-(-top // 8))]
    out = []
    for k in range(top):
        out.append(np.packbits((raw[:, k // 8] >> (k % 8)) & 1, bitorder="little").tobytes())
    return out


def join_planes(planes: list[bytes], n: int, plane_bits: int = 1) -> np.ndarray:
    raw = np.zeros((n, 4), np.uint8)
    for k, plane in enumerate(planes):
        data = np.frombuffer(plane, np.uint8)
        if plane_bits == 8:
            raw[:, k] = data
        else:
            raw[:, k // 8] |= np.unpackbits(data, count=n, bitorder="little") << (k % 8)
    return raw.reshape(-1).view("<u4")


class Writer:
    """Takes documents one by one; holds one block of ids and the index."""

    def __init__(self, stream, block: int = BLOCK, plane_bits: int = 1, level: int = 1):
        import zstandard

        self.stream, self.block, self.plane_bits = stream, block, plane_bits
        self.zip = zstandard.ZstdCompressor(level=level)
        self.at = stream.write(MAGIC + struct.pack("<II", VERSION, plane_bits)) or 12
        self.at = 12
        self.waiting: list[bytes] = []
        self.n_waiting = 0
        self.index: list[bytes] = []
        self.docs: list[tuple] = []
        self.n_ids = 0

    def add(self, doc_id, ids: bytes) -> None:
        n = len(ids) // 4
        self.docs.append((doc_id, n))
        self.n_ids += n
        self.waiting.append(ids)
        self.n_waiting += n
        if self.n_waiting >= self.block:
            self._write_blocks(False)

    def _write_blocks(self, rest: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        at = 0
        while len(ids) - at >= self.block or rest and at < len(ids):
            part = ids[at : at + self.block]
            planes = [self.zip.compress(p) for p in split_planes(part, self.plane_bits)]
            self.index.append(struct.pack(f"<QII{len(planes)}I", self.at, len(part), len(planes), *map(len, planes)))
            self.stream.write(b"".join(planes))
            self.at += sum(map(len, planes))
            at += len(part)
        self.waiting, self.n_waiting = [ids[at:].tobytes()], len(ids) - at

    def close(self) -> None:
        self._write_blocks(True)
        index = self.zip.compress(struct.pack("<Q", len(self.index)) + b"".join(self.index))
        docs = self.zip.compress(
            struct.pack("<Q", len(self.docs))
            + np.array([0 if d is None else d for d, _ in self.docs], "<i8").tobytes()
            + np.array([d is None for d, _ in self.docs], np.uint8).tobytes()
            + np.array([n for _, n in self.docs], "<u8").tobytes()
        )
        self.stream.write(index + docs + struct.pack("<4Q", self.at, len(index), self.at + len(index), len(docs)) + TAIL)


class Reader:
    """Reads a file by its chunk index; one block of ids in memory at a time."""

    def __init__(self, source):
        import zstandard

        self.source, self.zip = source, zstandard.ZstdDecompressor()
        size = source.size()
        head, foot = self._at(0, 12), self._at(size - 36, 36)
        if head[:4] != MAGIC or foot[32:] != TAIL:
            raise ValueError("not a token plane file")
        self.plane_bits = struct.unpack("<II", head[4:])[1]
        a, n, b, m = struct.unpack("<4Q", foot[:32])
        index, docs = self.zip.decompress(self._at(a, n)), self.zip.decompress(self._at(b, m))
        self.chunks, at = [], 8
        for _ in range(struct.unpack_from("<Q", index)[0]):
            offset, ids, planes = struct.unpack_from("<QII", index, at)
            self.chunks.append((offset, ids, struct.unpack_from(f"<{planes}I", index, at + 16)))
            at += 16 + 4 * planes
        n = struct.unpack_from("<Q", docs)[0]
        self.doc_ids = np.frombuffer(docs, "<i8", n, 8)
        self.null = np.frombuffer(docs, np.uint8, n, 8 + 8 * n).astype(bool)
        self.lengths = np.frombuffer(docs, "<u8", n, 8 + 9 * n).astype(np.int64)

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def chunk(self, k: int) -> np.ndarray:
        offset, n, sizes = self.chunks[k]
        data, planes, at = self._at(offset, sum(sizes)), [], 0
        for s in sizes:
            planes.append(self.zip.decompress(data[at : at + s]))
            at += s
        return join_planes(planes, n, self.plane_bits)

    def documents(self):
        """(doc_id, start in the file, ids) in file order."""
        k, buffer, at, start = 0, np.zeros(0, "<u4"), 0, 0
        for doc_id, null, n in zip(self.doc_ids.tolist(), self.null.tolist(), self.lengths.tolist(), strict=True):
            parts, need = [], n
            while need:
                if at == len(buffer):
                    buffer, at, k = self.chunk(k), 0, k + 1
                take = min(need, len(buffer) - at)
                parts.append(buffer[at : at + take])
                at, need = at + take, need - take
            yield None if null else doc_id, start, parts[0] if len(parts) == 1 else np.concatenate([*parts, np.zeros(0, "<u4")])
            start += n


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def write(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2, partitions: int | None = None, block: int = BLOCK, plane_bits: int = 1) -> DataFrame:
    """Write the shards; a row (shard, path, n_docs, n_ids) for each.  The rows are checkpointed: files are written once.

    Rows are range-partitioned by (doc_id, hash of text, row number), so copies of one doc_id spread over several shards.
    """
    path = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    keyed = doc_text(docs).select("doc_id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("r"), "text")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionByRange(n, "doc_id", "h", "r").sortWithinPartitions("doc_id", "h", "r").select("doc_id", "text")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        filesystem, root = _filesystem(folder)
        name, scratch = f"{root}/shard-{shard:06d}.tpl", f"{root}/_{uuid.uuid4().hex}.tmp"
        writer = stream = None
        end, encode = int(end_id).to_bytes(4, "little"), encoder(path).encode
        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if writer is None:
                        filesystem.create_dir(root, recursive=True)
                        stream = filesystem.open_output_stream(scratch)
                        writer = Writer(stream, block, plane_bits)
                    writer.add(doc_id, encode(text) + end)
        if writer is not None:
            writer.close()
            stream.close()
            filesystem.move(scratch, name)
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"shard-{shard:06d}.tpl"], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]})

    return materialize(ordered.mapInArrow(run, "shard long, path string, n_docs long, n_ids long"))


def read_back(shards: DataFrame, folder: str, keep_ids: bool = False) -> DataFrame:
    """A row for each document of the files: doc_id, start over all shards, n_tokens, ids_crc32 (and ids, if asked for).

    The driver sums up one number for each shard; there are as many as write() had partitions.
    """
    spark = shards.sparkSession
    rows, start = [], 0
    for r in sorted(shards.collect()):
        rows.append((r.path, start))
        start += r.n_ids
    todo = spark.createDataFrame(rows, "path string, start long").repartitionByRange(max(1, len(rows)), "start")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")

    def run(batches):
        import pyarrow as pa

        names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * keep_ids
        types = [pa.int64()] * 4 + [pa.list_(pa.int32())] * keep_ids

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        filesystem, root = _filesystem(folder)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with filesystem.open_input_file(f"{root}/{name}") as source:
                    rows = []
                    for doc_id, at, ids in Reader(source).documents():
                        rows.append((doc_id, base + at, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())) + ((ids.astype(np.int32),) if keep_ids else ()))
                        if len(rows) >= 2048:
                            yield out(rows)
                            rows = []
                    if rows:
                        yield out(rows)

    return todo.mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write docs into a fresh shared folder and read the files back."""
    folder = shared_path(docs.sparkSession, "token-planes")
    return read_back(write(docs, folder, tokenizer, end_id), folder)
