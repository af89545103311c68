"""Packing: vector bin packing of token sequences by the dot-product heuristic.

A sequence has three limits: tokens, segments, and tokens that bear loss.  An open sequence takes, again and
again, the waiting piece whose demand vector has the largest dot product with what the sequence has left
(both as shares of the limits) among those that fit in all three; when none fits, the longest waiting piece is
cut to fill the rest.  Each task packs the rows of its own partition as a stream with at most ``window``
waiting pieces: no shuffle, no hot group, memory bounded, and one sequence a task can stay short.

Defined results: null text counts as empty; repeated rows are packed each for itself; a null doc_id is kept;
an empty table gives no rows.  Sequence ids are unique (partition number * 2**32 + number in the partition).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, free_name, slices
from .word_ids import default_tokenizer, encoder

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " segment int, loss_tokens long"
)


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 128
    loss_tokens: int = 2048


class Packer:
    """Items go in by add(key, n, prompt); place(key, start, length, sequence, offset, segment, loss) is called for each piece.

    prompt: how many leading tokens of the item bear no loss.
    """

    def __init__(self, place, limits: Limits = Limits(), window: int = 1024, first_sequence: int = 0):
        self.place, self.limits, self.window, self.sequence = place, limits, window, first_sequence
        size = window + 1
        self.keys: list = [None] * size
        self.start, self.left, self.free = (np.zeros(size, np.int64) for _ in range(3))
        self.n = 0

    def add(self, key, n: int, prompt: int = 0) -> None:
        lim, start = self.limits, 0
        while n - start >= lim.tokens and self._loss(start, lim.tokens, prompt) <= lim.loss_tokens:
            self.place(key, start, lim.tokens, self.sequence, 0, 0, self._loss(start, lim.tokens, prompt))
            self.sequence += 1
            start += lim.tokens
        if n > start:
            i = self.n
            self.keys[i], self.start[i], self.left[i], self.free[i] = key, start, n - start, max(0, prompt - start)
            self.n += 1
            while self.n > self.window:
                self._pack_one()

    @staticmethod
    def _loss(start: int, n: int, prompt: int) -> int:
        return n - min(n, max(0, prompt - start))

    def flush(self) -> None:
        while self.n:
            self._pack_one()

    def _pack_one(self) -> None:
        lim = self.limits
        tokens, segments, loss, offset, segment = lim.tokens, lim.segments, lim.loss_tokens, 0, 0
        while tokens and segments and self.n:
            left, bears = self.left[: self.n], np.maximum(self.left[: self.n] - self.free[: self.n], 0)
            score = left * (tokens / lim.tokens**2) + bears * (loss / lim.loss_tokens**2) + segments / lim.segments**2
            score[(left > tokens) | (bears > loss)] = -1.0
            i = int(score.argmax())
            if score[i] >= 0:
                take = int(left[i])
            else:
                i = int(left.argmax())
                take = min(tokens, int(left[i]), int(self.free[i]) + loss)
                if take <= 0:
                    i = int(self.free[: self.n].argmax())
                    take = min(tokens, int(self.free[i]))
                    if take <= 0:
                        break
            bearing = max(0, take - int(self.free[i]))
            self.place(self.keys[i], int(self.start[i]), take, self.sequence, offset, segment, bearing)
            tokens, loss, segments, offset, segment = tokens - take, loss - bearing, segments - 1, offset + take, segment + 1
            if take == left[i]:
                self.n -= 1
                last = self.n
                self.keys[i], self.start[i], self.left[i], self.free[i] = self.keys[last], self.start[last], self.left[last], self.free[last]
                self.keys[last] = None
            else:
                self.start[i] += take
                self.left[i] -= take
                self.free[i] = max(0, int(self.free[i]) - take)
        if not segment:
            raise ValueError("the limits leave no room for a single token")
        self.sequence += 1


def pack(docs: DataFrame, limits: Limits = Limits(), tokenizer: str | None = None, end_id: int = 1, window: int = 1024, keep_ids: bool = False, prompt_col: str | None = None, remembered: int = 250_000) -> DataFrame:
    """A row for each piece; with keep_ids also its ids (array<int>), for writing the sequences themselves.

    prompt_col: a column with how many leading tokens of a row bear no loss; null is none.  Without it all tokens bear loss.
    remembered: words that each worker keeps the ids of (twice as many at most); fewer take less memory and more time.
    """
    path = tokenizer or default_tokenizer()
    schema = SCHEMA + (", ids array<int>" if keep_ids else "")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        names = [x.split()[0] for x in SCHEMA.split(", ")]
        types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        end, encode = int(end_id).to_bytes(4, "little"), encoder(path, remembered).encode
        rows: list[tuple] = []
        own: list = []

        def place(key, start, length, sequence, offset, segment, loss):
            doc_id, ids = key
            part = ids[4 * start : 4 * (start + length)]
            rows.append((doc_id, start, length, zlib.crc32(part), len(ids) // 4, sequence, offset, segment, loss))
            if keep_ids:
                own.append(np.frombuffer(part, "<u4").astype(np.int32))

        def out():
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            batch = pa.RecordBatch.from_arrays(cols + ([pa.array(own, pa.list_(pa.int32()))] if keep_ids else []), names + ["ids"] * keep_ids)
            rows.clear()
            own.clear()
            return batch

        packer = Packer(place, limits, window, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for part in slices(batch):
                for doc_id, text, prompt in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    ids = encode(text) + end
                    packer.add((doc_id, ids), len(ids) // 4, prompt)
                if len(rows) >= 4096:
                    yield out()
        packer.flush()
        if rows:
            yield out()

    p = free_name(docs, "prompt")
    prompt = F.lit(0) if prompt_col is None else F.coalesce(F.col(f"`{prompt_col}`"), F.lit(0))
    one = bounded_batches(docs).withColumn(p, prompt.cast("long"))
    return one.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col(p)).mapInArrow(run, schema)
