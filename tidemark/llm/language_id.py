"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Texts are cut into segments of SEGMENT bytes; every byte of a whole text is read once in each direction within its
segment.  The network gives language probabilities at every position; a document's probabilities are the mean over
all its positions.  Training is backpropagation through time with Adam on segments of a bounded sample of labelled
documents (``TrainingBounds``); all languages of the table are learned.  Nothing but the bytes of the text is an input.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with no labelled row at all, every
text is ``und``; repeated rows are judged each for itself; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, free_name, parts_by_size

HIDDEN, SEGMENT, BATCH = 8, 64, 2048
UNKNOWN = "und"


@dataclass(frozen=True)
class TrainingBounds:
    """Languages, documents of each, segments of each document, and steps of so many segments."""

    languages: int = 512
    documents: int = 400
    segments: int = 8
    steps: int = 300
    batch: int = 128
    rate: float = 0.02
    seed: int = 7


def squash(x: np.ndarray, scratch: np.ndarray) -> None:
    """x / (1 + |x|) in place: in numpy a tenth of the time of tanh; its slope is (1 - |y|) ** 2.  A gate is (1 + y) / 2."""
    np.abs(x, out=scratch)
    scratch += 1
    x /= scratch


class BiGru:
    """Weights by direction d and gate g: W[d, g] (257 x H, the last row is padding), U[d, g] (H x H), b is part of W; V (2H x L), c (L)."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng, n = np.random.default_rng(seed), len(languages)
        self.languages = languages
        self.W = (rng.standard_normal((2, 3, 257, hidden)) * 0.3).astype(np.float32)
        self.U = (rng.standard_normal((2, 3, hidden, hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.V = (rng.standard_normal((2 * hidden, n)) / np.sqrt(2 * hidden)).astype(np.float32)
        self.c = np.zeros(n, np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.W, self.U, self.V, self.c]

    def _direction(self, x: np.ndarray, d: int, keep: list | None = None) -> np.ndarray:
        """x: T x B bytes in reading order; the states, T x B x H."""
        W, U = self.W[d], self.U[d]
        steps, size = x.shape
        out = np.empty((steps, size, U.shape[-1]), np.float32)
        h = np.zeros((size, U.shape[-1]), np.float32)
        r, z, n, a, s = (np.empty_like(h) for _ in range(5))
        for t in range(steps):
            b = x[t]
            if keep is not None:
                r, z, n, a = (np.empty_like(h) for _ in range(4))
            for gate, g in ((0, r), (1, z)):
                np.take(W[gate], b, axis=0, out=g, mode="clip")
                g += np.dot(h, U[gate], out=s)
                squash(g, s)
                g += 1
                g *= 0.5
            np.dot(h, U[2], out=a)
            np.take(W[2], b, axis=0, out=n, mode="clip")
            n += np.multiply(a, r, out=s)
            squash(n, s)
            if keep is not None:
                keep.append((h, r, z, n, a))
            np.subtract(h, n, out=s)
            s *= z
            h = np.add(s, n, out=out[t])
        return out

    def _both(self, x: np.ndarray, kept: list[list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States of the forward reading, and of the backward one in its own order."""
        forward = np.ascontiguousarray(x.T).astype(np.intp)
        return self._direction(forward, 0, None if kept is None else kept[0]), self._direction(forward[::-1], 1, None if kept is None else kept[1])

    def position_probabilities(self, x: np.ndarray) -> np.ndarray:
        """x: B x T bytes; L x T x B.  States are below 1 in size: exp() needs a shift only where V is large."""
        h0, h1 = self._both(x)
        steps, size, width = h0.shape
        shape = (len(self.c), steps, size)
        y = np.dot(self.V[:width].T, h0.reshape(-1, width).T).reshape(shape)
        y += np.dot(self.V[width:].T, h1.reshape(-1, width).T).reshape(shape)[:, ::-1]
        y += self.c[:, None, None]
        if float((np.abs(self.V).sum(axis=0) + np.abs(self.c)).max()) > 80:
            y -= y.max(axis=0)
        np.exp(y, out=y)
        y /= y.sum(axis=0)
        return y

    def document_probabilities(self, texts: list[bytes]) -> np.ndarray:
        """n x L: the mean over all positions of each text; zeros for the empty text."""
        sums, counts = np.zeros((len(texts), len(self.languages))), np.array([len(t) for t in texts])
        owner, size, parts = [], [], []
        for i, text in enumerate(texts):
            full = -(-len(text) // SEGMENT)
            owner += [i] * full
            size += [SEGMENT] * (full - 1) + [len(text) - SEGMENT * (full - 1)] * (full > 0)
            parts.append(text.ljust(full * SEGMENT, b"\0"))
        if owner:
            data = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, SEGMENT)
            own, length = np.array(owner), np.array(size)
            for at in range(0, len(data), BATCH):
                x, n = data[at : at + BATCH].astype(np.int16), length[at : at + BATCH]
                short = n < SEGMENT
                x[short] = np.where(np.arange(SEGMENT)[None, :] < n[short][:, None], x[short], 256)
                y = self.position_probabilities(x)
                y[:, :, short] *= np.arange(SEGMENT)[:, None] < n[short][None, :]
                each = y.sum(axis=1)
                for k in range(len(each)):
                    sums[:, k] += np.bincount(own[at : at + BATCH], each[k], len(texts))
        return sums / np.maximum(counts, 1)[:, None]

    def step(self, x: np.ndarray, real: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and gradients by backpropagation through time.  x: B x T, real: B x T, label: B."""
        kept: list[list] = [[], []]
        h0, h1 = self._both(x, kept)
        forward = np.ascontiguousarray(x.T)
        h = np.concatenate([h0, h1[::-1]], axis=2)
        y = h @ self.V + self.c
        y -= y.max(axis=2, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(axis=2, keepdims=True)
        weight = (real.T / real.sum()).astype(np.float32)
        here = np.arange(len(label))
        loss = float(-(np.log(y[:, here, label] + 1e-9) * weight).sum())
        y[:, here, label] -= 1
        y *= weight[..., None]
        width = h0.shape[2]
        dV, dc = np.tensordot(h, y, axes=([0, 1], [0, 1])), y.sum(axis=(0, 1))
        dh = y @ self.V.T
        dW, dU = np.zeros_like(self.W), np.zeros_like(self.U)
        for d in range(2):
            seq, outer = (forward, dh[..., :width]) if d == 0 else (forward[::-1], dh[::-1, :, width:])
            U, back = self.U[d], np.zeros_like(h0[0])
            for t in range(len(seq) - 1, -1, -1):
                before, r, z, n, a = kept[d][t]
                g = outer[t] + back
                dn = g * (1 - z) * (1 - np.abs(n)) ** 2
                dz = g * (before - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
                dr = dn * a * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
                da = dn * r
                back = g * z + dr @ U[0].T + dz @ U[1].T + da @ U[2].T
                for gate, grad, inner in ((0, dr, dr), (1, dz, dz), (2, dn, da)):
                    np.add.at(dW[d, gate], seq[t], grad)
                    dU[d, gate] += before.T @ inner
        return loss, [dW, dU, dV, dc]


def train(samples: list[tuple[str, bytes]], bounds: TrainingBounds = TrainingBounds()) -> BiGru | None:
    """samples: (language, bytes).  None if there are none."""
    languages = sorted({lang for lang, _ in samples})
    if not languages:
        return None
    rng, number = np.random.default_rng(bounds.seed), {x: i for i, x in enumerate(languages)}
    parts: list[list[bytes]] = [[] for _ in languages]
    for lang, text in samples:
        starts = range(0, max(1, len(text) - SEGMENT // 2), SEGMENT)
        chosen = starts if len(starts) <= bounds.segments else sorted(rng.choice(len(starts), bounds.segments, replace=False) * SEGMENT)
        parts[number[lang]] += [text[s : s + SEGMENT] for s in chosen if text[s : s + SEGMENT]]
    model = BiGru(languages, seed=bounds.seed)
    if len(languages) == 1 or not all(parts):
        return model
    moment = [(np.zeros_like(w), np.zeros_like(w)) for w in model.weights()]
    each = max(1, bounds.batch // len(languages))
    for k in range(1, bounds.steps + 1):
        label = np.repeat(np.arange(len(languages)), each)
        texts = [parts[i][j] for i in range(len(languages)) for j in rng.integers(0, len(parts[i]), each)]
        x, real = np.full((len(texts), SEGMENT), 256, np.int16), np.zeros((len(texts), SEGMENT), bool)
        for i, t in enumerate(texts):
            x[i, : len(t)] = np.frombuffer(t, np.uint8)
            real[i, : len(t)] = True
        _, grads = model.step(x, real, label)
        rate = bounds.rate * min(1.0, 4 * (1 - (k - 1) / bounds.steps))
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        for w, g, (m, v) in zip(model.weights(), grads, moment, strict=True):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 is 0; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, bounds: TrainingBounds = TrainingBounds(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, bytes]]:
    """At most bounds.documents labelled documents of each language, the first by the hash of their id.

    Their number is counted first (without texts); of a language with many, only a share of the hashes that is expected to
    hold 2.5 times as many is looked at.  What reaches the driver is cut to segments: bounds.documents * languages *
    bounds.segments * SEGMENT bytes at most.  More than bounds.languages languages are an error.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"), F.col(f"`{lang_col}`").alias("l"))
    rows = rows.where(~held_out(F.col("i")) & F.col("l").isNotNull() & F.col("t").isNotNull()).withColumn("h", F.xxhash64(F.col("i"), F.lit(bounds.seed)).bitwiseAND(F.lit((1 << 30) - 1)))
    counts = {r.l: r.n for r in rows.groupBy("l").agg(F.count("*").alias("n")).limit(bounds.languages + 1).collect()}
    if not counts:
        return []
    if len(counts) > bounds.languages:
        raise ValueError(f"more than {bounds.languages} languages")
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int((1 << 30) * min(1.0, 2.5 * (bounds.documents + 20) / n)))])
    few = rows.where(F.col("h") <= F.element_at(share, F.col("l"))).select("i", "l", "h", F.encode("t", "UTF-8").alias("b"))
    # whole segments spread over the text, the same number from each document
    last = F.greatest(F.floor((F.octet_length("b") - F.lit(1)) / F.lit(SEGMENT)), F.lit(0))
    spots = F.transform(F.sequence(F.lit(0), F.lit(bounds.segments - 1)), lambda k: F.floor(last * (k * 2 + 1) / (2 * bounds.segments)))
    cut = F.transform(F.array_distinct(spots), lambda s: F.col("b").substr((s * SEGMENT + 1).cast("int"), F.lit(SEGMENT)))
    ranked = few.select("i", "l", "h", cut.alias("parts")).withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("h", "i")))
    return [(r.l, bytes(p)) for r in ranked.where(F.col("k") <= bounds.documents).orderBy("l", "k").collect() for p in r.parts if p]


def fit(docs: DataFrame, bounds: TrainingBounds = TrainingBounds(), **names) -> BiGru | None:
    return train(training_sample(docs, bounds, **names), bounds)


@lru_cache(maxsize=1)
def _letter():
    import regex

    return regex.compile(r"\p{L}")


def predictions(text: Column, model: BiGru | None) -> Column:
    """struct<lang_pred, score>."""

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def run(texts):
        import pandas as pd

        letter, names, scores = _letter(), [UNKNOWN] * len(texts), [0.0] * len(texts)
        if model is not None:
            known = [i for i, t in enumerate(texts) if t is not None and letter.search(t)]
            for at, to in parts_by_size([texts.iloc[i] for i in known], 256):
                part = known[at:to]
                y = model.document_probabilities([texts.iloc[i].encode() for i in part])
                for i, p in zip(part, y, strict=True):
                    names[i], scores[i] = model.languages[int(p.argmax())], float(min(1.0, max(0.0, p.max())))
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return run(text)


def identify(docs: DataFrame, model: BiGru | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row of docs."""
    one = bounded_batches(docs).select(F.col(f"`{id_col}`").alias("doc_id"), predictions(F.col(f"`{text_col}`"), model).alias("p"))
    return one.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred", "p.score")


def keep_recognised(docs: DataFrame, model: BiGru | None, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text has a language, with a mean probability of least_score or more."""
    p = free_name(docs, "language")
    judged = bounded_batches(docs).withColumn(p, predictions(F.col(f"`{text_col}`"), model))
    return judged.where((F.col(p)["lang_pred"] != UNKNOWN) & (F.col(p)["score"] >= least_score)).drop(p)
