"""BPE encoding and decoding with forced boundaries.

A pair of neighbouring bytes that stands inside no token of the vocabulary can never be inside a token of an
encoded text either, so a cut between the two is certain.  Each pre-token is cut at all such pairs; the fragments
are encoded independently by the merge ranks and their ids concatenated.  Only the last fragment of a pre-token
carries the end-of-word suffix.  Fragments and words repeat, so workers remember them (bounded).

Normalization and pre-tokenization are rules of the tokenizer file; words outside the plain alphabet are
normalized and cut by the library's own components, then encoded here in the same way.

Merges of a short fragment look for the lowest rank again and again; those of a long one keep a heap of pairs over a linked
list of parts, so that the time grows with the fragment and not with its square.  Only short words are remembered.

Defined results: null text is the empty text (no ids, decoded to the empty text); special tokens inside a text
give their own ids, however many there are; repeated rows are rows of their own; an empty table gives no rows; a tokenizer
file with other rules than the known ones is an error.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from heapq import heapify, heappop, heappush
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .common import bounded_batches, doc_text, slices
from .word_ids import PIECE, PLAIN, Remembered, check_rules, default_tokenizer, to_byte_chars, words_of

#: Fragments of more parts are merged with a heap.
LONG = 48


class ForcedBoundaryBpe:
    def __init__(self, path: str, words: int = 250_000, fragments: int = 400_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check_rules(spec)
        model = spec["model"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cuts = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.inside = self._pairs_inside(self.vocab)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.fragments, self.final = Remembered(self._merge, fragments // 4), Remembered(self._merge_final, fragments)
        self.words = Remembered(self._word, words)
        self.decimal = {i: str(i) for i in self.tokens}

    def _pairs_inside(self, vocab) -> set[str]:
        """Pairs of byte characters that some token holds; the suffix is no bytes."""
        pairs: set[str] = set()
        for token in vocab:
            body = token.removesuffix(self.suffix) if self.suffix else token
            pairs.update(body[i : i + 2] for i in range(len(body) - 1))
        return pairs

    def cut(self, piece: str) -> list[str]:
        """The fragments between forced boundaries."""
        out, start = [], 0
        for i in range(1, len(piece)):
            if piece[i - 1 : i + 1] not in self.inside:
                out.append(piece[start:i])
                start = i
        out.append(piece[start:])
        return out

    def _merge(self, fragment: str) -> bytes:
        return self._by_rank(list(fragment))

    def _merge_final(self, fragment: str) -> bytes:
        return self._by_rank([*fragment[:-1], fragment[-1] + self.suffix])

    def _by_rank(self, parts: list[str]) -> bytes:
        ranks, none = self.ranks, len(self.ranks)
        if len(parts) > LONG:
            parts = self._merge_long(parts)
            vocab = self.vocab
            return array("I", [vocab[p] for p in parts if p in vocab]).tobytes()
        order = [ranks.get(p, none) for p in zip(parts, parts[1:], strict=False)]
        while order and (low := min(order)) < none:
            i = order.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del order[i]
            if i < len(order):
                order[i] = ranks.get((parts[i], parts[i + 1]), none)
            if i:
                order[i - 1] = ranks.get((parts[i - 1], parts[i]), none)
        vocab = self.vocab
        return array("I", [vocab[p] for p in parts if p in vocab]).tobytes()

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The parts after all merges, lowest rank first and leftmost of equal ranks.  A heap entry is rank and place in one number."""
        get, n = self.ranks.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 40 | i for i, p in enumerate(zip(parts, parts[1:], strict=False)) if (r := get(p)) is not None]
        heapify(heap)
        place = (1 << 40) - 1
        while heap:
            entry = heappop(heap)
            i = entry & place
            j, left = after[i], parts[i]
            if left is None or j >= n or get((left, parts[j])) != entry >> 40:
                continue  # one of the two is another part by now
            left = parts[i] = left + parts[j]
            parts[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := get((left, parts[k]))) is not None:
                    heappush(heap, r << 40 | i)
            h = before[i]
            if h >= 0 and (r := get((parts[h], left))) is not None:
                heappush(heap, r << 40 | h)
        return [p for p in parts if p is not None]

    def _piece(self, piece: str) -> bytes:
        *some, last = self.cut(piece)
        return b"".join([*(self.fragments[f] for f in some), self.final[last]])

    def _word(self, word: str) -> bytes:
        out, at = [], 0
        for m in self.cuts.finditer(word) if "<|" in word else ():
            out += [self._plain(word[at : m.start()]), array("I", [self.special[m[0]]]).tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(word[at:])]) if out else self._plain(word)

    def _plain(self, word: str) -> bytes:
        """Ids of a word without special tokens."""
        if PLAIN.fullmatch(word):
            pieces = map(to_byte_chars, PIECE.findall(word.lower()))
        else:
            pieces = (p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(word)))
        return b"".join([self._piece(p) for p in pieces if p])

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.words.__getitem__, words_of(text))), "<u4")

    def decode(self, ids) -> str:
        """The file names no decoder: tokens are joined by one space; unknown ids are left out."""
        try:
            return " ".join(map(self.tokens.__getitem__, ids))
        except KeyError:
            return " ".join([self.tokens[i] for i in ids if i in self.tokens])


@lru_cache(maxsize=1)
def codec(path: str) -> ForcedBoundaryBpe:
    return ForcedBoundaryBpe(path)


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) for each row."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        import pyarrow as pa

        one = codec(path)
        for batch in batches:
            for part in slices(batch):
                ids = [one.encode(t).astype(np.int32) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return doc_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give a null text."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        import pyarrow as pa

        one = codec(path)
        for batch in batches:
            for part in slices(batch, column=1):
                texts = [None if x is None else one.decode(x) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return bounded_batches(encoded).select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Encode and decode each row in one pass; only the digests of ids and decoded text leave the task."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        import pyarrow as pa

        one = codec(path)
        for batch in batches:
            for part in slices(batch):
                n, ids_sha, text_sha = [], [], []
                for text in part.column(1).to_pylist():
                    ids = one.encode(text).tolist()
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(" ".join(map(one.decimal.__getitem__, ids)).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(one.decode(ids).encode()).hexdigest())
                cols = [part.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return doc_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
