"""Packing, BPE and token plane files: against the tokenizers library, and exact round trips."""

import hashlib
import io
import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing, token_planes
from tidemark.llm.common import shared_path
from tidemark.llm.word_ids import default_tokenizer, encoder

ODD = [
    "", " ", "a\x1cb", "É́ éx ΣΑΣ İ <|endoftext|>x<|startoftext|>", "don't I'LL x's'ss ½²٣ ǅ 中文字　a b c", "a" * 5000, "<|endoftext|", "ſ K µª", "\U0001f600👍🏽 ‍ x",
    "́a", "'' ''s 12a3", "x\ty\nz\r\n", "tiñ ê###!!$$$ Çà", "the the the", "é é 가",
]
SCHEMA = "doc_id long, text string, start string, LENGTH int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], SCHEMA)


def test_both_encoders_equal_the_library(library):
    words, own = encoder(default_tokenizer()), bpe.codec(default_tokenizer())
    for text in ODD:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text), "<u4").tolist() == want, text
        assert own.encode(text).tolist() == want, text
        assert own.decode(want) == library.decode(want, skip_special_tokens=False), text


def test_forced_boundaries_are_certain():
    one = bpe.codec(default_tokenizer())
    for piece in ("internationalization", "zqxjkv", "Ã©Ã§Ã", "a"):
        assert "".join(one.cut(piece)) == piece
        assert one._piece(piece) == one._by_rank([*piece[:-1], piece[-1] + one.suffix])


def test_small_memory_gives_the_same(library):
    one = bpe.ForcedBoundaryBpe(default_tokenizer(), words=3, fragments=8)
    text = "many different words, many many different ones and again many words"
    assert one.encode(text).tolist() == one.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_frames(spark, library):
    rows = {r.doc_id: r for r in bpe.digests(docs(spark, [*ODD, None])).collect()}
    for i, text in enumerate([*ODD, None]):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs(spark, ODD)))
    assert {r.doc_id: r.text for r in back.collect()}[14] == library.decode(library.encode(ODD[14], add_special_tokens=False).ids, skip_special_tokens=False)
    assert bpe.digests(docs(spark, [])).count() == 0


def check_pieces(rows, want, limits):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, ids in want.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(parts) <= limits.segments and sum(r.loss_tokens for r in parts) <= limits.loss_tokens
        padding += limits.tokens - at
    return padding, len(by_sequence)


def test_packing(spark, library):
    rng = np.random.default_rng(3)
    texts = [*ODD, None, *[" ".join(["word"] * int(n)) for n in rng.integers(1, 3000, 120)]]
    limits = packing.Limits()
    rows = packing.pack(docs(spark, texts), limits).collect()
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    padding, n = check_pieces(rows, want, limits)
    assert padding <= 2048 * 4 and padding < 0.15 * 2048 * n  # a short sequence for each task at most
    assert packing.pack(docs(spark, [])).count() == 0
    twice = docs(spark, ["one two"]).union(docs(spark, ["one two"]))
    assert packing.pack(twice).count() == 2
    with_ids = packing.pack(docs(spark, ["one two"]), keep_ids=True).first()
    assert with_ids.ids == want_ids(library, "one two")


def want_ids(library, text):
    return [*library.encode(text, add_special_tokens=False).ids, 1]


def test_pack_masks_prompts(spark):
    """The loss limit binds by a column of prompt lengths."""
    df = docs(spark, ["one two three four five six seven eight"] * 40).selectExpr("*", "IF(doc_id % 4 = 0, NULL, CAST(doc_id % 4 * 3 AS INT)) AS n_prompt").coalesce(1)
    limits = packing.Limits(64, 100, 20)
    rows = packing.pack(df, limits, prompt_col="n_prompt").collect()
    tokens, loss = defaultdict(int), defaultdict(int)
    for r in rows:
        tokens[r.sequence_id] += r.length
        loss[r.sequence_id] += r.loss_tokens
        prompt = r.doc_id % 4 * 3
        assert r.loss_tokens == r.length - min(r.length, max(0, prompt - r.start))
    assert max(tokens.values()) <= 64 and max(loss.values()) == 20 and max(tokens.values()) > 20
    total = sum({r.doc_id: r.doc_tokens for r in rows}.values())
    assert sum(tokens.values()) == total > sum(loss.values())


@pytest.mark.parametrize("limits", [packing.Limits(64, 3, 64), packing.Limits(64, 100, 20), packing.Limits(100, 4, 50)])
def test_packer_keeps_all_three_limits(limits):
    rng = np.random.default_rng(1)
    items = [(i, int(n), int(rng.integers(0, n + 1))) for i, n in enumerate(rng.integers(1, 200, 300))]
    out = []
    packer = packing.Packer(lambda *a: out.append(a), limits, window=16)
    for item in items:
        packer.add(*item)
    packer.flush()
    covered, used = defaultdict(list), defaultdict(lambda: [0, 0, 0])
    for key, start, length, sequence, offset, _, loss in out:
        covered[key] += range(start, start + length)
        assert used[sequence][0] == offset and loss == length - min(length, max(0, items[key][2] - start))
        used[sequence] = [used[sequence][0] + length, used[sequence][1] + 1, used[sequence][2] + loss]
    assert all(sorted(covered[i]) == list(range(n)) for i, n, _ in items)
    assert all(t <= limits.tokens and s <= limits.segments and x <= limits.loss_tokens for t, s, x in used.values())


@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(n, bits):
    ids = np.random.default_rng(n).integers(0, 2**32 if n == 8 else 50000, n).astype("<u4")
    assert np.array_equal(token_planes.join_planes(token_planes.split_planes(ids, bits), n, bits), ids)


class Source(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def test_file_round_trip():
    stream, rng = io.BytesIO(), np.random.default_rng(0)
    writer = token_planes.Writer(stream, block=64)
    docs_ = [(None, 3), (-5, 0), (1, 200), (1, 64), (9, 1)]
    ids = [rng.integers(0, 50000, n).astype("<u4") for _, n in docs_]
    for (doc, _), x in zip(docs_, ids, strict=True):
        writer.add(doc, x.tobytes())
    writer.close()
    got = list(token_planes.Reader(Source(stream.getvalue())).documents())
    assert [(d, len(x)) for d, _, x in got] == docs_ and all(np.array_equal(a, b) for (_, _, a), b in zip(got, ids, strict=True))
    with pytest.raises(ValueError):
        token_planes.Reader(Source(b"x" * 100))


def test_token_planes_frames(spark, library):
    texts = [*ODD, None, "same", "same"]
    df = docs(spark, texts).union(spark.createDataFrame([(None, "null id", "", 0), (14, ODD[14], "", 0)], SCHEMA)).repartition(3)
    rows = token_planes.round_trip(df).collect()
    order = sorted(rows, key=lambda r: (r.start, r.n_tokens))
    at = 0
    for r in order:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in order][0] is None and [r.doc_id for r in order][1:] == sorted([*range(len(texts)), 14])
    for r in rows:
        if r.doc_id is not None:
            ids = [*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
            assert r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert token_planes.round_trip(docs(spark, [])).count() == 0


def test_shards_are_whole_files(spark):
    folder = shared_path(spark, "test-shards")
    shards = token_planes.write(docs(spark, ODD), folder, partitions=3)
    names = sorted(os.listdir(folder.removeprefix("file://")))
    assert names == sorted(r.path for r in shards.collect()) and not [n for n in names if n.endswith(".tmp")]
