"""Edge cases: near-duplicates by similarity against brute force, long and odd words, memory bounds, the shared folder."""

import base64
import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import bpe, common, secret_scan, similar, simhash, word_ids

random.seed(5)
SCHEMA = "doc_id long, text string, __row long, __signature string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, 1, "clash") for i, t in enumerate(texts)], SCHEMA)


def brute_kept(texts, least=0.8):
    """Least number of each component of texts whose five-word shingle sets are similar."""
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both and both >= least * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return sorted({root(i) for i in range(len(texts))})


def near_copies():
    out = [None, "", " ", "one", "One", "two words"]
    for _ in range(12):
        base = ["".join(random.choice("abcdefgh") for _ in range(4)) for _ in range(random.randint(30, 300))]
        out.append(" ".join(base))
        for k in range(random.randint(0, 5)):
            other = list(base)
            for _ in range(k):
                other[random.randrange(len(other))] = "x" + str(random.randrange(10**6))
            out.append(" ".join(other))
    random.shuffle(out)
    return out * 2


@pytest.mark.parametrize("few", [500_000, 0])
def test_keep_one_by_similarity(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW_ROWS", few)  # broadcast, or joined as any other table
    texts = near_copies()
    df = docs(spark, texts)
    kept = simhash.keep_one(df, similarity=0.8)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(texts)


def test_close_sets():
    rng = np.random.default_rng(3)
    some = [np.unique(rng.integers(0, 40, n).astype(np.uint32)) for n in rng.integers(1, 80, 60)]
    for one, near in zip(some[:20], similar.close_sets(some[:20], some, 0.8), strict=True):
        true = [j for j, o in enumerate(some) if len(set(one) & set(o)) >= 0.8 * len(set(one) | set(o))]
        assert near.tolist() == true


def test_keep_one_in_a_large_group_of_near_copies(spark, monkeypatch):
    """One bucket holds most texts: blocks of a few sets, several windows, a body and texts that link to nothing."""
    for name, value in {"SMALL": 2, "WINDOW": 3, "BLOCK": 5}.items():
        monkeypatch.setattr(similar, name, value)
    rng, base = random.Random(11), [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(220):
        words = base[: rng.choice((150, 150, 100))]
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"other{rng.randrange(9999)}"
        texts.append(" ".join(words))
    assert sorted(r.doc_id for r in simhash.keep_one(docs(spark, texts), similarity=0.8).collect()) == (want := brute_kept(texts))
    assert 20 < len(want) < 200


def test_keep_one_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d e f g"), (7, "a b c d e f g"), (None, "lone text here"), (None, "lone text here")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.text) for r in simhash.keep_one(df, similarity=0.8).collect()), key=str) == [(7, "a b c d e f g"), (None, "lone text here")]
    assert simhash.keep_one(df.limit(0), similarity=0.8).count() == 0


def test_shingle_hashes():
    words = [f"w{i}" for i in range(3000)]
    one = similar.shingle_hashes(" ".join(words))
    assert len(one) == 2996 == len(set(one.tolist()))
    again = similar.shingle_hashes("X y " + " ".join(words[100:200]).upper())
    assert set(one[100:196].tolist()) == set(again[2:].tolist()) and not set(again[:2].tolist()) & set(one.tolist())
    bits = np.unpackbits(one.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1).mean(axis=0)
    assert (abs(bits - 0.5) < 0.05).all()
    assert len(similar.shingle_hashes("a b")) == 1 and similar.shingle_hashes("a b")[0] != similar.shingle_hashes("a b c")[0]


LONG_WORDS = [
    "x" + "<|endoftext|>" * 5000,
    "<|startoftext|>" * 3 + "a<|endoftext|",
    "".join(random.choice("abcdefghij") for _ in range(20_000)),
    base64.b64encode(random.randbytes(20_000)).decode(),
    "a" * 20_000,
    "international" * 2000,
    "éßİ" * 3000,
    "!?-" * 5000,
]


def test_long_words_like_the_library():
    path = word_ids.default_tokenizer()
    one, two = bpe.ForcedBoundaryBpe(path), word_ids.WordIds(path)
    for word in LONG_WORDS:
        ids = two.tokenizer.encode(word, add_special_tokens=False).ids
        assert one.encode(word).tolist() == ids
        assert np.frombuffer(two.encode(word), "<u4").tolist() == ids
    assert not any(len(w) > 64 for memo in (one.words, one.final, two.words) for w in memo)


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.ForcedBoundaryBpe(public_tokenizers.path("byte_bpe_50k.json"))
    with pytest.raises(ValueError):
        word_ids.WordIds(public_tokenizers.path("byte_bpe_50k.json"))


def test_slices_by_bytes():
    texts = ["a" * 100, None, "b" * 5000, "", "é" * 10, "c" * 200]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["doc_id", "text"])
    parts = [p.column(1).to_pylist() for p in common.slices(batch, most=300)]
    assert [t for p in parts for t in p] == texts and all(len(p) == 1 or sum(len((t or "").encode()) for t in p) <= 300 for p in parts) and len(parts) == 3
    assert [len(p.column(0)) for p in common.slices(batch, rows=4)] == [4, 2] and not list(common.slices(batch.slice(0, 0)))
    assert [texts[a:b] for a, b in common.parts_by_size(texts, most=300)] == [texts[:2], texts[2:3], texts[3:]] and not list(common.parts_by_size([]))
    lists = pa.RecordBatch.from_arrays([pa.array(range(3)), pa.array([[1, 2], None, []])], ["doc_id", "ids"])
    assert [p.num_rows for p in common.slices(lists, most=1)] == [1, 2]


def test_batches_are_bounded(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    from pyspark.sql import functions as F

    big = common.bounded_batches(spark.range(512).coalesce(1).select(F.repeat(F.lit("x"), 100_000).alias("t")))
    assert max(r.n for r in big.mapInArrow(sizes, "n long").collect()) <= common.BATCH_BYTES + 200_000


def test_secret_postings_over_chunks(monkeypatch):
    texts = ["x" * 50 + " AKIA" + "Q" * 20, None or "", "password = hunter2hunter2", "z" * 300 + " token: abcdefgh"]
    one = secret_scan.Scanner()
    whole = one.postings(texts)
    monkeypatch.setattr(secret_scan, "SCANNED", 7)
    parts = one.postings(texts)
    assert {k: v.tolist() for k, v in whole.items()} == {k: v.tolist() for k, v in parts.items()} and whole


def test_shared_folder(spark, monkeypatch):
    class Cluster:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Cluster()
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})()

    with pytest.raises(ValueError):
        common.ensure_checkpoint_dir(Session())
    table, path = common.spilled(spark.range(3), "x")
    assert table.count() == 3 and path in common._MADE
    common.remove(spark, path)
    assert path not in common._MADE
    with pytest.raises(Exception):
        spark.read.parquet(path)
