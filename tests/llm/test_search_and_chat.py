"""Curve search against brute force, preference formatting against plain Python, and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import curves, preference_chat


def test_hilbert_curve_takes_single_steps():
    for bits, dims in ((3, 2), (2, 3), (2, 4)):
        points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        keys = curves.hilbert_keys(points, bits)
        assert sorted(keys.tolist()) == list(range(len(points)))
        assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def brute(ids, x, k):
    out = {}
    for i in sorted({i for i in ids if i is not None and i % 20 == 0}):
        q = x[ids.index(i)]
        best = sorted((-float(np.dot(x[j], q)), ids[j]) for j in range(len(ids)) if ids[j] != i)
        out[i] = [b for _, b in best[:k]]
    return out


def test_recall_on_clusters(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 16))
    x = (centres[rng.integers(0, 30, 1500)] + 0.15 * rng.normal(size=(1500, 16))).astype(np.float32).astype(float)
    ids = list(range(1500))
    df = spark.createDataFrame([(i, v.tolist(), 0, 1.0) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>, label int, score double")
    got = {}
    for r in curves.nearest_neighbours(df, 10, curves.CurveSettings(block=128)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(ids, x, 10)
    assert set(got) == set(want) and all(sorted(r for r, _, _ in v) == list(range(1, 11)) for v in got.values())
    assert np.mean([len({v for _, v, _ in got[q]} & set(want[q])) / 10 for q in want]) >= 0.9
    for q in list(got)[:5]:
        for _, v, s in got[q]:
            assert s == pytest.approx(float(np.dot(x[v], x[q])), abs=1e-9)


def test_copies_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, (200, 4)).astype(float)
    x[(x == 0).all(axis=1)] = 1.0
    x[50:150] = x[0]  # half of the rows are copies
    ids = list(range(200))
    rows = [(i, v.tolist()) for i, v in zip(ids, x, strict=True)]
    rows += [(1000, None), (1020, [0.0] * 4), (1040, [1.0, None, 1.0, 1.0]), (1060, [float("nan")] * 4), (1080, [float("inf"), 0.0, 0.0, 0.0]), (1100, [1.0]), (None, [1.0] * 4), rows[7]]
    got = {}
    for r in curves.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == brute(ids, x, 5)


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = curves.nearest_neighbours(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], schema), 20).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in few] == [(0, 1, 1, 0.5), (0, 2, 2, 0.0)]
    assert curves.nearest_neighbours(spark.createDataFrame([], schema)).count() == 0
    assert curves.nearest_neighbours(spark.createDataFrame([(0, [1.0])], schema)).count() == 0


TURNS = "pair_id long, turn long, role string, text string, extra int"


def plain(chosen, rejected):
    """By hand: prompt, completions and loss spans."""
    sides = [sorted(((t, r or "user", x or "") for _, t, r, x, _ in side), key=lambda y: (y[0] is not None, y[0] or 0, *y[1:])) for side in (chosen, rejected)]
    common = 0
    while common < min(map(len, sides)) and sides[0][common][1:] == sides[1][common][1:]:
        common += 1
    render = lambda turns: "".join(f"<|{r}|>\n{x}<|end|>\n" for _, r, x in turns)
    loss = []
    for side in sides:
        at, spans = 0, []
        for _, r, x in side[common:]:
            head, body = len(f"<|{r}|>\n"), len(f"{x}<|end|>\n")
            if r == "assistant":
                spans.append((at + head, at + head + body))
            at += head + body
        loss.append(spans)
    return render(sides[0][:common] if sides[0] else []), render(sides[0][common:]), render(sides[1][common:]), *loss


def test_preferences_equal_plain_python(spark):
    pairs = {
        1: ([(1, 0, "user", "hi", 0), (1, 1, "assistant", "yes", 0)], [(1, 0, "user", "hi", 0), (1, 1, "assistant", "no", 0)]),
        2: ([(2, 0, "system", "s", 0), (2, 1, "user", None, 0), (2, 2, None, "x", 0)], [(2, 0, "system", "s", 0), (2, 1, "user", "", 0), (2, 2, "user", "x", 0)]),
        3: ([(3, 5, "user", "a", 0), (3, None, "user", "first", 0)], [(3, 5, "user", "b", 0), (3, 6, "assistant", "c", 0), (3, 7, "user", "d", 0), (3, 8, "assistant", "é", 0)]),
        4: ([(4, i, "user" if i % 2 == 0 else "assistant", f"t{i}", 0) for i in range(700)], [(4, i, "user" if i % 2 == 0 else "assistant", f"t{i}" if i < 601 else "new", 0) for i in range(640)]),
        5: ([(5, 0, "user", "same", 0), (5, 0, "user", "same", 0)], [(5, 0, "user", "same", 0)]),
        6: ([(6, 0, "user", "only chosen", 0)], []),
    }
    frame = lambda k: spark.createDataFrame([*(row for p in pairs.values() for row in p[k]), (None, 0, "user", "no pair", 0)], TURNS)
    segments = preference_chat.format_pairs(frame(0), frame(1))
    got = {r.pair_id: r for r in preference_chat.assemble(segments).collect()}
    assert set(got) == set(pairs)
    for k, (c, r) in pairs.items():
        prompt, chosen, rejected, c_loss, r_loss = plain(c, r)
        assert (got[k].prompt, got[k].chosen, got[k].rejected) == (prompt, chosen, rejected), k
        assert [tuple(x) for x in got[k].chosen_loss or []] == c_loss and [tuple(x) for x in got[k].rejected_loss or []] == r_loss
    assert preference_chat.format_pairs(frame(0).limit(0), frame(1).limit(0)).count() == 0


def test_last_reply_sides(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "user", "r"), (1, 3, "assistant", "a2"), (1, 4, "user", "end"), (2, 0, "user", "q"), (2, 1, "assistant", "a"), (3, 0, "user", "alone"), (None, 0, "user", "x"), (4, None, "assistant", "lost"), (4, 0, "user", "q"), (4, 1, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in preference_chat.assemble(preference_chat.format_sides(preference_chat.last_reply_sides(df))).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[1].chosen == "<|assistant|>\na2<|end|>\n<|user|>\nend<|end|>\n" and got[1].rejected == "<|assistant|>\na1<|end|>\n<|user|>\nend<|end|>\n" and got[1].prompt.endswith("r<|end|>\n")
    assert [tuple(x) for x in got[1].chosen_loss] == [(14, 24)]
    assert got[2].rejected == "<|assistant|>\nq<|end|>\n"
    assert (got[3].prompt, got[3].chosen, got[3].rejected) == ("<|user|>\nalone<|end|>\n", "", "")
    assert got[4].prompt.startswith("<|assistant|>\nlost<|end|>\n") and got[4].chosen == "<|assistant|>\na<|end|>\n"
    repeated = preference_chat.format_sides(preference_chat.last_reply_sides(df.union(df))).where("part = 'prompt' AND pair_id = 3").count()
    assert repeated == 4 and preference_chat.format_sides(preference_chat.last_reply_sides(df.limit(0))).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    rng = np.random.default_rng(4)
    words = {"aa": "bada gabo dabu agoda bagu dogu".split(), "oo": "xizo wizy yxiz zowix wyzo iziw".split()}
    text = lambda lang: " ".join(f"{w}{'' if rng.random() < 0.6 else rng.choice(words[lang])}" for w in rng.choice(words[lang], 60))
    rows = [(i, text(lang), lang, "s", 0) for i, lang in enumerate(["aa", "oo"] * 40)]
    rows[10] = (10, rows[9][1], "oo", "s", 0)  # a copy
    rows += [(100, "12345 678", None, "s", 0), (101, "bada", "aa", "s", 0), (102, rows[0][1] + " password=hunter2222", "aa", "s", 0), (103, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    columns, seen = docs.columns, {}
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == columns, name
        docs = docs.cache()
        seen[name] = {r.doc_id for r in docs.collect()}
    first, second, third, fourth = seen.values()
    assert 100 not in first and 103 not in first and 101 in first and 101 not in second
    assert 9 in third and 10 not in third and fourth == third
    for r in docs.collect():
        assert "hunter2222" not in r.text and r.n_chars == len(r.text)
    assert {r.doc_id for r in P.STAGES[-1][1](spark, docs, "").collect()} == fourth
    assert docs.where(F.col("doc_id") == 1).count() == 1
