"""Column functions against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


@pytest.mark.parametrize("text,want", [("25-Jan", 2025 * 12), ("25-dec", 2025 * 12 + 11), ("00-FEB", 2000 * 12 + 1), ("25-Jax", None), ("2025-Jan", None), ("Jan-25", None), (None, None), ("25-anf", None)])
def test_parse_period(spark, text, want):
    assert one(spark, C.parse_period(F.lit(text).cast("string")))[0] == want


@pytest.mark.parametrize("text,want", [(" A b\t", "a b"), ("", C.MISSING), (None, C.MISSING), (" \n", C.MISSING), ("ÉTÉ", "été")])
def test_canonical_category(spark, text, want):
    assert one(spark, C.canonical_category(F.lit(text).cast("string")))[0] == want


def test_labels_and_numbers(spark):
    row = one(spark, *[C.lenient_label(F.lit(x)) for x in ("Yes", "n", "1.0", "0", "2", "x")], *[C.number(F.lit(x)) for x in ("1.5", "x", "NaN")])
    assert list(row) == [1, 0, 1, 0, None, None, 1.5, None, None]
    with pytest.raises(Exception, match="neither Yes nor No"):
        one(spark, C.yes_no(F.lit("maybe"), strict=True))


def test_buckets_and_histogram(spark):
    edges = [0.0, 1.0, 2.0, 4.0]
    values = [-1.0, 0.0, 0.5, 1.0, 2.0, 3.9, 4.0, 5.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", C.histogram_bin(F.col("v"), C.array_of(edges)).alias("b"))
    counts = np.zeros(3, int)
    for r in df.collect():
        if r.b is not None:
            counts[r.b] += 1
    assert counts.tolist() == np.histogram(values, bins=edges)[0].tolist()
    assert [one(spark, C.right_closed_bucket(F.lit(v), C.array_of([1.0, 2.0])))[0] for v in (0.0, 1.0, 1.5, 2.0, 3.0)] == [0, 0, 1, 1, 2]


def test_interpolation_equals_numpy(spark):
    knots, heights = [0.0, 1.0, 3.0, 10.0], [0.1, 0.4, 0.5, 1.0]
    values = [-5.0, 0.0, 0.25, 1.0, 2.9, 3.0, 9.0, 10.0, 11.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(C.interpolate(F.col("v"), C.array_of(knots), C.array_of(heights))).collect()]
    assert np.allclose(got, np.interp(values, knots, heights), rtol=0, atol=1e-15)


def test_small_helpers(spark):
    row = one(spark, C.shares(C.array_of([1, 3])), C.shares(C.array_of([0, 0])), C.bin_centres(C.array_of([0, 2, 4])), C.linspace(F.lit(0.0), F.lit(1.0), 5), C.title_case(F.lit("keep_drifted")), C.finite_or_zero(F.lit(math.inf)))
    assert list(row) == [[0.25, 0.75], [0.0, 0.0], [1.0, 3.0], [0.0, 0.25, 0.5, 0.75, 1.0], "Keep Drifted", 0.0]
    assert one(spark, C.block_label(F.array(F.lit("25-Jan"))), C.block_label(F.array(F.lit("25-Jan"), F.lit("25-Feb"))))[1] == "25-Jan–25-Feb"
