"""Neighbours from products of matrices are those of the plain search, ties, copies and odd vectors included."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import neighbours as K
from tessera.operators import scores


def frames(spark, n=240):
    draw = random.Random(3)
    vectors = [[draw.gauss(0, 1) for _ in range(70)] for _ in range(40)]
    odd = [None, [], [0.0] * 70, [float("nan")] * 70, [1.0, None] + [1.0] * 68, [1.0] * 5]
    rows = [(i * 7 % n, vectors[i % 40] if i % 9 else odd[i // 9 % 6]) for i in range(n)]
    s = spark.createDataFrame(rows, "s_id long, s_vec array<float>").withColumns({"s_fp": K.sign_bits(F.col("s_vec")), "s_label": F.col("s_id") % 2})
    return s.filter("s_id % 4 = 0").toDF("q_id", "q_vec", "q_fp", "q_label"), s


def alike(q, s, score, measure, k, apart, margin, **sizes):
    columns = ["q_id", "s_id", "rank", "s_label"]
    want = K.candidates(q, s, score, k).select(columns).collect()
    got = K.block_candidates(q, s, score, measure, k, apart, margin, **sizes).select(columns).collect()
    assert len(got) == len(want) and set(got) == set(want) and want


@pytest.mark.parametrize("k, sizes", [(1, {}), (6, {"per_block": 20, "asked_at_once": 9}), (300, {})])
@pytest.mark.parametrize("apart", [None, (None, -1.0), (5, -2.0)])
def test_tanimoto(spark, monkeypatch, k, sizes, apart):
    q, s = frames(spark)
    score = K.tanimoto(F.col("q_fp"), F.col("s_fp"))
    if apart:
        m = apart[0] or 10**9
        score = F.when(F.col("q_id") % m == F.col("s_id") % m, apart[1]).otherwise(score)
    alike(q, s, score, scores.Tanimoto("q_fp", "s_fp"), k, apart, 0.0, **sizes)


@pytest.mark.parametrize("k", [1, 6])
def test_cosine(spark, k):
    q, s = frames(spark)
    score = F.when(F.col("q_id") != F.col("s_id"), F.round(K.cosine(F.col("q_vec"), F.col("s_vec")), 9)).otherwise(-2.0)
    alike(q, s, score, scores.Cosine("q_vec", "s_vec"), k, (None, -2.0), 4e-9)


def test_weighted(spark):
    q, s = frames(spark)
    half = lambda df, p: df.withColumns({f"{p}_half": F.transform(f"{p}_fp", lambda x: x.bitwiseAND(0xFFFFFFFF)), f"{p}_fp": F.when(F.col(f"{p}_id") % 17 != 0, F.col(f"{p}_fp"))})
    score = F.round(K.weighted_tanimoto(F.col("q_fp"), F.col("s_fp"), F.col("q_half"), F.col("s_half")), 9)
    alike(half(q, "q"), half(s, "s"), score, scores.WeightedTanimoto(scores.Tanimoto("q_fp", "s_fp"), scores.Tanimoto("q_half", "s_half")), 8, None, 4e-9)


def test_only_the_best_leave_a_block(spark):
    """What the plain search shuffles is a row for each pair."""
    q, s = frames(spark)
    cells = lambda df: df.withColumn("cell", F.lit(0))
    near = K.best_of_blocks(cells(q), cells(s), ["cell"], scores.Tanimoto("q_fp", "s_fp"), 3, None, 0.0, 1)
    assert near.count() == 3 * q.count()
