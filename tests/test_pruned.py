"""Neighbours found with popcounts are those of an exhaustive search."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import neighbours as K


def bits(n, words, seed, dense):
    """Fingerprints of very different popcounts, some of them equal, some empty."""
    draw = random.Random(seed)
    for i in range(n):
        p = draw.choice(dense)
        fp = [0] * words
        for b in range(64 * words):
            if draw.random() < p:
                fp[b // 64] |= 1 << (b % 64)
        yield i, [x - (1 << 64) if x >> 63 else x for x in fp]


def frames(spark, words=2, n=400, dense=(0.0, 0.02, 0.1, 0.5, 0.9)):
    rows = list(bits(n, words, words, dense))
    rows += [(1000 + i, fp) for i, fp in rows[:40]]
    sources = spark.createDataFrame(rows, "s_id long, s_fp array<long>").withColumn("s_label", F.col("s_id") % 2)
    return sources.filter("s_id % 20 = 0").toDF("q_id", "q_fp", "q_label"), sources


@pytest.mark.parametrize("k, per_block, asked", [(1, 50_000, 5_000), (10, 30, 7), (500, 50_000, 5_000)])
def test_same_rows_as_all_pairs(spark, k, per_block, asked):
    q, s = frames(spark)
    columns = ["q_id", "q_label", "s_id", "s_label", "rank", "score"]
    want = K.candidates(q, s, K.tanimoto(F.col("q_fp"), F.col("s_fp")), k).select(columns).collect()
    got = K.pruned_candidates(q, s, k, per_block, asked).select(columns).collect()
    assert len(got) == len(want) and set(got) == set(want)


def test_most_pairs_are_ruled_out(spark):
    """Families of near variants: a query's best are its own family, and few other popcounts come near."""
    draw, rows = random.Random(5), []
    for i, fp in bits(60, 4, 7, (0.05, 0.1, 0.2, 0.4, 0.7)):
        for v in range(7):
            flip = [0] * 4
            for b in draw.sample(range(256), 2 if v else 0):
                flip[b // 64] |= 1 << (b % 64)
            words = [(x ^ f) & ((1 << 64) - 1) for x, f in zip(fp, flip)]
            rows.append((10 * i + v, [x - (1 << 64) if x >> 63 else x for x in words]))
    s = spark.createDataFrame(rows, "s_id long, s_fp array<long>")
    q = s.filter("s_id % 20 = 0").toDF("q_id", "q_fp")
    assert K.compared_share(q, s, 5) < 0.65
    got = K.pruned_candidates(q, s, 5).select("q_id", "s_id", "rank").collect()
    assert set(got) == set(K.candidates(q, s, K.tanimoto(F.col("q_fp"), F.col("s_fp")), 5).select("q_id", "s_id", "rank").collect())


def test_no_sources(spark):
    q, s = frames(spark)
    assert K.pruned_candidates(q, s.limit(0), 3).collect() == [] and K.pruned_candidates(q.limit(0), s, 3).collect() == []


def test_mean_vote(spark):
    rows = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1), (2, 0)], "q long, y int")
    assert sorted((r.q, round(r.probability, 3), r.predicted) for r in K.mean_vote(rows, ["q"], "y").collect()) == [(1, 0.5, 1), (2, 0.667, 1)]
    assert K.mean_vote(rows, ["q"], "y", tie=0).filter("q = 1").first().predicted == 0
