"""Draws are numbers of a permutation in arrays, the same as in expressions, and they aren't shuffled to their ends."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import catalogue
from tessera.functions.hashing import sha_number
from tessera.operators import pairing as P


@pytest.mark.parametrize("n", [1, 2, 10, 997, 1_151_976_000, 10**13 + 7])
def test_same_places_as_the_expression(spark, n):
    k = sorted({0, n - 1, *(i * max(1, n // 300) % n for i in range(300))})
    rows = spark.createDataFrame([(i,) for i in k], "k long").select("k", P.permuted(F.col("k"), F.lit(n).cast("long"), 7, F.lit("t")).alias("x"), (sha_number(7, F.lit("t")) % P.PRIME).alias("term")).collect()
    got = P._permuted(np.array([r.k for r in rows]), n, rows[0].term)
    assert got.tolist() == [r.x for r in rows]


def test_triangle():
    x = np.r_[0:5000, (10**9 * (10**9 - 1) // 2) + np.arange(-3, 4)]
    i, j = P._triangle(x)
    assert ((0 <= i) & (i < j)).all() and (j * (j - 1) // 2 + i == x).all()


@pytest.mark.parametrize("draws", [7, 1 << 20])
def test_any_ranges_give_the_same_pairs(spark, monkeypatch, draws):
    df = spark.range(60).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("key"))
    want = {tuple(r) for r in P.sampled_pairs(df, ["g"], "key", 0.3).collect()}
    monkeypatch.setattr(P, "DRAWS", draws)
    got = [tuple(r) for r in P.sampled_pairs(df, ["g"], "key", 0.3).collect()]
    assert len(got) == len(want) == 3 * 57 and set(got) == want


def test_draws_are_not_joined(spark):
    plan = catalogue.QUERIES["sampled_pairs"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("FlatMapGroupsInArrow")]
    assert "Join" not in above and "aggregate(" not in plan
