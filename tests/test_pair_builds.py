"""Builds of pairs: validity, modes, errors and full rows."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.plans import pair_builds as B


def records(spark, n=40):
    return spark.createDataFrame([(i, float(i * 13 % 47), f"g{i % 3}") for i in range(n)], "id long, value double, g string")


def test_valid_records(spark):
    df = spark.createDataFrame([("1", "a", "A"), ("x", "a", "A"), (None, "a", "A"), ("nan", "a", "A"), ("2", " ", None), ("3", "b", None), ("4.5", "c", "C")], "v string, e string, c string")
    rows, counts = B.valid_records(df, "v", "e", F.col("c"))
    assert counts == {"valid": 2, "missing value": 3, "missing entity": 1, "invalid entity": 1}
    assert sorted((r.v, r.e) for r in rows.collect()) == [(1.0, "a"), (4.5, "c")]


def test_modes(spark):
    df = records(spark)
    assert B.chosen_mode(df, [], 10_000) == ("exhaustive", 780) and B.chosen_mode(df, [], 100) == ("sampled", 780)
    assert B.chosen_mode(df, ["g"], 1) == ("exhaustive", 14 * 13 // 2 + 2 * 13 * 12 // 2)
    for key, mode in ((["g"], "sampled"), ([], "some")):
        with pytest.raises(ValueError):
            B.chosen_mode(df, key, 10, mode)


def test_samples_are_of_all_pairs(spark):
    df = records(spark)
    whole, report = B.built_pairs(df, [])
    assert report == {"mode": "exhaustive", "candidates": 780, "drawn": 780}
    columns = ["id_a", "id_b", "value_a", "g_b", "difference", "label"]
    every = {tuple(r) for r in whole.select(columns).collect()}
    some, report = B.built_pairs(df, [], most_pairs=100)
    got = [tuple(r) for r in some.select(columns).collect()]
    assert report == {"mode": "sampled", "candidates": 780, "drawn": 100}
    assert set(got) < every and len(got) == len(set(got)) and len(got) > 100 * len(every) / 780 - 5 * math.sqrt(25)
    assert {tuple(r) for r in B.built_pairs(df, [], most_pairs=780, mode="sampled")[0].select(columns).collect()} == every


def test_builds_without_pairs_fail(spark):
    df = records(spark)
    with pytest.raises(ValueError, match="two valid"):
        B.built_pairs(df.limit(1), [])
    with pytest.raises(ValueError, match="no pair"):
        B.built_pairs(df.withColumn("value", F.col("id") * 0 + F.when(F.col("id") % 2 == 0, 20.0).otherwise(0.0)).filter("id < 2"), [])


def test_full_rows(spark):
    base = spark.createDataFrame([(0, "x", 1.0), (1, "y", None)], "i long, s string, v double")
    compact = spark.createDataFrame([(0, 1, "both_seen")], "row_index_a long, row_index_b long, eval_subset string")
    row = B.full_rows(compact, base, "i", ["s", "v"], "test").first().asDict()
    assert row == {"row_index_a": 0, "row_index_b": 1, "eval_subset": "test", "s_a": "x", "v_a": 1.0, "s_b": "y", "v_b": None}
    with pytest.raises(Exception, match="no record 7"):
        B.full_rows(compact.withColumn("row_index_b", F.lit(7).cast("long")), base, "i", ["s"], "test").collect()
