"""The first rows by a digest from those below a bound are those of the whole order, without a shuffle of all rows."""

import pytest
from pyspark.sql import functions as F

from tessera import catalogue
from tessera.functions import hashing as H
from tessera.operators import selection as S


def rows(spark, n=6000):
    g = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 500 == 1, "few").otherwise("many")
    return spark.range(n).select("id", g.alias("g"), H.sha_key(3, F.col("id")).alias("key"))


@pytest.mark.parametrize("k", [1, 40, 10_000])
def test_same_rows_as_the_whole_order(spark, k):
    df = rows(spark)
    sizes = df.groupBy("g").agg(F.count("*").alias("n"))
    got = [r.id for r in S.first_by_bound(df, sizes, ["g"], "key", k, "id").collect()]
    want = {r.id for r in S.first_by_key(df, ["g"], "key", F.lit(k), "id").collect()}
    assert len(got) == len(set(got)) and set(got) == want


def test_a_bound_that_is_too_low(spark):
    """Keys that don't spread: all are above the bound."""
    df = rows(spark).withColumn("key", F.concat(F.lit("fff"), "key"))
    sizes = df.groupBy("g").agg(F.count("*").alias("n"))
    got = {r.id for r in S.first_by_bound(df, sizes, ["g"], "key", 5, "id").collect()}
    assert got == {r.id for r in S.first_by_key(df, ["g"], "key", F.lit(5), "id").collect()} and len(got) == 15


def test_pairs_of_pools_are_hashed_once_and_not_shuffled(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(S, "kept_table", lambda df, name, keep=S.kept_table: seen.append(df) or keep(df, name))
    catalogue.QUERIES["stratum_pools"](spark, "/root/testdata/sf0.001").collect()
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Union")]
    assert "Repartition" not in above and "Aggregate" not in above and "Sort" not in above
    assert plan.count("sha2(") <= 2  # one for each half of the pairs
