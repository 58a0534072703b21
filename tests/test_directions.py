"""Both directions of pairs, and the one that a hash chooses, at little cost a pair."""

from pyspark.sql import functions as F

from tessera.functions import hashing as H
from tessera.operators import pairing as P


def _optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_both_directions_compare_no_texts(spark):
    pairs = spark.createDataFrame([(1, 2, 0), (3, 9, 1)], "id_a long, id_b long, label int")
    out = P.both_directions(pairs)
    assert out.columns == ["id_a", "id_b", "label", "direction", "source", "target"]
    assert sorted(map(tuple, out.collect())) == [(1, 2, 0, "a_to_b", 1, 2), (1, 2, 0, "b_to_a", 2, 1), (3, 9, 1, "a_to_b", 3, 9), (3, 9, 1, "b_to_a", 9, 3)]
    assert " = a_to_b" not in _optimised(out)


def test_one_direction_is_the_parity_without_the_number(spark):
    out = spark.range(500).select("id", H.one_direction(13, F.col("id")).alias("direction"))
    want = F.when(F.pmod(H.sha_number(13, F.col("id")), F.lit(2)) == 0, "a_to_b").otherwise("b_to_a")
    assert out.filter(F.col("direction") != want).count() == 0 and out.select("direction").distinct().count() == 2
    assert "conv(" not in _optimised(out)
