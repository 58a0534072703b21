"""Normalised records, subsets and rows of predictions."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import results as R
from tessera.plans import records as N


def test_normalised_records(spark):
    rows = spark.createDataFrame([(7, " a", 1, "x", None), (3, "b", 0, "nan", "y"), (11, "c", 1, "", " ")], "row_index long, smiles string, Y int, f string, g string")
    out = {r.record_key: r for r in N.normalised_records(rows, "query", "row_index", "smiles", "Y", F.trim("smiles"), ["f", "g"]).collect()}
    assert [(k, out[k].query_position, out[k].query_row_index, out[k].label, out[k].canonical, out[k].missing_mask, out[k].missing_count_bucket) for k in ("3", "7", "11")] == [
        ("3", 0, 3, 0, "b", "10", "0-2"), ("7", 1, 7, 1, "a", "01", "0-2"), ("11", 2, 11, 1, "c", "11", "0-2")
    ]
    for bad in ("cast(null as long) as row_index", "'x' as smiles", "2 as Y"):
        name = bad.split()[-1]
        faulty = rows.withColumn(name, F.expr(bad.rsplit(" as ", 1)[0]) if name != "smiles" else F.lit(None).cast("string"))
        with pytest.raises(Exception, match="source: n"):
            N.normalised_records(faulty, "source", "row_index", "smiles", "Y").collect()
    with pytest.raises(ValueError):
        N.normalised_records(rows.drop("Y"), "source", "row_index", "smiles", "Y")


def test_subsets(spark):
    df = spark.createDataFrame([(k, ["no_overlap", "both_seen", None][k % 3], k % 2) for k in range(6)], "i int, eval_subset string, similarity_bucket int")
    ids = lambda d: sorted(r.i for r in d.collect())
    assert ids(N.subset_rows(df)) == list(range(6)) and ids(N.subset_rows(df, "no_overlap")) == [0, 3]
    assert ids(N.subset_rows(df, subsets={"no_overlap", "both_seen"})) == [0, 1, 3, 4] and ids(N.subset_rows(df, "no_overlap", 1)) == [3]
    assert N.subset_rows(df, subsets=set()).count() == 0


def test_prediction_rows(spark):
    votes = spark.createDataFrame([("7", 7, 1, 0, 0.25, "lt20")], "record_key string, query_row_index long, label int, predicted int, probability double, bin string")
    row = N.prediction_rows(votes, "test", "tanimoto", {"k": 5, "fraction": 0.1}, ["bin"]).first().asDict()
    assert row == {"split": "test", "method": "tanimoto", "fraction": 0.1, "k": 5, "query_record_id": "7", "query_row_index": 7, "label": 1, "prediction": 0, "probability": 0.25, "bin": "lt20"}


def test_rows_in_a_rank_of_ones_own(spark):
    df = spark.createDataFrame([("b", "x1", 1), ("a", "y", 2), ("z", "x2", 3), ("a", "x3", 4)], "kind string, label string, v int")
    out = R.ranked_rows(df.filter(R.label_has(F.col("label"), "x")), {"kind": ["b", "a"]}, ["v"])
    assert [r.v for r in out.collect()] == [1, 4, 3]
    with pytest.raises(ValueError, match="lack 1"):
        R.complete(df, ["kind"], [("a",), ("b",), ("q",)])
    assert R.complete(df, ["kind"], [("a",), ("b",)]) is df
