"""Blocks are searched once for their keys and once for their values."""

from pyspark.sql import functions as F

from tessera.sources import logs


def test_patterns_are_matched_once(spark):
    rows = spark.createDataFrame([("r", "{'eval_val_f1': '1d', 'eval_val_f2': '2', 'eval_val_f2': '-inf', 'epoch': '3'} {'loss': '1f', 'learning_rate': '2', 'epoch': '4'}")], "run string, text string")
    out = logs.run_metrics(rows, "run")
    assert {tuple(r) for r in out.collect()} == {("r", 3.0, "val", "f2", float("-inf")), ("r", 4.0, "train", "learning_rate", 2.0)}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("'([A-Za-z0-9_/]+)':") <= 2
