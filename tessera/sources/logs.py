"""Metrics out of the logs of training runs, as expressions over the logs' texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How the trainer writes its metrics.
BLOCK, PAIR = r"(\{[^{}]*\})", r"'([A-Za-z0-9_/]+)':\s*'([^']*)'"
EVAL_BLOCK, NUMBER_PAIR = r"(\{'eval_val_loss': .*?\})", r"'([^']+)':\s*([^,'}\s]+)"


def read_logs(spark: SparkSession, *paths: str) -> DataFrame:
    """``log`` (the file) and ``text`` of each log; a file is one row, since a block may span lines."""
    return spark.read.text(list(paths), wholetext=True).select(F.input_file_name().alias("log"), F.col("value").alias("text"))


def _number(text: Column) -> Column:
    return F.when(~text.rlike("(?i)(d|(?<!in)f)$"), text.try_cast("double"))


def _once(rows: DataFrame, keep, **columns: Column) -> DataFrame:
    """``keep`` and ``columns``, each computed once a row: no filter or lambda that uses them is moved before a generator."""
    return rows.select(*keep, F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def _paired(blocks: DataFrame, keep, pattern: str) -> DataFrame:
    """``keep`` and the ``pairs`` in each ``block`` as structs (k, v); of equal keys the last."""
    k, v = (F.regexp_extract_all("block", F.lit(pattern), F.lit(g)) for g in (1, 2))
    found = _once(blocks, keep, k=k, v=v)
    last = lambda x, i: i == F.size("k") - F.array_position(F.reverse("k"), x["k"])
    return _once(found, keep, pairs=F.filter(F.arrays_zip("k", "v"), last))


def run_metrics(logs: DataFrame, *keep: str) -> DataFrame:
    """``epoch``, ``split``, ``metric`` and ``value`` of every number in the logs' blocks, beside the columns ``keep``.

    A block counts if it has a numeric epoch. One with ``eval_val_`` names is of the split
    ``val``, else one with ``eval_train_sample_`` names of ``train_sample`` (both without
    the prefix, and only names that have it), else one with a loss and a learning rate of
    ``train``; others, and values that aren't numbers, are left out.
    """
    blocks = logs.select(*keep, F.explode(F.regexp_extract_all("text", F.lit(BLOCK), F.lit(1))).alias("block"))
    rows = _paired(blocks, keep, PAIR)
    starts = lambda p: F.exists("pairs", lambda x: x["k"].startswith(p))
    named = lambda n: F.exists("pairs", lambda x: x["k"] == n)
    split = F.when(starts("eval_val_"), "val").when(starts("eval_train_sample_"), "train_sample").when(named("loss") & named("learning_rate"), "train")
    epoch = _number(F.get(F.filter("pairs", lambda x: x["k"] == "epoch"), F.lit(0))["v"])
    prefix = F.when(F.col("split") == "train", "").otherwise(F.concat(F.lit("eval_"), "split", F.lit("_")))
    rows = _once(rows, keep, epoch=epoch, split=split, pairs=F.col("pairs")).filter("epoch is not null and split is not null")
    each = rows.select(*keep, "epoch", "split", prefix.alias("prefix"), F.explode("pairs").alias("x"))
    each = each.filter((F.col("x.k") != "epoch") & F.startswith("x.k", "prefix"))
    return _once(each, [*keep, "epoch", "split"], metric=F.substring("x.k", F.length("prefix") + 1, F.length("x.k")), value=_number(F.col("x.v"))).filter("value is not null")


def eval_blocks(logs: DataFrame, *keep: str) -> DataFrame:
    """The evaluations of a log whose numbers aren't quoted, as maps with their place in it: those with a macro F1."""
    blocks = logs.select(*keep, F.posexplode(F.regexp_extract_all("text", F.lit(EVAL_BLOCK), F.lit(1))).alias("place", "block"))
    rows = _paired(blocks, [*keep, "place"], NUMBER_PAIR)
    pairs = F.transform("pairs", lambda x: F.struct(x["k"], _number(x["v"])))
    return rows.select(*keep, "place", F.map_from_entries(pairs).alias("metrics")).filter(F.map_contains_key("metrics", "eval_val_macro_f1"))
