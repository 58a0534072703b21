"""The best value so far of each key of a metric stream, and a sink that takes each batch once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Splits that are also written under another name.
ALIASES = {"val/no_overlap": "val/double_unseen", "val/a_seen_only": "val/query_unseen"}

BEST = "key string, step long, value double"


def _improved(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Rows that beat all before them: by step, and of one step the greatest value; equal values don't."""
    best = state.get[0] if state.exists else None
    rows = pd.Series(dtype="float64")
    for b in batches:  # held by step, not by row
        rows = pd.concat([rows, b.groupby("step")["value"].max()]).groupby(level=0).max()
    above = rows.cummax().shift()
    better = rows[above.isna() | (rows > above)]
    if best is not None:
        better = better[better > best]
    if len(better):
        state.update((float(better.iloc[-1]),))
    yield pd.DataFrame({"key": [key[0]] * len(better), "step": better.index.astype("int64"), "value": better.to_numpy()})


def improvements(metrics: DataFrame, key: str, step: str, value: str) -> DataFrame:
    """A stream with a row (``key``, ``step``, ``value``) each time that a key's value strictly improves.

    The state is one number a key. A batch is taken in the order of ``step``; a key's rows are
    held as the greatest value of each step. A row that comes in a later batch than rows of a
    greater step is compared with these too. Nulls and NaN improve nothing.
    """
    held = metrics.select(F.col(key).cast("string").alias("key"), F.col(step).cast("long").alias("step"), F.col(value).cast("double").alias("value")).filter("value is not null and not isnan(value)")
    return held.groupBy("key").applyInPandasWithState(_improved, BEST, "best double", "append", GroupStateTimeout.NoTimeout)


def doubled(metrics: DataFrame, split: str = "split") -> DataFrame:
    """Tidy metric rows, those of aliased splits twice."""
    alias = F.coalesce(*(F.when(F.col(split) == k, v) for k, v in ALIASES.items()))
    return metrics.withColumn(split, F.explode(F.when(alias.isNull(), F.array(split)).otherwise(F.array(F.col(split), alias))))


class BatchSink:
    """For ``foreachBatch``: rows of a batch in a folder of its own, so that a batch that is run again replaces what it wrote.

    ``rows()`` reads all batches as one table.
    """

    def __init__(self, path: str, aliases: bool = False):
        self.path, self.aliases = path.rstrip("/"), aliases

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        out = doubled(batch) if self.aliases else batch
        out.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("batch")
