"""Tables of tidy metrics: best values, winners, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def best_values(metrics: DataFrame, by: list[str]) -> DataFrame:
    """The largest value of each metric, and the first epoch that reached it."""
    return metrics.groupBy(*by).agg(F.max("value").alias("best"), F.max_by("epoch", F.struct("value", -F.col("epoch"))).alias("epoch"))


def best_complete_epoch(metrics: DataFrame, subset: str, n: int) -> DataFrame:
    """The epoch with the highest mean value among those that have all ``n`` subsets; the earliest of equals."""
    whole = metrics.groupBy("epoch").agg(F.avg("value").alias("mean"), F.count_distinct(subset).alias("k")).filter(F.col("k") == n)
    best = whole.agg(F.max_by(F.struct("epoch", "mean"), F.struct("mean", -F.col("epoch"))).alias("b")).filter("b is not null")
    return best.select("b.epoch", "b.mean")


def winner(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """Of each group the row that is greatest in the columns of ``order``, one after the other."""
    rest = [c for c in rows.columns if c not in by]
    return rows.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("w")).select(*by, "w.*")


def upserted(existing: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` with the rows of ``updates`` in place of those of the same keys."""
    return existing.join(updates.select(*keys).distinct(), keys, "left_anti").unionByName(updates, allowMissingColumns=True)


def wide_best(metrics: DataFrame, index: str, names: list[str], by: str) -> DataFrame:
    """Metrics as columns, and the row with the largest ``by``; the least index of equals."""
    wide = metrics.groupBy(index).pivot("metric", names).agg(F.avg("value"))
    row = F.max_by(F.struct(index, *names), F.struct(by, -F.col(index)))
    return wide.agg(row.alias("r")).select("r.*")


def most_common(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most common keys with their counts; equal counts in the order of the keys."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), key).limit(n)


def fold_means(metrics: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """The mean of each metric over folds, as ``cv_`` and its name."""
    return metrics.groupBy(*by).agg(*(F.avg(n).alias(f"cv_{n}") for n in names))


def merged(main: DataFrame, other: DataFrame, keys: list[str], added: list[str]) -> DataFrame:
    """``main`` with the columns ``added`` of ``other``; fails in the task that meets a key which ``other`` lacks."""
    held = other.select(*keys, *added, F.lit(True).alias("__there"))
    missing = F.raise_error(F.concat(F.lit("no results for "), F.concat_ws("/", *keys)))
    rows = main.drop(*added).join(held, keys, "left")
    return rows.withColumns({c: F.when(F.col("__there").isNull(), missing).otherwise(F.col(c)) for c in added}).drop("__there")


def compared(one: DataFrame, other: DataFrame, by: list[str], value: str, names: tuple[str, str]) -> DataFrame:
    """Two checkpoints' metrics side by side, the difference (second less first) and which is better (``tie`` if equal)."""
    a, b = (df.select(*by, F.col(value).alias(n)) for df, n in zip((one, other), names))
    rows = a.join(b, by).withColumn("delta", F.col(names[1]) - F.col(names[0]))
    return rows.withColumn("winner", F.when(F.col("delta") > 0, names[1]).when(F.col("delta") < 0, names[0]).otherwise("tie"))


def majority(rows: DataFrame, label: str, by: list[str]) -> DataFrame:
    """The prediction that goes with the majority of each slice (1 at one half), and how many labels it gets right."""
    n, pos = F.count("*"), F.count_if(F.col(label) == 1)
    guess = (pos >= n / 2).cast("int")
    return rows.groupBy(*by).agg(n.alias("n"), guess.alias("predicted"), F.when(guess == 1, pos).otherwise(n - pos).alias("correct"))


def label_has(label: Column, part: str) -> Column:
    """Whether a run's label names ``part``."""
    return F.coalesce(label.contains(part), F.lit(False))


def ranked_rows(rows: DataFrame, ranks: dict[str, list], then: list[str]) -> DataFrame:
    """A table of results in an order of one's own: by the places of values in lists, unknown ones last, then by columns."""
    place = lambda c, values: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, values)), F.col(c)), F.lit(0).cast("long")), F.lit(len(values) + 1).cast("long"))
    return rows.orderBy(*(place(c, v) for c, v in ranks.items()), *then)


def complete(rows: DataFrame, key: list[str], tasks: list[tuple]) -> DataFrame:
    """``rows`` themselves; fails where one of ``tasks``, the keys that results are awaited for, has none."""
    wanted = rows.sparkSession.createDataFrame(tasks, rows.select(*key).schema)
    missing = wanted.join(rows.select(*key).distinct(), key, "left_anti").collect()
    if missing:
        raise ValueError(f"results lack {len(missing)} of {len(tasks)} tasks, such as {tuple(missing[0])}")
    return rows
