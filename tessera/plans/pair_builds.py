"""A build of labelled pairs: validity, the choice between all pairs and a sample, and a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import finite, is_blank
from ..functions.hashing import sha_key
from ..operators.balance import balanced_pairs, pair_weights
from ..operators.pairing import _labelled, _outside, all_pairs, sampled_pairs


def validity(value: Column, entity: Column, canonical: Column | None = None) -> Column:
    """Why a record can't be in a pair: ``missing value``, ``missing entity`` or, with ``canonical``, ``invalid entity``; null for one that can."""
    out = F.when(finite(value).isNull(), "missing value").when(is_blank(entity.cast("string")), "missing entity")
    return out if canonical is None else out.when(canonical.isNull(), "invalid entity")


def valid_records(records: DataFrame, value: str, entity: str, canonical: Column | None = None) -> tuple[DataFrame, dict[str, int]]:
    """The records that can be in a pair, with ``value`` as a double, and how many of all were ``valid`` or why not."""
    reason = validity(F.col(value), F.col(entity), canonical)
    counts = {r.reason: r.n for r in records.groupBy(F.coalesce(reason, F.lit("valid")).alias("reason")).agg(F.count("*").alias("n")).collect()}
    return records.filter(reason.isNull()).withColumn(value, finite(F.col(value))), counts


def chosen_mode(records: DataFrame, key: list[str], most_pairs: int, mode: str = "auto") -> tuple[str, int]:
    """``exhaustive`` or ``sampled``, and the number of candidate pairs: a sample where all would be over ``most_pairs``.

    Pairs within a key are always made exhaustively: asking for a sample of them is an error.
    """
    if mode not in ("auto", "exhaustive", "sampled"):
        raise ValueError(f"unknown mode {mode!r}")
    if key and mode == "sampled":
        raise ValueError("pairs within keys are made exhaustively")
    if key:
        total = pair_weights(records, key).agg(F.sum("pairs")).first()[0] or 0
        return "exhaustive", total
    n = records.count()
    total = n * (n - 1) // 2
    return ("sampled" if total > most_pairs else "exhaustive") if mode == "auto" else mode, total


def built_pairs(records: DataFrame, key: list[str], most_pairs: int = 10**9, mode: str = "auto", seed: int = 0, near: float = 10.0, far: float = 30.0) -> tuple[DataFrame, dict]:
    """Labelled pairs of ``records`` (``id``, ``value``, others), and how they were made.

    Without a key they are all pairs, or as many candidates as ``most_pairs`` drawn by number. Fails where there are fewer than two
    records, or no pair is left outside the band.
    """
    if len(records.limit(2).collect()) < 2:
        raise ValueError("at least two valid records are needed")
    mode, total = chosen_mode(records, key, most_pairs, mode)
    report = {"mode": mode, "candidates": total, "drawn": total}
    if key:
        pairs = balanced_pairs(records, key, near, far)
    elif mode == "exhaustive":
        pairs = all_pairs(records, near=near, far=far)
    else:
        report["drawn"] = min(total, most_pairs)
        drawn = sampled_pairs(records.select("id", sha_key(seed, F.col("id")).alias("key")), [], "key", min(1.0, most_pairs / total), seed)
        drawn = drawn.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
        end = lambda s: records.select(*(F.col(c).alias(f"{c}_{s}") for c in records.columns))
        met = drawn.join(end("a"), "id_a").join(end("b"), "id_b").filter(_outside(near, far))
        pairs = _labelled(met, near, far)
    if not pairs.limit(1).collect():
        raise ValueError("no pair is outside the band")
    return pairs, report


def full_rows(compact: DataFrame, records: DataFrame, index: str, columns: list[str], split: str) -> DataFrame:
    """Compact pairs (``row_index_a``, ``row_index_b``, others) with both ends' ``columns``, and the split as their ``eval_subset``.

    A task fails at a pair whose index names no record.
    """
    out = compact.withColumn("eval_subset", F.lit(split))
    for s in ("a", "b"):
        at = f"row_index_{s}"
        own = records.select(F.col(index).alias(f"__{at}"), F.struct(*columns).alias(f"record_{s}"))
        out = out.join(own, F.col(at) == F.col(f"__{at}"), "left").drop(f"__{at}")
        failed = F.raise_error(F.concat(F.lit("no record "), F.coalesce(F.col(at).cast("string"), F.lit("null"))))
        out = out.withColumn(f"record_{s}", F.when(F.col(f"record_{s}").isNull(), failed).otherwise(F.col(f"record_{s}")))
    return out.select("*", *(F.col(f"record_{s}.{c}").alias(f"{c}_{s}") for s in "ab" for c in columns)).drop("record_a", "record_b")
