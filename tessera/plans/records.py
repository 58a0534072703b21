"""Records as neighbour searches take them: checked, keyed, labelled and numbered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import missing_bucket, missing_mask
from ..operators.checks import asserted
from ..operators.ordered import order_key, running_sums


def normalised_records(rows: DataFrame, role: str, index: str, entity: str, label: str, canonical: Column | None = None, fields: list[str] | None = None) -> DataFrame:
    """``rows`` with ``record_key``, ``canonical``, ``label``, ``{role}_row_index`` and ``{role}_position``, and what is missing of ``fields``.

    A task fails at a null index or entity, or a label that isn't 0 or 1. The position is the
    number of records with a lesser index: counts by ranges, so no task orders all of them.
    Indexes are whole numbers below 2^53, different for each record.
    """
    kept = asserted(rows, [index, entity], [label], role)
    out = kept.withColumns(
        {
            "record_key": F.col(index).cast("string"),
            "canonical": F.col(entity) if canonical is None else canonical,
            "label": F.col(label).cast("double").cast("tinyint"),
            f"{role}_row_index": F.col(index).cast("long"),
        }
    )
    if fields:
        mask = missing_mask(*map(F.col, fields))
        missing = F.length(F.replace(mask, F.lit("0"), F.lit("")))
        out = out.withColumns({"missing_mask": mask, "missing_count": missing, "missing_count_bucket": missing_bucket(missing)})
    keyed = out.withColumns({"__key": order_key(F.col(index)), "__one": F.lit(1)})
    placed = running_sums(keyed, [], "__key", ["__one"])
    return placed.withColumn(f"{role}_position", F.col("__one_below").cast("long")).select(*out.columns, f"{role}_position")


def subset_rows(pairs: DataFrame, subset: str | None = None, bucket: int | None = None, subsets: set[str] | None = None) -> DataFrame:
    """Evaluation pairs of one ``eval_subset``, of a set of them, or of one ``similarity_bucket``; all where none is named."""
    out = pairs
    if subset is not None:
        out = out.filter(F.col("eval_subset") == subset)
    if subsets is not None:
        out = out.filter(F.col("eval_subset").isin(*sorted(subsets)))
    return out if bucket is None else out.filter(F.col("similarity_bucket") == bucket)


def prediction_rows(votes: DataFrame, split: str, method: str, params: dict, by: list[str]) -> DataFrame:
    """Rows of predictions as they are written: split, method and parameters, the record, its label, prediction and probability, and its slices."""
    said = [F.lit(split).alias("split"), F.lit(method).alias("method"), *(F.lit(v).alias(k) for k, v in sorted(params.items()))]
    record = [F.col("record_key").alias("query_record_id"), F.col("query_row_index"), F.col("label").cast("int").alias("label"), F.col("predicted").cast("int").alias("prediction"), F.col("probability")]
    return votes.select(*said, *record, *by)
