"""Checks that a table is what its users take it for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _faults(not_null: list[str], binary: list[str]) -> dict[str, Column]:
    faults = {f"null {c}": F.col(c).isNull() for c in not_null}
    return faults | {f"non-binary {c}": ~F.coalesce(F.col(c).try_cast("double").isin(0.0, 1.0), F.lit(False)) for c in binary}


def required(rows: DataFrame, columns: list[str], role: str = "records") -> DataFrame:
    """``rows`` themselves; fails at once, without reading, where a column is missing."""
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"{role} lack the columns {', '.join(missing)}")
    return rows


def fault_counts(rows: DataFrame, not_null: list[str], binary: list[str]) -> DataFrame:
    """``fault`` and ``n``, the rows that have it, for every fault there could be; a row may have several."""
    required(rows, [*not_null, *binary])
    faults = _faults(not_null, binary)
    cells = [F.struct(F.lit(k).alias("fault"), F.count_if(c).alias("n")) for k, c in faults.items()]
    return rows.agg(F.array(*cells).alias("f")).select(F.inline("f"))


def asserted(rows: DataFrame, not_null: list[str], binary: list[str], role: str = "records") -> DataFrame:
    """``rows`` themselves; a task that meets a null, or a label that isn't 0 or 1, fails and says which."""
    required(rows, [*not_null, *binary], role)
    faults = _faults(not_null, binary)
    if not faults:
        return rows
    found = F.coalesce(*(F.when(c, F.lit(k)) for k, c in faults.items()))
    return rows.filter(F.when(found.isNotNull(), F.raise_error(F.concat(F.lit(f"{role}: "), found)).cast("boolean")).otherwise(True))


def disjoint(left: DataFrame, right: DataFrame, key: str, role: str = "records") -> None:
    """Fails where a non-null key is in both."""
    shared = left.select(key).filter(F.col(key).isNotNull()).join(right.select(key), key, "left_semi").limit(1).collect()
    if shared:
        raise ValueError(f"{role} share {key} {shared[0][0]!r}")
