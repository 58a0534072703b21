"""Manifests counted while a table is written, so that its input is read once."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_counted(rows: DataFrame, path: str, kept: Column, by: dict[str, list], sums: dict[str, Column] | None = None, partition: list[str] | None = None, overwrite: bool = False) -> dict:
    """Write the rows that are ``kept`` as Parquet, and return counts of all rows before, and of those written.

    ``{"before": {...}, "after": {...}}`` each have ``rows``, for each column of ``by`` the
    rows of each of its listed values, of null and of all others, and ``sums``. What is
    counted is counted in the tasks that write, before and after their filter, and Spark
    takes a writing task's counts once, also where it is run again.
    """
    whole, counted = F.lit(True), {}
    keep = F.coalesce(kept, F.lit(False))
    for side, test in (("before", whole), ("after", keep)):
        counted[side, "rows", None] = F.count_if(test)
        for c, values in by.items():
            for v in values:
                counted[side, c, v] = F.count_if(test & F.col(c).eqNullSafe(F.lit(v)))
            counted[side, c, None] = F.count_if(test & F.col(c).isNull())
            known = F.col(c).isin(*values) if values else F.lit(False)
            counted[side, c, "other values"] = F.count_if(test & F.col(c).isNotNull() & ~known)
        for name, c in (sums or {}).items():
            counted[side, name, "sum"] = F.coalesce(F.sum(F.when(test, c)), F.lit(0))
    seen = Observation()
    names = {k: f"c{i}" for i, k in enumerate(counted)}
    out = rows.observe(seen, *(c.alias(names[k]) for k, c in counted.items())).filter(keep)
    writer = out.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "zstd")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)
    found, manifest = seen.get, {"before": {}, "after": {}}
    for k, alias in names.items():
        side, what, value = k
        if what == "rows" and value is None:
            manifest[side]["rows"] = found[alias]
        elif value == "sum":
            manifest[side].setdefault("sums", {})[what] = found[alias]
        else:
            manifest[side].setdefault(what, {})["null" if value is None else str(value)] = found[alias]
    return manifest


def manifest_text(manifest: dict, **policies) -> str:
    """The manifest with the policies that made it, as JSON with sorted keys."""
    return json.dumps({**policies, **manifest}, sort_keys=True, indent=2, default=sorted)
