"""Readers and writers of the formats that data sets come in."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_records(spark: SparkSession, *paths: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet files or folders as one table; schemas are merged."""
    found = spark.read.option("mergeSchema", True).parquet(*paths)
    return found.select(*columns) if columns else found


def read_json_lines(spark: SparkSession, schema: str, *paths: str) -> DataFrame:
    """JSON lines, gzipped or not, with a given schema; blank lines are skipped."""
    return spark.read.schema(schema).json(list(paths))


def read_delimited(spark: SparkSession, path: str, separator: str = "\t", schema: str | None = None) -> DataFrame:
    """Delimited text with a header; all columns are texts unless a schema is given."""
    reader = spark.read.option("header", True).option("sep", separator)
    return (reader.schema(schema) if schema else reader).csv(path)


def write_records(df: DataFrame, path: str, rows_per_file: int | None = None, by: list[str] | None = None, overwrite: bool = False) -> None:
    """Parquet with zstd, at most ``rows_per_file`` rows a file; fails where ``path`` exists unless told to overwrite.

    Spark's committer shows the files only when all tasks are done, so no reader sees a part of them.
    """
    writer = df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "zstd")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_json_lines(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Gzipped JSON lines; nulls are kept."""
    df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "gzip").option("ignoreNullFields", False).json(path)


def write_sorted_list(df: DataFrame, column: str, path: str) -> None:
    """The distinct stripped texts that aren't blank, one a line, in order from file to file."""
    text = F.trim(F.col(column).cast("string")).alias("value")
    df.select(text).filter("value <> ''").distinct().orderBy("value").write.mode("errorifexists").text(path)


def unioned(*frames: DataFrame) -> DataFrame:
    """Frames below each other, with all of their columns in the order in which they are first seen; null where one has none."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def appended(df: DataFrame, path: str) -> None:
    """Tidy metric rows added to those in ``path``."""
    df.write.mode("append").parquet(path)


def manifest(counts: DataFrame, most: int = 10_000, **more) -> str:
    """A JSON text with sorted keys of a table of counts; fails if there are more than ``most`` groups."""
    rows = [r.asDict() for r in counts.limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"more than {most} groups: write the counts as a table")
    return json.dumps({**more, "counts": sorted(rows, key=lambda r: json.dumps(r, sort_keys=True, default=str))}, sort_keys=True, indent=2, default=str)


def written_tables(df: DataFrame, order: list[str]) -> tuple[str, str]:
    """A small result table as CSV and as Markdown, nulls blank, in ``order``; its rows are results, so it fits the driver."""
    rows = [["" if v is None else str(v) for v in r] for r in df.orderBy(*order).collect()]
    quoted = lambda v: f'"{v.replace(chr(34), chr(34) * 2)}"' if any(c in v for c in ',"\n\r') else v
    csv = "".join(",".join(map(quoted, r)) + "\n" for r in [df.columns, *rows])
    line = lambda cells: "| " + " | ".join(c.replace("|", "\\|").replace("\n", " ") for c in cells) + " |\n"
    return csv, line(df.columns) + line(["---"] * len(df.columns)) + "".join(map(line, rows))
