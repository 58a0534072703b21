"""Lines of text files with their numbers, read in as many tasks as the files have blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``file``, ``line`` (from 1) and ``text`` of every line, blank ones too.

    Spark's text reader cuts files at block borders and reads a block's lines in order. Lines
    are counted by block first, and a block's lines go on where the counts before it end;
    there is a row a block in the prefix sum. Compressed files are one block each.
    """
    raw = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("text")
    )
    blocks = raw.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    line = F.col("before") + F.col("at") - F.col("first") + 1
    return raw.join(blocks, ["file", "block"]).select("file", line.alias("line"), "text")


def json_rows(spark: SparkSession, schema: str, *paths: str) -> DataFrame:
    """JSON lines as ``file``, ``line`` and the fields of ``schema``; blank lines are left out, but count."""
    lines = numbered_lines(spark, *paths).filter(r"text rlike '\\S'")
    return lines.select("file", "line", F.from_json("text", schema).alias("r")).select("file", "line", "r.*")


def molecule_rows(spark: SparkSession, paths: dict[str, str], canonical, drop_invalid: bool = False) -> DataFrame:
    """Benchmark rows of several splits (``{split: path}``): ``split``, ``file``, ``line``, ``raw``, ``canonical``, ``Y`` and ``valid``.

    The text is under ``drug`` or, where that is missing or empty, ``Drug``. ``canonical`` makes a column of a
    column, null for texts that name nothing; such rows stay, as not valid, unless ``drop_invalid``.
    """
    split = F.coalesce(*(F.when(F.col("file").endswith(p.rsplit("/", 2)[-2] + "/" + p.rsplit("/", 1)[-1]), s) for s, p in paths.items()))
    lines = numbered_lines(spark, *paths.values()).filter(r"text rlike '\\S'")
    field = lambda name: F.nullif(F.get_json_object("text", f"$.{name}"), F.lit(""))
    raw = F.nullif(F.trim(F.coalesce(field("drug"), field("Drug"))), F.lit(""))
    out = lines.select(split.alias("split"), "file", "line", raw.alias("raw"), F.get_json_object("text", "$.Y").try_cast("double").alias("Y"))
    out = out.withColumn("canonical", canonical(F.col("raw"))).withColumn("valid", F.col("canonical").isNotNull())
    out = out.select("split", "file", "line", "raw", "canonical", "Y", "valid")
    return out.filter("valid") if drop_invalid else out
