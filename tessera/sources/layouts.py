"""Where the splits of a data set lie, in any store that Spark reads."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# The names of splits, where their record files may lie, and other names for them.
SPLITS = ("validation_1", "validation_2", "test", "train")
RECORD_FILES = ("data/{config}/{split}/part-00000.parquet", "data/{config}/{split}/{split}.parquet", "{split}/part-00000.parquet", "{split}.parquet")
ALIASES = {"val_1": "validation_1", "val_2": "validation_2", "valid": "validation_1"}


def split_name(split: str) -> str:
    """A split's own name; fails for an unknown one."""
    found = ALIASES.get(split, split)
    if found not in SPLITS:
        raise ValueError(f"unknown split {split!r}; expected one of {SPLITS}")
    return found


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any store that Spark reads, by what its reader says of it."""
    try:
        spark.read.format("binaryFile").load(path).schema
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def first_existing(spark: SparkSession, *paths: str) -> str:
    """The first of the paths that is there; fails if none is."""
    found = next((p for p in paths if exists(spark, p)), None)
    if found is None:
        raise FileNotFoundError(f"none of {', '.join(paths)}")
    return found


def record_split_path(spark: SparkSession, root: str, split: str, config: str = "full_metadata") -> str:
    """A split's file: under the configuration's folder or the root, as a folder's first part or under its own name."""
    s = split_name(split)
    return first_existing(spark, *(f"{root}/{p.format(config=config, split=s)}" for p in RECORD_FILES))


def read_split(spark: SparkSession, root: str, split: str, schema: str | None = None, rows: int | None = None) -> DataFrame:
    """A split as a folder of Parquet or one file, else as JSON lines, gzipped or not; ``rows`` limits it."""
    path = first_existing(spark, f"{root}/{split}", f"{root}/{split}.parquet", f"{root}/{split}.jsonl.gz", f"{root}/{split}.jsonl")
    if ".jsonl" in path:
        found = (spark.read.schema(schema) if schema else spark.read).json(path)
    else:
        found = spark.read.parquet(path)
    return found if rows is None else found.limit(rows)


def row_count(spark: SparkSession, *paths: str) -> int:
    """The number of rows of Parquet files: no column is read, so the footers are enough."""
    return spark.read.parquet(*paths).count()
