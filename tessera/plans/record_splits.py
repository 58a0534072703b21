"""Splits of records by their entities: validation halves, caps on held-out rows, and the rest for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import sha_key
from ..operators.ordered import quantiles
from ..operators.selection import shrunk
from ..operators.splits import assigned
from ..sources.shared import kept_table
from ..sources.staged import StagedOutputs

HELD_OUT = ("validation_1", "validation_2", "test")


def labelled_entities(records: DataFrame, entity: str, value: str, threshold: float) -> DataFrame:
    """``entity``, ``label`` (1 where the median of its values reaches ``threshold``) and ``n``, its rows with a value."""
    return quantiles(records, [entity], value, {"median": 0.5}).select(entity, (F.col("median") >= threshold).cast("int").alias("label"), "n")


def capped_splits(entities: DataFrame, entity: str, test: Column, validation: Column, caps: dict[str, int], seed: int) -> DataFrame:
    """``split`` and ``final`` of each entity (``label``, ``n``): held-out splits over their cap of rows give entities to ``train``.

    Those with most rows move first, of equal ones in the order of a hash of seed, split and entity. ``moved`` says which.
    """
    text = F.col(entity).cast("string")
    entities = kept_table(entities, "entities")
    parts = assigned(entities.withColumn("__key", sha_key(seed, F.lit("smiles"), text)), test, validation, "label", "__key", entity).drop("__key")
    parts = kept_table(parts, "assigned")
    out = parts.filter(~F.col("split").isin(*caps)).withColumn("moved", F.lit(False))
    for split, cap in caps.items():
        own = parts.filter(F.col("split") == split).withColumn("__order", sha_key(seed, F.lit(split), text))
        out = out.unionByName(shrunk(own, "n", "__order", entity, cap).drop("__order"))
    return out.withColumn("final", F.when(F.col("moved"), "train").otherwise(F.col("split")))


def split_report(entities: DataFrame) -> DataFrame:
    """Rows, entities, positives and moved entities of each split before (``stage`` 'assigned') and after the caps ('capped')."""
    both = F.explode(F.array(F.struct(F.lit("assigned").alias("stage"), F.col("split").alias("part")), F.struct(F.lit("capped").alias("stage"), F.col("final").alias("part"))))
    rows = entities.select("n", "label", "moved", both.alias("b")).select("b.*", "n", "label", "moved")
    return rows.groupBy("stage", F.col("part").alias("split")).agg(F.count("*").alias("entities"), F.sum("n").alias("rows"), F.count_if(F.col("label") == 1).alias("positives"), F.count_if("moved").alias("moved"))


def split_outputs(records: DataFrame, entities: DataFrame, entity: str) -> dict[str, DataFrame]:
    """A frame for each output: ``full/{split}`` with all records of its entities, ``entities/{split}`` with one row an entity and its label.

    Records of one split differ from those of the others in the entity; those of no entity are in none.
    """
    final = entities.select(entity, F.col("final").alias("__split"), F.col("label").alias("Y"))
    marked = records.join(final, entity)
    out = {}
    for s in (*HELD_OUT, "train"):
        out[f"full/{s}"] = marked.filter(F.col("__split") == s).drop("__split")
        out[f"entities/{s}"] = final.filter(F.col("__split") == s).select(entity, "Y")
    return out


def write_splits(outputs: dict[str, DataFrame], root: str, overwrite: bool = False) -> None:
    """All outputs under ``root``, installed together."""
    StagedOutputs({n: f"{root.rstrip('/')}/{n}" for n in outputs}, f"{root.rstrip('/')}/journal.json", overwrite).write(**outputs)
