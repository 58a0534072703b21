"""Several universes of pairs from one pass: pairs are made once, and know which universes hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import is_blank
from ..operators.pairing import all_pairs, same_key_pairs
from ..operators.selection import routed
from ..sources.staged import StagedOutputs


def universe_mask(universes: dict[str, list[str]]) -> Column:
    """A bit for each universe, in order, whose keys both ends of a pair share; blank keys are shared by none."""
    bits = []
    for k, keys in enumerate(universes.values()):
        same = F.lit(True)
        for c in keys:
            a, b = F.trim(F.col(f"{c}_a").cast("string")), F.trim(F.col(f"{c}_b").cast("string"))
            same &= ~is_blank(a) & (a == b)
        bits.append(F.when(same, 1 << k).otherwise(0))
    return sum(bits[1:], bits[0])


def universe_pairs(records: DataFrame, universes: dict[str, list[str]], near: float = 10.0, far: float = 30.0) -> DataFrame:
    """Pairs of records of all ``universes`` (name: the keys whose values the ends share; none: all pairs) with their ``universes`` mask.

    The keys that all universes have in common make the pairs, in one join; the others are bits of the mask.
    """
    if not 0 < len(universes) < 31:
        raise ValueError("between one and thirty universes")
    shared = [k for k in next(iter(universes.values())) if all(k in keys for keys in universes.values())]
    pairs = same_key_pairs(records, shared, near, far) if shared else all_pairs(records, near=near, far=far)
    return pairs.withColumn("universes", universe_mask(universes)).filter("universes > 0")


def routed_universes(pairs: DataFrame, selected: DataFrame, no_train: DataFrame, universes: list[str]) -> DataFrame:
    """Pairs with their ``route``, decided once, in a row for each ``universe`` that holds them.

    A selected pair is an evaluation pair in every universe that holds it.
    """
    decided = routed(pairs, selected, no_train)
    names = F.array_compact(F.array(*(F.when(F.col("universes").bitwiseAND(1 << k) > 0, n) for k, n in enumerate(universes))))
    return decided.withColumn("universe", F.explode(names)).drop("universes")


def missing_selections(routes: DataFrame, selected: DataFrame, universes: list[str]) -> DataFrame:
    """Selected pairs that a universe doesn't hold: ``universe``, ``id_a``, ``id_b``; none where a selection fits all."""
    order = lambda d: d.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    wanted = order(selected).distinct().withColumn("universe", F.explode(F.array(*map(F.lit, universes))))
    held = routes.filter("route = 'eval'").select("universe", F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    return wanted.join(held, ["universe", "id_a", "id_b"], "left_anti")


def write_universes(routes: DataFrame, paths: dict[str, str], journal: str, staging: str, overwrite: bool = False) -> None:
    """A folder of Parquet for each universe, by ``route``, all installed together.

    The pairs are written to ``staging`` first, by universe, so that they are made once; each folder is a copy of its part.
    """
    spark = routes.sparkSession
    routes.write.partitionBy("universe").parquet(staging)
    made = spark.read.schema(routes.schema).parquet(staging)
    frames = {n: made.filter(F.col("universe") == n).drop("universe") for n in paths}
    StagedOutputs(paths, journal, overwrite).make(lambda name, path: frames[name].write.option("compression", "zstd").partitionBy("route").parquet(path))
