"""Entities of records: their numbers, in the order in which they are first seen, and what is known of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import order_key, running_sums


def entity_table(records: DataFrame, id_: str, entity: str) -> DataFrame:
    """``entity_id`` (from 0, by the least ``id_`` of its records), the entity, ``first`` and ``n``; null is no entity.

    Places are counts of the entities seen before, by ranges, so that no task orders them all.
    Ids are whole numbers below 2^53, different for each record.
    """
    seen = records.filter(F.col(entity).isNotNull()).groupBy(entity).agg(F.min(id_).alias("first"), F.count("*").alias("n"))
    keyed = seen.withColumns({"__key": order_key(F.col("first")), "__one": F.lit(1)})
    return running_sums(keyed, [], "__key", ["__one"]).select(F.col("__one_below").cast("long").alias("entity_id"), entity, "first", "n")


def with_entity_ids(records: DataFrame, entities: DataFrame, entity: str) -> DataFrame:
    """``records`` with their ``entity_id``; a task fails at a record without an entity, as no split could hold it."""
    out = records.join(entities.select(entity, "entity_id"), entity, "left")
    failed = F.raise_error(F.lit(f"a record has no {entity}")).cast("long")
    return out.withColumn("entity_id", F.coalesce("entity_id", failed)).select(*records.columns, "entity_id")


def top_by(rows: DataFrame, entity: str, measure: str, n: int) -> DataFrame:
    """The ``n`` entities of the greatest ``measure``; those that tie at the end are taken by their SHA-256.

    Entities are counted by distinct measures; only the one measure at the end is ranked.
    """
    from .selection import first_k

    counts = rows.groupBy(F.col(measure).alias("__m")).agg(F.count("*").alias("__n"))
    placed = running_sums(counts.withColumn("__key", order_key(-F.col("__m"))), [], "__key", ["__n"]).filter(F.col("__n_below") < n)
    met = rows.join(placed.select("__m", "__n", "__n_below"), F.col(measure) == F.col("__m"))
    whole = met.filter(F.col("__n_below") + F.col("__n") <= n)
    end = met.filter(F.col("__n_below") + F.col("__n") > n).withColumn("__hash", F.sha2(F.col(entity).cast("string"), 256))
    left = end.agg(F.min(F.lit(n) - F.col("__n_below"))).first()[0] or 0
    return whole.select(*rows.columns).unionByName(first_k(end, [], "__hash", int(left), entity).select(*rows.columns))


def holdout_costs(costs: DataFrame, degrees: DataFrame, selected: DataFrame, total: int) -> DataFrame:
    """What it costs to keep ``selected`` entities out of training, beside as many of the highest degree.

    ``costs`` has ``entity`` and ``cost``, its incident pairs; ``degrees`` ``entity`` and
    ``degree`` among the candidates. Pairs with both ends held out count twice, so costs are
    upper bounds, and what is kept of all ``total`` pairs is a lower one.
    """
    chosen = selected.select("entity").distinct()
    n = chosen.count()
    cost = lambda held: costs.join(held.select("entity"), "entity", "left_semi").agg(F.coalesce(F.sum("cost"), F.lit(0).cast("long")))
    own, other = cost(chosen).first()[0], cost(top_by(degrees, "entity", "degree", n)).first()[0]
    rows = [("selected", n, own, max(0, total - own)), ("top degree", n, other, max(0, total - other))]
    return costs.sparkSession.createDataFrame(rows, "choice string, entities long, cost long, kept long")
