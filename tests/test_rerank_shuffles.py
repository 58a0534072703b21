"""Vectors are joined with the candidates, not carried through the search for them, and a query leaves few blocks."""

import re

from pyspark.sql import functions as F

from tessera import catalogue
from tessera.operators import neighbours as K
from tessera.operators import scores


def test_no_vectors_in_the_search(spark):
    plan = catalogue.QUERIES["reranked_votes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    searched = re.findall(r"FlatMapCoGroupsInArrow.*", plan)
    assert searched and all("_vec" not in line for line in searched)


def test_many_queries_meet_few_blocks(spark, monkeypatch):
    """Each block of sources gives k rows for a query, so 4,000 queries and 300 sources are one block of sources."""
    seen = []
    monkeypatch.setattr(K, "best_of_blocks", lambda asked, held, *rest: seen.append((asked, held)) or asked.crossJoin(held.limit(1).drop("block", "asked")))
    rows = lambda n, p: spark.range(n).select(F.col("id").alias(f"{p}_id"), F.array(F.col("id")).alias(f"{p}_fp"))
    K.block_candidates(rows(4000, "q"), rows(300, "s"), F.lit(1.0), scores.Tanimoto("q_fp", "s_fp"), 30)
    asked, held = seen[0]
    assert asked.count() == 4000 and held.count() == 300 * asked.select("asked").distinct().count()
