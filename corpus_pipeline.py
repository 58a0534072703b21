"""A corpus pipeline: documents in, token counts and digests of the kept documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
to the shared folder and read again as the next one's ``docs``. All but the last return
the columns of ``documents``.

1. language_id: texts without a letter, or of no recognised language, go.
2. line_dedup: lines that match an earlier line go, and documents of which nothing is left.
3. near_duplicates: of each class of near-duplicates one document stays.
4. decontamination: documents that hold a passage of ``benchmark`` go.
5. bpe: ids are encoded and decoded; their number and digests are returned.

Defined cases: a null or empty text, or one without a letter, has no language and goes in stage 1.
Of repeated rows, which are near-duplicates of each other, one stays in stage 3. Documents without
an id are told apart by their texts; the last one of all ids is theirs. Documents of unknown
language that are recognised stay, whatever ``lang`` says. Other columns come through stages 1 to 4
as they are, whatever their names; stage 5 returns its own. An empty table gives an empty one with
the columns of stage 5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, decontaminate, langid, linedup, neardup
from tessera.llm.shared import table, written

STAGES = [
    ("language_id", langid.stage),
    ("line_dedup", linedup.stage),
    ("near_duplicates", neardup.stage),
    ("decontamination", decontaminate.stage),
    ("bpe", bpe.stage),
]

#: SQL can't express the model of the first stage, nor the last one's merges; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
