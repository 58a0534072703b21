import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A function: rows (doc_id, text) as a frame with the other columns of documents and one more."""

    def make(rows, schema="doc_id long, text string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, schema)
        for name, value in {"lang": "en", "source": "s", "n_lines": "clash", "n_tokens": "clash", "part": "clash", "node": "clash"}.items():
            if name not in df.columns:
                df = df.withColumn(name, F.lit(value))
        return df.withColumn("n_chars", F.length("text").cast("long"))

    return make


def words(n, seed=0):
    """A text of n invented words."""
    import random

    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(3, 8))) for _ in range(n))
