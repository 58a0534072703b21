"""Large families, long items and deep pages: what must stay whole, and linear, at size."""

import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import decontaminate, html, linedup, mapped, resample

from . import brute
from .conftest import words


@pytest.mark.parametrize("leaders", [(4, 64), (1, 3), ()])
def test_family_of_line_variants_is_exact(documents, monkeypatch, leaders):
    monkeypatch.setattr(linedup, "LEADERS", leaders)
    draw, base, pool = random.Random(2), words(24, 1).split(), words(40, 9).split()
    rows = []
    for k in range(90):
        line = [*base]
        for at in draw.sample(range(24), draw.randint(0, 6)):
            line[at] = draw.choice(pool)
        rows.append((k, f"{' '.join(line)}\nown {words(6, 500 + k)}"))
    assert {r.doc_id: r.text for r in linedup.dedup_lines(documents(rows)).collect()} == brute.line_dedup(rows)


def test_keys_are_sharded_as_spark_does(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 123456789]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k long").select(F.xxhash64("k")).collect()]
    assert got == mapped.xxhash64(np.array(keys, np.int64).view(np.uint64)).view(np.int64).tolist()
    table = mapped.build(spark.range(1000).selectExpr("id as key", "id * 2 as v"), 1000, "test", {"v": "i8"}, shard_rows=50)
    assert (table.get(np.arange(1200, dtype=np.uint64), "v", -1) == [2 * k if k < 1000 else -1 for k in range(1200)]).all()


def test_every_pattern_of_a_partly_quoted_item_is_found(documents):
    item = words(60, 4).split()
    rows = []
    for k, gone in enumerate(itertools.combinations(range(20), 3)):
        rows.append((k, " ".join(["before"] * 3 + ["changed" if i in gone else x for i, x in enumerate(item[20:40])] + ["after"] * 25)))
    bench = documents([(1, " ".join(item))]).withColumnRenamed("doc_id", "item_id")
    found = {r.doc_id for r in decontaminate.contaminated(documents(rows), bench).collect()}
    assert found == {k for k, _ in rows} and len(rows) == 1140


@pytest.mark.parametrize("most", [decontaminate.MOST_BROADCAST, 0])
def test_very_long_items_and_documents(documents, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", most)
    item = words(20_000, 8).split()
    rows = [(1, " ".join(item)), (2, words(20_000, 9)), (3, " ".join(["x"] * 9 + item[-15:])), (4, " ".join(item[7_000:7_021]))]
    bench = documents([(1, " ".join(item)), (2, " ".join(item[:11]))]).withColumnRenamed("doc_id", "item_id")
    found = sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(documents(rows), bench).collect())
    assert found == [(1, 1), (1, 2), (4, 1)]


def test_deep_pages_are_linear(spark):
    page = "".join(f"<div class='a{k % 3}'>x{k}" for k in range(10_000))
    began = time.process_time()
    read = html.Page(page)
    assert len(read.keys("h")) == 10_001 and len(read.texts()) == 10_000
    assert time.process_time() - began < 5
    rows = [(1, "http://d.example", page), (2, "http://d.example", "<p>" + "long " * 200_000)]
    out = {r.page_id: r.n_chars for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {1: sum(len(f"x{k}") + 1 for k in range(10_000)) - 1, 2: 5 * 200_000 - 1}


def test_scores_of_any_size_are_ordered(spark):
    scores = [0.0, -0.0, 1e-300, -1e-300, 1e300, -1e300, 1.0, 1.0 + 2**-52, float("inf"), float("-inf"), -1.0]
    df = spark.createDataFrame([(x,) for x in scores], "s double")
    for k in range(1, len(scores) + 1):
        least = sorted(scores, reverse=True)[k - 1]
        assert sorted(r.s for r in resample.top(df, k, "s").collect()) == sorted(x for x in scores if x >= least)


def test_a_lost_shard_is_an_error(spark):
    """A shard whose keys are gone, or cut short, isn't an empty one."""
    from pathlib import Path

    from pyspark.sql import functions as F

    for cut in (0, 8):
        table = mapped.build(spark.range(1000).select(F.col("id").alias("key"), "id"), 1000, "lost", {"id": "i8"}, shard_rows=100)
        file = next(Path(table.path.removeprefix("file://")).glob("*.keys.u8"))
        data = file.read_bytes()
        file.unlink()
        if cut:
            file.write_bytes(data[:-cut])
        with pytest.raises(OSError):
            table.get(np.arange(1000).astype(np.uint64), "id")
