"""Mined negatives against an exhaustive search."""

import duckdb
import numpy as np
import pytest

from tessera.llm import negatives as N
from tessera.llm import queries
from pyspark.sql import functions as F


def brute(rows, step=100):
    rows = [(i, lab, v) for i, lab, v in rows if i is not None]
    dims = max((len(v) for _, _, v in rows), default=0)
    full = {i: (lab, np.array([*v, *[0] * (dims - len(v))], np.int64)) for i, lab, v in rows}
    out = set()
    for a, (label, q) in full.items():
        if a % step:
            continue
        order = sorted((-int(v @ q), i, lab) for i, (lab, v) in full.items() if i != a)
        for s, p, _ in [x for x in order if x[2] == label][:5]:
            inside = [(n, i) for n, i, lab in order if lab != label and 30 * -s <= 100 * -n <= 90 * -s]
            out |= {(a, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(inside[:10])}
    return out


def found(df):
    rows = [(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_op12_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM read_parquet('/root/testdata/sf0.001/embeddings.parquet')")
    names = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"
    want = con.execute(f"SELECT {names} FROM ({queries.ORACLE_SQL['op12_hard_negatives']})").fetchall()
    assert found(queries.QUERIES["op12_hard_negatives"](spark, "/root/testdata/sf0.001")) == set(want) and want


@pytest.mark.parametrize("block, group, dims", [(4096, 512, 7), (40, 3, 8), (25, 2, 1)])
def test_any_blocks_give_the_same(spark, monkeypatch, block, group, dims):
    """Ties, odd numbers of dimensions, one label with half of the rows, vectors of other lengths."""
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "GROUP", group)
    draw = np.random.default_rng(dims)
    rows = [(i, int(draw.integers(0, 4)) * (i % 2), draw.integers(-9, 10, dims - (i % 50 == 7 and dims > 1)).tolist()) for i in range(300)]
    rows += [(1000 + i, i % 3, rows[100][2]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label long, vector array<long>")
    assert found(N.mined(df, F.col("vec_id") % 20 == 0)) == brute(rows, 20)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [0.5, 1.0]), (1, 1, [1.0, 1.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.5, 0.5]), (3, None, [0.5, 0.5]), (4, 2, None), (5, 2, [0.5, None]), (6, 2, [nan, 0.1]), (7, 2, [inf, 0.1]), (None, 2, [0.5, 0.5]), (8, 2, []), (9, 3, [-0.001, 0.75])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, block string, group int")
    kept = N.whole_vectors(df, F.col("embedding"), 256)
    assert {(r.vec_id, r.label, tuple(r.vector)) for r in kept.collect()} == {(0, 1, (128, 256)), (1, 1, (256, 256)), (2, 2, (128, 128)), (8, 2, ()), (9, 3, (-1, 192))}
    assert found(N.mined(kept, F.col("vec_id") % 100 == 0)) == brute([(r.vec_id, r.label, r.vector) for r in kept.collect()])
    assert N.mined(kept.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_most_rows_are_never_scored(monkeypatch):
    """The bounds decide: on random vectors a small share of the rows is scored."""
    import pyarrow as pa

    draw = np.random.default_rng(1)
    x = np.floor(256 * draw.normal(0, 0.125, (4096, 64))).astype(int)
    t = N._packed(pa.table({"vec_id": np.arange(4096), "label": np.arange(4096) % 10, "vector": pa.array(list(x)), "block": pa.array([0] * 4096, pa.int32())}))
    block, scored = N._Block({c: t.column(c)[0].as_py() for c in t.column_names}), []
    exact = block.exact
    monkeypatch.setattr(block, "exact", lambda q, at: scored.append(len(at)) or exact(q, at))
    low, high = block.bounds(x[0])
    assert (low <= block.values @ x[0]).all() and (block.values @ x[0] <= high).all()
    ids, scores = N._positives(block, 0, 0, x[0], 5)
    list(N._negatives(block, 0, 0, x[0], list(zip(ids, scores)), (30, 90), 10))
    assert sum(scored) < 0.35 * 4096 * 6


def test_groups_sent_to_blocks_are_not_broadcast(spark):
    """A group's copies, one for each block, are many times its file: broadcast, they would all pass through the driver."""
    blocks = spark.range(3).select(F.col("id").cast("int").alias("block"), F.lit(b"x").alias("ids"))
    anchors = spark.range(20).select(F.col("id").alias("vec_id"), (F.col("id") % 2).cast("int").alias("group"))
    met = N._met(blocks, anchors, 3)
    assert {(r.block, r.group, len(r.anchors)) for r in met.collect()} == {(b, g, 10) for b in range(3) for g in range(2)}
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()
