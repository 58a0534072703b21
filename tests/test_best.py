"""Best values of a stream equal those of the table, after restarts too."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.streaming import best as B

SCHEMA = "metric string, epoch long, value double, split string"


def strict(rows):
    """Rows that beat all before them."""
    out, best = [], {}
    by_step = {}
    for k, s, v in rows:
        if v is not None and v == v:
            by_step[k, s] = max(v, by_step.get((k, s), v))
    for (k, s), v in sorted(by_step.items(), key=lambda x: x[0][1]):
        if k not in best or v > best[k]:
            best[k] = v
            out.append((k, s, v))
    return sorted(out)


def run(spark, folder, sink, checkpoint, fail_at=None):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    out = B.improvements(stream, "metric", "epoch", "value")

    def take(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == fail_at:
            raise RuntimeError("the machine is gone after the write")

    query = out.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def test_best_so_far_after_a_restart(spark, tmp_path):
    draw, rows = random.Random(2), []
    folder, checkpoint, sink = f"file://{tmp_path}/in", f"file://{tmp_path}/check", B.BatchSink(f"file://{tmp_path}/out")
    for part in range(4):
        new = [(f"m{draw.randrange(3)}", 10 * part + draw.randrange(10), draw.choice([None, float("nan"), float(draw.randrange(50))]), "val") for _ in range(40)]
        rows += [r[:3] for r in new]
        spark.createDataFrame(new, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        if part == 1:
            with pytest.raises(Exception, match="gone after the write"):
                run(spark, folder, sink, checkpoint, fail_at=1)
    run(spark, folder, sink, checkpoint)
    got = sorted((r.key, r.step, r.value) for r in sink.rows(spark).collect())
    assert got == strict(rows)
    run(spark, folder, sink, checkpoint)
    assert sink.rows(spark).count() == len(got)


def test_aliases_are_written_twice(spark, tmp_path):
    df = spark.createDataFrame([("f1", 1, 0.5, "val/no_overlap"), ("f1", 1, 0.6, "val/a_seen_only"), ("f1", 1, 0.7, "val"), ("f1", 1, 0.8, None)], SCHEMA)
    sink = B.BatchSink(f"file://{tmp_path}/out", aliases=True)
    sink(df, 0)
    sink(df, 0)
    want = [("None", 0.8), ("val", 0.7), ("val/a_seen_only", 0.6), ("val/double_unseen", 0.5), ("val/no_overlap", 0.5), ("val/query_unseen", 0.6)]
    assert sorted((str(r.split), r.value) for r in sink.rows(spark).collect()) == want
    assert B.doubled(df.filter(F.lit(False))).count() == 0
