"""Line numbers of files that are read in many tasks."""

import gzip
import json

from pyspark.sql import functions as F

from tessera.sources import numbered as N


def test_numbers_across_blocks(spark, tmp_path):
    """Files of many blocks, one compressed, with blank lines and lines longer than a block."""
    want = {}
    for name, n in (("a.txt", 5000), ("b.txt", 3), ("c.txt.gz", 400), ("d.txt", 0)):
        lines = ["" if k % 7 == 3 else "x" * 9000 if k % 1999 == 5 else f"{name} {k}" for k in range(n)]
        data = "".join(f"{x}\n" for x in lines).encode()
        (tmp_path / name).write_bytes(gzip.compress(data) if name.endswith("gz") else data)
        want |= {(name, k + 1): x for k, x in enumerate(lines)}
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "1024")
        out = N.numbered_lines(spark, str(tmp_path))
        rows = out.withColumn("task", F.spark_partition_id()).collect()
        tasks = spark.read.text(str(tmp_path)).select(F.spark_partition_id().alias("t")).distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert tasks > 10
    assert {(r.file.rsplit("/", 1)[-1], r.line): r.text for r in rows} == want and len(rows) == len(want)


def test_json_rows_keep_their_numbers(spark, tmp_path):
    (tmp_path / "f.jsonl").write_text('{"a": 1}\n\n  \n{"a": 2, "b": "x"}\nno json\n')
    rows = N.json_rows(spark, "a int, b string", str(tmp_path / "f.jsonl")).collect()
    assert sorted((r.line, r.a, r.b) for r in rows)[:2] == [(1, 1, None), (4, 2, "x")] and {r.line for r in rows} == {1, 4, 5}


def test_molecule_rows(spark, tmp_path):
    paths = {}
    for split, rows in {"train": [{"drug": " CC ", "Y": 1}, None, {"Drug": "N", "Y": 0}], "test": [{"drug": "", "Drug": "O", "Y": 1.0}, {"drug": "bad", "Y": 0}, {"Y": 1}]}.items():
        (tmp_path / split).mkdir()
        paths[split] = f"{tmp_path}/{split}/task.jsonl"
        (tmp_path / split / "task.jsonl").write_text("".join(f"{json.dumps(r) if r else ''}\n" for r in rows))
    canonical = lambda c: F.when(c != "bad", F.upper(c))
    out = [(r.split, r.line, r.raw, r.canonical, r.Y, r.valid) for r in N.molecule_rows(spark, paths, canonical).sort("split", "line").collect()]
    assert out == [("test", 1, "O", "O", 1.0, True), ("test", 2, "bad", None, 0.0, False), ("test", 3, None, None, 1.0, False), ("train", 1, "CC", "CC", 1.0, True), ("train", 3, "N", "N", 0.0, True)]
    assert N.molecule_rows(spark, paths, canonical, drop_invalid=True).count() == 3
