"""Universes, counted writes, capped splits and table checks."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import checks as C
from tessera.plans import record_splits as R
from tessera.plans import universes as U
from tessera.sources import observed as O

UNIVERSES = {"all_g": ["g"], "same_h": ["g", "h"], "same_k": ["g", "k"]}


def records(spark, n=60):
    rows = [(i, float(i * 13 % 47), f"g{i % 3}", [f" h{i % 4}", None, " "][0 if i % 5 else 1 + i % 2], f"k{i % 2}") for i in range(n)]
    return spark.createDataFrame(rows, "id long, value double, g string, h string, k string"), rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_universes_share_one_join(spark):
    df, rows = records(spark)
    pairs = U.universe_pairs(df, UNIVERSES)
    assert plan(pairs).count("Join") == 1
    got = {(r.id_a, r.id_b): r.universes for r in pairs.collect()}
    want = {}
    for i, (a, va, ga, ha, ka) in enumerate(rows):
        for b, vb, gb, hb, kb in rows[i + 1 :]:
            if ga == gb and not 10 < abs(va - vb) < 30:
                same_h = bool(ha and hb and ha.strip() and ha.strip() == hb.strip())
                want[a, b] = 1 + 2 * same_h + 4 * (ka == kb)
    assert got == want
    loose = U.universe_pairs(df, {"none": [], "same_g": ["g"]})
    assert {r.universes for r in loose.collect()} == {1, 3}
    with pytest.raises(ValueError):
        U.universe_pairs(df, {})


def test_routes_and_folders(spark, tmp_path):
    df, _ = records(spark)
    pairs = U.universe_pairs(df, UNIVERSES)
    picked = pairs.filter("(id_a + id_b) % 9 = 0").select(F.col("id_b").alias("id_a"), F.col("id_a").alias("id_b"))
    routes = U.routed_universes(pairs, picked, df.filter("id % 11 = 0").select("id"), list(UNIVERSES))
    held = {(r.universe, r.id_a, r.id_b): r.route for r in routes.collect()}
    assert all((route == "eval") == ((a + b) % 9 == 0) for (_, a, b), route in held.items())
    missing = {(r.universe, r.id_a, r.id_b) for r in U.missing_selections(routes, picked, list(UNIVERSES)).collect()}
    assert missing == {(u, a, b) for (v, a, b), route in held.items() if v == "all_g" and route == "eval" for u in UNIVERSES if (u, a, b) not in held}
    paths = {n: f"file://{tmp_path}/{n}" for n in UNIVERSES}
    U.write_universes(routes, paths, f"file://{tmp_path}/journal", f"{tmp_path}/staging")
    for n in UNIVERSES:
        back = {(n, r.id_a, r.id_b): r.route for r in spark.read.parquet(f"{tmp_path}/{n}").collect()}
        assert back == {k: v for k, v in held.items() if k[0] == n} and back


def test_counts_of_a_write_equal_a_recount(spark, tmp_path):
    rows = [(i, [None, "a", "b", "c"][i % 4], i % 2, float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g string, y int, v double").repartition(7)
    kept = F.when(F.col("id") > 300, None).otherwise(F.col("id") % 3 != 0)
    out = O.write_counted(df, f"{tmp_path}/out", kept, {"g": ["a", "b"], "y": [0, 1]}, {"v": F.col("v")})
    kept_rows = [r for r in rows if r[0] <= 300 and r[0] % 3]
    for side, own in (("before", rows), ("after", kept_rows)):
        assert out[side]["rows"] == len(own) and out[side]["sums"]["v"] == sum(r[3] for r in own)
        assert out[side]["g"] == {"a": sum(r[1] == "a" for r in own), "b": sum(r[1] == "b" for r in own), "null": sum(r[1] is None for r in own), "other values": sum(r[1] == "c" for r in own)}
        assert out[side]["y"] == {"0": sum(r[2] == 0 for r in own), "1": sum(r[2] == 1 for r in own), "null": 0, "other values": 0}
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(kept_rows)
    assert json.loads(O.manifest_text(out, policy="as planted", columns={"v", "g"}))["columns"] == ["g", "v"]
    with pytest.raises(Exception, match="exist"):
        O.write_counted(df, f"{tmp_path}/out", kept, {})
    empty = O.write_counted(df.limit(0), f"{tmp_path}/none", kept, {"g": ["a"]})
    assert empty["before"] == {"rows": 0, "g": {"a": 0, "null": 0, "other values": 0}}


def test_a_write_reads_its_input_once(spark, tmp_path):
    """Every row passes an accumulator once, with counts before and after."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    O.write_counted(spark.range(100).repartition(3).select(counted("id").alias("id")), f"{tmp_path}/out", F.col("id") >= 0, {"id": [1, 2]}, {"id": F.col("id")})
    assert seen.value == 100


def test_split_outputs(spark, tmp_path):
    rows = [(f"e{i % 40}", float(i % 7), i) for i in range(400)] + [(None, 1.0, 999)]
    df = spark.createDataFrame(rows, "e string, v double, i long")
    number = F.substring("e", 2, 9).cast("int")
    entities = R.labelled_entities(df.filter("e is not null"), "e", "v", 3.0)
    splits = R.capped_splits(entities, "e", number % 10 == 0, number % 10 <= 3, {"validation_1": 30, "test": 20}, 5)
    held = {r.e: r for r in splits.collect()}
    assert len(held) == 40
    sizes = {}
    for r in held.values():
        sizes[r.final] = sizes.get(r.final, 0) + r.n
        assert r.final == ("train" if r.moved else r.split)
    assert sizes["test"] == 20 and sizes["validation_1"] == 30 and sizes["validation_2"] == 60
    report = {(r.stage, r.split): r for r in R.split_report(splits).collect()}
    assert report["capped", "test"].rows == 20 and report["assigned", "test"].rows == 40 and report["assigned", "test"].moved == 2
    out = R.split_outputs(df, splits, "e")
    R.write_splits(out, f"file://{tmp_path}/splits")
    back = {n: spark.read.parquet(f"{tmp_path}/splits/{n}").collect() for n in out}
    assert sum(len(v) for n, v in back.items() if n.startswith("full")) == 400
    assert {r.e: r.Y for n, v in back.items() if n.startswith("entities") for r in v} == {e: r.label for e, r in held.items()}
    assert all(held[r.e].final == n.split("/")[1] for n, v in back.items() for r in v)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (2, None, 1.0), (None, "c", 2.0), (4, "d", None)], "i long, s string, y double")
    assert {r.fault: r.n for r in C.fault_counts(df, ["i", "s"], ["y"]).collect()} == {"null i": 1, "null s": 1, "non-binary y": 2}
    assert {r.n for r in C.fault_counts(df.limit(0), ["i"], ["y"]).collect()} == {0}
    assert C.asserted(df.filter("i < 2"), ["i", "s"], ["y"]).count() == 1
    for part, said in (("i = 2", "null s"), ("i is null", "null i"), ("i = 4", "non-binary y")):
        with pytest.raises(Exception, match=f"queries: {said}"):
            C.asserted(df.filter(part), ["i", "s"], ["y"], "queries").collect()
    with pytest.raises(ValueError, match="lack the columns z"):
        C.asserted(df, ["z"], [])
    C.disjoint(df.filter("i = 1"), df.filter("i = 2 or i is null"), "i")
    with pytest.raises(ValueError):
        C.disjoint(df, df.filter("i = 4"), "i")
    flags = spark.createDataFrame([(True,), (False,)], "y boolean")
    assert C.asserted(flags, [], ["y"]).count() == 2
