"""Edge cases of the operators on small frames."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import expressions as E
from tessera.functions import hashing as H
from tessera.functions import metrics as M
from tessera.operators import entities as E2
from tessera.operators import neighbours as K
from tessera.operators import pairing as P
from tessera.operators import selection as S
from tessera.sources import files


def one(df):
    return [tuple(r) for r in df.collect()]


def test_text_is_normalised_with_any_white_space(spark):
    df = spark.createDataFrame([("  Oral\t–  Dose ",), ("N/A",), ("",), (None,), ("nan",)], "x string")
    assert [r[0] for r in df.select(E.normal_text(F.col("x"))).collect()] == ["oral - dose", None, None, None, "nan"]
    assert [r[0] for r in df.select(E.is_missing_token(F.col("x"))).collect()] == [False, True, True, True, True]


def test_bucket_edges_differ(spark):
    df = spark.createDataFrame([(0.2,), (0.0,), (1.0,), (float("nan"),)], "v double")
    cuts = [0.2, 0.4, 0.6, 0.8]
    assert one(df.select(E.bucket_above(F.col("v"), cuts), E.bucket_from(F.col("v"), cuts)))[:3] == [(0, 1), (0, 0), (4, 4)]
    assert one(df.select(E.bucket_from(F.col("v"), cuts)))[3] == (255,)


def test_deadband(spark):
    df = spark.createDataFrame([(10.0,), (10.0000001,), (29.9999,), (30.0,)], "d double")
    assert [r[0] for r in df.select(E.deadband_label(F.col("d"))).collect()] == [1, None, None, 0]


def test_finite(spark):
    df = spark.createDataFrame([("12",), ("x",), ("NaN",), ("Infinity",), (None,)], "v string")
    assert [r[0] for r in df.select(E.finite(F.col("v"))).collect()] == [12.0, None, None, None, None]


def test_all_pairs_equals_a_nested_loop(spark):
    values = [(k, float(k * 7 % 40)) for k in range(23)]
    got = {tuple(r) for r in P.all_pairs(spark.createDataFrame(values, "id long, value double"), blocks=3).select("id_a", "id_b", "label").collect()}
    want = {(a, b, int(abs(u - v) <= 10)) for a, u in values for b, v in values if a < b and not 10 < abs(u - v) < 30}
    assert got == want


def test_blank_keys_pair_with_nothing(spark):
    df = spark.createDataFrame([(1, 0.0, " "), (2, 0.0, " "), (3, 0.0, None), (4, 1.0, "k"), (5, 2.0, "k")], "id long, value double, k string")
    assert one(P.same_key_pairs(df, ["k"]).select("id_a", "id_b")) == [(4, 5)]


def test_votes(spark):
    data = [(1, 1, 0.0), (1, 0, 0.0), (1, 1, 0.0), (2, 1, float("nan")), (2, 0, 1.0), (3, 1, 0.9), (3, 0, -1.0)]
    out = {r.q: (r.probability, r.predicted) for r in K.weighted_vote(spark.createDataFrame(data, "q int, y int, w double"), ["q"], "y", "w").collect()}
    assert math.isclose(out[1][0], 2 / 3) and out[2] == (0.5, 1) and out[3] == (1.0, 1)


def test_selection_ends_inside_a_range_of_keys(spark):
    data = [(g, f"{k:04x}{k * 37 % 11:02x}"[:6], k) for g in ("a", "b") for k in range(40)]
    df = spark.createDataFrame(data, "g string, key string, id long").withColumn("key", F.concat(F.lit("0000"), "key"))
    got = S.first_by_key(df, ["g"], "key", F.ceil(F.col("n") / 2), "id")
    assert {(r.g, r.id) for r in got.collect()} == {(g, k) for g in ("a", "b") for k in range(20)}


def test_allocation_of_nothing_and_of_too_much(spark):
    df = spark.createDataFrame([("x", 3), ("y", 1)], "s string, n long")
    assert S.largest_remainder(df, "s", "n", 0).count() == 0
    assert {r.s: r.quota for r in S.largest_remainder(df, "s", "n", 99).collect()} == {"x": 3, "y": 1}


def test_routing_ignores_the_order_of_ends(spark):
    pairs = spark.createDataFrame([(1, 2), (3, 4), (5, 6)], "id_a long, id_b long")
    out = S.routed(pairs, spark.createDataFrame([(2, 1)], "id_a long, id_b long"), spark.createDataFrame([(4,)], "id long"))
    assert {r.id_a: r.route for r in out.collect()} == {1: "eval", 3: "discard", 5: "train"}


def test_loops_in_the_graph(spark):
    pairs = spark.createDataFrame([("m", "m"), ("m", "n"), ("n", "m")], "a string, b string")
    assert sorted(one(S.incident_costs(pairs, "a", "b"))) == [("m", 4), ("n", 2)]
    assert sorted(one(S.support_graph(pairs, "a", "b"))) == [("m", "m", 1), ("m", "n", 2), ("n", "m", 2)]
    assert sorted(one(S.degrees(pairs, "a", "b"))) == [("m", 2), ("n", 1)]


def test_single_class_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "y int, p int")
    r = M.with_metrics(M.confusion(df, "y", "p", [])).first()
    assert (r.macro_f1, r.macro_f1_present, r.accuracy) == (0.5, 1.0, 1.0)
    assert M.auroc(df.withColumn("s", F.lit(0.5)), "y", "s", []).first().auroc is None


def test_priority_is_blake2_xor_seed(spark):
    got = spark.createDataFrame([("a|b",), (None,)], "x string").select(H.priority64(13)(F.col("x"))).collect()
    want = int.from_bytes(hashlib.blake2b(b"a|b", digest_size=8).digest(), "big") ^ 13
    assert [r[0] for r in got] == [f"{want:016x}", None]


def test_json_has_sorted_keys_and_nulls(spark):
    df = spark.createDataFrame([('say "x"', None)], "b string, a string")
    assert df.select(E.json_text({"b": F.col("b"), "a": F.col("a")})).first()[0] == '{"a": null, "b": "say \\"x\\""}'


def test_json_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "Y int, drug string")
    files.write_json_lines(df, str(tmp_path / "j"))
    assert sorted(one(files.read_json_lines(spark, "Y int, drug string", str(tmp_path / "j"))), key=str) == [(1, "x"), (2, None)]
    files.write_records(df, str(tmp_path / "p"), rows_per_file=1)
    assert files.read_records(spark, str(tmp_path / "p"), columns=["Y"]).count() == 2


def test_species(spark):
    from tessera.functions.species import species

    cases = {"guinea pigs": "rodent", "non-human primates": "monkey", "rats and dogs": None, "gooseberry": "bird", "animals": None, "controls": "human", "healthy control group of rats": "rodent", "Not Specified": None, None: None, "  Wistar\tRats ": "rodent"}
    df = spark.createDataFrame([(x,) for x in cases], "x string")
    assert {r.x: r.s for r in df.select("x", species(F.col("x")).alias("s")).collect()} == cases


def test_stream_of_predictions_equals_the_table(spark, tmp_path):
    import datetime as dt

    from tessera.streaming.metrics import windowed_confusion

    rows = [(dt.datetime(2024, 1, 1, 0, k), k % 2, k % 3 % 2, "a") for k in range(30)]
    schema = "ts timestamp, y int, p int, s string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    of = lambda d: windowed_confusion(d, "ts", "y", "p", ["s"], "10 minutes", "1 hour")
    q = of(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.outputMode("update").format("memory").queryName("confusion").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(spark.table("confusion").collect()) == sorted(of(spark.read.schema(schema).parquet(str(tmp_path / "in"))).collect())


def test_json_is_what_python_writes(spark):
    import json

    texts = ["plain", 'say "x" \\', "line\nbreak\ttab\r\b\f", "é ü — 日本", "😀 x", "\x01\x1f\x7f", ""]
    df = spark.createDataFrame([(x, 1.5) for x in texts], "t string, v double")
    for r in df.select("t", E.json_text({"t": F.col("t"), "v": F.col("v")}, numbers=("v",)).alias("j")).collect():
        assert r.j == json.dumps({"t": r.t, "v": 1.5}, sort_keys=True)


def test_positions_and_folds_equal_a_global_order(spark):
    rows = [(k % 3, hashlib.sha256(str(k).encode()).hexdigest(), k) for k in range(200)] + [(None, "00", 900), (None, "01", 901)]
    df = spark.createDataFrame(rows, "g int, key string, id long")
    got = {r.id: (r.position, r.n_group) for r in S.positions(df, ["g"], "key", "id").collect()}
    for g in (0, 1, 2, None):
        own = sorted((key, i) for h, key, i in rows if h == g)
        assert {i: (at, len(own)) for at, (_, i) in enumerate(own)} == {i: got[i] for _, i in own}
    few = spark.createDataFrame([(0, f"{k:02x}", k) for k in range(3)], "g int, key string, id long")
    assert sorted(r.fold for r in S.folds(few, "g", "key", 5).collect()) == [0, 1, 2]


def test_sampled_pairs_never_repeat(spark):
    df = spark.createDataFrame([(k, k % 2, f"{k * 7919 % 65536:04x}") for k in range(61)], "id long, g int, key string")
    for fraction, want in ((1.0, 31 * 30 // 2 + 30 * 29 // 2), (0.1, 47 + 44)):
        got = [tuple(sorted((r.id_a, r.id_b))) for r in P.sampled_pairs(df, ["g"], "key", fraction).collect()]
        assert len(got) == len(set(got)) == want and all(a != b and a % 2 == b % 2 for a, b in got)


def test_sampled_pairs_are_spread(spark):
    """Groups whose pairs number as many as divide a power of two less one, and a null group: no draw keeps to the first records."""
    rows = [(1000 * g + k, None if g == 3 else f"g{g}", hashlib.sha256(f"{g}|{k}".encode()).hexdigest()) for g, n in enumerate((12, 22, 63, 63, 2, 1)) for k in range(n)]
    df = spark.createDataFrame(rows, "id long, g string, key string")
    place = {i: p for g in {r[1] for r in rows} for p, (_, i) in enumerate(sorted((r[2], r[0]) for r in rows if r[1] == g))}
    for seed in (0, 1, 2):
        drawn = {}
        for r in P.sampled_pairs(df, ["g"], "key", 0.05, seed).collect():
            drawn.setdefault(r.g, set()).add((place[r.id_a], place[r.id_b]))
        assert {g: len(x) for g, x in drawn.items()} == {"g0": 4, "g1": 12, "g2": 98, None: 98, "g4": 1}
        assert all(0 <= a < b for x in drawn.values() for a, b in x)
        assert drawn["g2"] != drawn[None] and all(len({e for p in drawn[g] for e in p}) >= 50 for g in ("g2", None))
        assert len({e for p in drawn["g1"] for e in p}) >= 12


def test_permutations_of_any_size(spark):
    """Every number once; numbers near 2^63 don't overflow."""
    for n in (1, 2, 3, 10, 66, 1953, 5000):
        got = [r[0] for r in spark.range(n).select(P.permuted(F.col("id"), F.lit(n).cast("long"), 7, F.lit("t"))).collect()]
        assert sorted(got) == list(range(n)) and (n < 10 or got != sorted(got))
    n = 3_000_000_000 * 2_999_999_999 // 2
    got = [r[0] for r in spark.range(1000).select(P.permuted(F.col("id") * F.lit(n // 1000), F.lit(n), 7)).collect()]
    assert len(set(got)) == 1000 and all(0 <= x < n for x in got) and len({x * 10 // n for x in got}) == 10


def test_first_by_key_keeps_null_groups(spark):
    df = spark.createDataFrame([(k, None if k % 2 else "g", f"{k * 7919 % 65536:04x}") for k in range(40)], "id long, g string, key string")
    got = {r.id for r in S.first_by_key(df, ["g"], "key", F.ceil(F.col("n") / 4), "id").collect()}
    want = {i for odd in (0, 1) for _, i in sorted((f"{k * 7919 % 65536:04x}", k) for k in range(40) if k % 2 == odd)[:5]}
    assert got == want


def test_shrunk_moves_the_largest_first(spark):
    rows = [(k, n, f"{k:04x}") for k, n in enumerate([5, 1, 5, 3, 3, 3, 2])]
    df = spark.createDataFrame(rows, "id long, n long, key string")
    for cap in (0, 7, 12, 22, 30):
        left, want = sum(n for _, n, _ in rows), set()
        for i, n, _ in sorted(rows, key=lambda r: (-r[1], r[2])):
            if left > cap:
                want.add(i)
                left -= n
        assert {r.id for r in S.shrunk(df, "n", "key", "id", cap).filter("moved").collect()} == want


def test_manifest_fails_above_its_bound(spark, tmp_path):
    import pytest

    assert '"id": 2' in files.manifest(spark.range(3), most=3)
    with pytest.raises(ValueError):
        files.manifest(spark.range(4), most=3)
    csv, text = files.written_tables(spark.createDataFrame([(2, "a,b"), (1, None)], "k int, v string"), ["k"])
    assert csv == 'k,v\n1,\n2,"a,b"\n' and text.splitlines()[1:] == ["| --- | --- |", "| 1 |  |", "| 2 | a,b |"]


def test_merging_fails_for_a_missing_key(spark):
    import pytest

    from tessera.operators import results as R

    main, other = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, 0.5)], "k int, m double")
    assert one(R.merged(main.filter("k = 1"), other, ["k"], ["m"])) == [(1, 0.5)]
    with pytest.raises(Exception, match="no results for 2"):
        R.merged(main, other, ["k"], ["m"]).collect()


def test_fingerprints_of_more_than_64_numbers(spark):
    df = spark.createDataFrame([([1.0] * 65 + [-1.0],)], "v array<double>")
    assert df.select(K.sign_bits(F.col("v"))).first()[0] == [-1, 1]


def blake(size, *parts):
    return hashlib.blake2b("|".join(map(str, parts)).encode(), digest_size=size).digest()


def test_stable_ids(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "x string, i long")
    assert [r[0] for r in df.select(H.stable_id(F.col("x"), F.col("i"))).collect()] == [blake(12, "a", 1).hex(), blake(12, None, 2).hex()]


def test_sampled_rows_by_priority(spark):
    rows = [(s, f"p{k}", f"s{k // 2}" if k % 5 else None, k % 2, ["a_to_b", "b_to_a", None][k % 3]) for k in range(60) for s in ("train", "test", "validation_1")]
    df = spark.createDataFrame(rows, "split string, pair string, source string, label int, direction string")
    priority = lambda seed, *parts: seed ^ int.from_bytes(blake(8, *parts), "big")
    c = {n: F.col(n) for n in df.columns}

    def kept(strategy="random", source=None, ways=False):
        shown = H.kept_row(c["split"], c["pair"], c["label"], 7, {"train": 0.5, "test": 0.25}, strategy, c["source"], source, c["direction"] if ways else None)
        return {tuple(r) for r in df.filter(shown).collect()}

    def want(strategy="random", source=None, ways=False):
        for r in rows:
            split, pair, src, label, way = r
            key = lambda base: ("train_label", label, base) if strategy == "label_stratified" else ("train", base)
            if split == "train" and (source is not None or ways):
                base = src or pair
                ok = source is None or source >= 1 or priority(7, *key(base)) % 10**6 < int(source * 10**6)
                ok = ok and (not ways or way is None or way == ("a_to_b" if priority(7, "direction", base) % 2 == 0 else "b_to_a"))
            elif split == "train":
                ok = priority(7, *key(pair)) % 10**6 < 500_000
            else:
                ok = split != "test" or priority(7, "test", pair) % 10**6 < 250_000
            if ok:
                yield r

    for how in ({}, {"strategy": "label_stratified"}, {"source": 0.4}, {"source": 0.4, "ways": True, "strategy": "label_stratified"}, {"ways": True}):
        assert kept(**how) == set(want(**how)), how


def test_entities(spark):
    rows = [(k, [None, "a", "b", "c", "d"][k * 7 % 5]) for k in range(3, 40)]
    df = spark.createDataFrame(rows, "id long, e string")
    table = E2.entity_table(df, "id", "e")
    order = list(dict.fromkeys(e for _, e in rows if e))
    assert {r.e: r.entity_id for r in table.collect()} == {e: k for k, e in enumerate(order)}
    known = df.filter("e is not null")
    assert {(r.id, r.entity_id) for r in E2.with_entity_ids(known, table, "e").collect()} == {(i, order.index(e)) for i, e in rows if e}
    with pytest.raises(Exception, match="a record has no e"):
        E2.with_entity_ids(df, table, "e").collect()


def test_top_by_and_costs(spark):
    rows = [(f"e{k}", [5, 3, 3, 3, 3, 1][k % 6], 10 * k) for k in range(30)]
    degrees = spark.createDataFrame([r[:2] for r in rows], "entity string, degree long")
    costs = spark.createDataFrame([(r[0], r[2]) for r in rows], "entity string, cost long")
    for n in (0, 3, 5, 8, 25, 30, 40):
        want = [e for e, d, _ in sorted(rows, key=lambda r: (-r[1], hashlib.sha256(r[0].encode()).hexdigest()))][:n]
        assert {r.entity for r in E2.top_by(degrees, "entity", "degree", n).collect()} == set(want)
    out = {r.choice: r for r in E2.holdout_costs(costs, degrees, costs.filter("cost < 50"), 1000).collect()}
    want = sorted(rows, key=lambda r: (-r[1], hashlib.sha256(r[0].encode()).hexdigest()))[:5]
    assert (out["selected"].entities, out["selected"].cost, out["selected"].kept) == (5, 100, 900)
    assert out["top degree"].cost == sum(r[2] for r in want)


def test_sorted_lists_and_unions(spark, tmp_path):
    df = spark.createDataFrame([(" b ",), ("a",), (None,), ("",), ("b",), ("\u00e9",)], "x string")
    files.write_sorted_list(df, "x", f"{tmp_path}/list")
    assert [r.value for r in spark.read.text(f"{tmp_path}/list").collect()] == ["a", "b", "\u00e9"]
    a, b = spark.createDataFrame([(1, "x")], "k long, m string"), spark.createDataFrame([(2, 0.5)], "k long, v double")
    out = files.unioned(a, b)
    assert out.columns == ["k", "m", "v"] and sorted(map(tuple, out.collect())) == [(1, "x", None), (2, None, 0.5)]
    assert files.written_tables(out, ["k"])[0] == "k,m,v\n1,x,\n2,,0.5\n"



def test_logs_and_layouts(spark, tmp_path):
    import pytest

    from tessera.sources import layouts, logs

    (tmp_path / "run.log").write_text("x {'eval_val_auroc': '0.5',\n 'eval_val_f1': 'nan?', 'epoch': '1.0'} {'epoch': '2'} {}\n{'loss': '3', 'learning_rate': '4d', 'epoch': '1'}")
    got = logs.run_metrics(logs.read_logs(spark, str(tmp_path / "run.log"))).collect()
    assert sorted(tuple(r) for r in got) == [(1.0, "train", "loss", 3.0), (1.0, "val", "auroc", 0.5)]
    spark.range(7).coalesce(1).write.parquet(f"{tmp_path}/d/validation_1")
    spark.range(3).write.json(f"{tmp_path}/d/test.jsonl")
    part = next((tmp_path / "d/validation_1").glob("part-*.parquet"))
    part.rename(part.with_name("part-00000.parquet"))
    (tmp_path / f"d/validation_1/.{part.name}.crc").unlink()
    path = layouts.record_split_path(spark, f"{tmp_path}/d", "valid")
    assert path.endswith("/validation_1/part-00000.parquet") and layouts.row_count(spark, path) == 7
    assert layouts.read_split(spark, f"{tmp_path}/d", "test").count() == 3 and layouts.read_split(spark, f"{tmp_path}/d", "validation_1", rows=2).count() == 2
    with pytest.raises(ValueError):
        layouts.split_name("dev")
    with pytest.raises(FileNotFoundError):
        layouts.record_split_path(spark, f"{tmp_path}/d", "train")


def test_strict_ends_fail(spark):
    import pytest

    records = spark.createDataFrame([(1, "x"), (2, "y")], "id long, name string")
    for pair, fault in (((1, 3, "x", "z"), "no record 3"), ((1, 2, "x", "x"), "another record under 2")):
        rows = spark.createDataFrame([pair], "id_a long, id_b long, name_a string, name_b string")
        with pytest.raises(Exception, match=fault):
            P.strictly_materialised(rows, records, "name").collect()


def test_whole_metrics_of_one_slice(spark):
    df = spark.createDataFrame([(1, 2.0), (1, -1.0), (0, -2.0), (0, None), (1, float("nan"))], "y int, x double")
    r = M.binary_metrics(df, "y", "x", []).first()
    assert (r.auroc, r.parse_rate, r.n, r.label_A_predicted, r.label_B_predicted, r.label_B_recall) == (1.0, 0.6, 3, 1, 2, 1.0)
    slices = spark.createDataFrame([(None, 1, 1.0), ("a", 0, 1.0)], "g string, y int, x double")
    assert {(r.g, r.accuracy, r.auroc) for r in M.binary_metrics(slices, "y", "x", ["g"]).collect()} == {(None, 1.0, None), ("a", 0.0, None)}


def test_neighbours_in_any_number_of_blocks(spark):
    values = [(k, float(k * 37 % 50)) for k in range(50)]
    sources = spark.createDataFrame(values, "s_id long, s_v double")
    queries = spark.createDataFrame(values[::7], "q_id long, q_v double")
    score = -F.abs(F.col("q_v") - F.col("s_v"))
    want = {(q, s, r + 1) for q, v in values[::7] for r, (_, s) in enumerate(sorted((abs(v - w), s) for s, w in values)[:4])}
    for sizes in ({}, {"least": 1, "per_block": 9, "asked_at_once": 2}):
        got = K.candidates(queries, sources, score, 4, **sizes).select("q_id", "s_id", "rank")
        assert {tuple(r) for r in got.collect()} == want


def test_all_pairs_adds_blocks_for_many_records(spark):
    rows = spark.createDataFrame([(k, k * 100.0) for k in range(30)], "id long, value double")
    out = P.all_pairs(rows, blocks=1, per_block=4)
    assert out.count() == out.select("id_a", "id_b").distinct().count() == 30 * 29 / 2
