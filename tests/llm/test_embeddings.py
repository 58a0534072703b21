"""Near-duplicate vectors against a comparison of all pairs."""

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from tessera.llm import embeddings as E
from tessera.llm import queries


def brute(rows, least=0.9):
    """Links and least id of the component of each vector."""
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    dims = max((len(v) for v in good.values()), default=0)
    ids = sorted(good)
    x = np.array([np.r_[good[i], np.zeros(dims - len(good[i]))] for i in ids]).reshape(len(ids), -1)
    x = x / np.abs(x).max(1, keepdims=True, initial=1e-300)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = (x @ x.T >= least) & ~np.eye(len(ids), dtype=bool)
    root = np.array(ids)
    for _ in ids:
        new = np.array([min(root[k], root[hit[k]].min(initial=root[k])) for k in range(len(ids))])
        if (new == root).all():
            break
        root = new
    out = {i: (0, i, True) for i, _ in rows if i is not None}
    return out | {i: (int(hit[k].sum()), int(root[k]), bool(root[k] == i)) for k, i in enumerate(ids)}


def found(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def clustered(n, dims=24, seed=1):
    """Lone vectors, pairs, a large group of near copies, and exact and scaled copies."""
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, dims))
    x[n // 2 : n // 2 + n // 8] = x[: n // 8] + 0.15 * draw.normal(size=(n // 8, dims))
    x[-n // 4 :] = x[0] + 0.2 * draw.normal(size=(n // 4, dims))
    x[5], x[6], x[7], x[9] = x[11], x[11], 3 * x[11], x[n - 1]
    return [(int(i) * 3, v.astype(np.float32).tolist()) for i, v in zip(draw.permutation(n), x)]


@pytest.mark.parametrize("per_pivot, most", [(2048, 1 << 14), (100, 1 << 14), (200, 60)])
def test_links_in_shards_and_parts(spark, monkeypatch, per_pivot, most):
    monkeypatch.setattr(E, "PER_PIVOT", per_pivot)
    monkeypatch.setattr(E, "MOST", most)
    monkeypatch.setattr(E, "BATCH", 100)
    rows = clustered(600)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, node string, times int")
    out, recall = E.near_duplicates(df)
    got, want = found(out), brute([(i, np.float32(v).tolist()) for i, v in rows])
    assert recall >= 0.9
    links = [sum(x[0] for x in d.values()) for d in (got, want)]
    assert 0.98 * links[1] <= links[0] <= links[1]
    assert all(got[i][0] <= want[i][0] for i in want) and np.mean([got[i][1] == want[i][1] for i in want]) > 0.98


def test_op13_on_the_given_vectors(spark):
    rows = pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pylist()
    got = found(queries.QUERIES["op13_embedding_duplicates"](spark, "/root/testdata/sf0.001"))
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM read_parquet('/root/testdata/sf0.001/embeddings.parquet')")
    sql = con.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({queries.ORACLE_SQL['op13_embedding_duplicates']})").fetchall()
    assert got == brute([(r["vec_id"], r["embedding"]) for r in rows]) == {i: tuple(x) for i, *x in sql}


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1e300, 1e299]), (10, [5.0]), (11, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out, _ = E.near_duplicates(df)
    assert found(out) == {1: (3, 1, True), 2: (3, 1, False), 9: (3, 1, False), 10: (3, 1, False)} | {i: (0, i, True) for i in (3, 4, 5, 6, 7, 8, 11)}
    out, recall = E.near_duplicates(df.limit(0))
    assert out.collect() == [] and recall == 1.0
    out, _ = E.near_duplicates(spark.createDataFrame([(None, [1.0]), (1, [1.0])], "vec_id long, embedding array<double>"))
    assert found(out) == {None: (0, None, True), 1: (0, 1, True)}


def test_a_lost_file_is_an_error(tmp_path):
    from tessera.llm import mapped

    ids = np.arange(3)
    mapped.save(f"file://{tmp_path}", 0, ids=ids, times=ids, vectors=np.zeros((3, 2), "f4"), near=ids, near_at=np.arange(4), homes=np.zeros(6, np.int64))
    assert E.Graph(f"file://{tmp_path}", 2, "f4", {0: 3}, {}).get(ids, "ids").tolist() == [0, 1, 2]
    next(tmp_path.glob("*near.i8")).unlink()
    with pytest.raises(OSError):
        E.Graph(f"file://{tmp_path}", 2, "f4", {0: 3}, {}).get(ids, "ids")
