"""Embedding near-duplicates: a robust-pruned flat graph, built in overlapping shards.

Pivots drawn from the vectors part them into shards, so that a dense region gets as many
pivots as it has vectors; each vector goes to the shards of its ``OVERLAP`` nearest pivots.
In a shard, nearest neighbours and far ones are robustly pruned and links put back in both
directions. The lists of a vector's shards are united. Vectors and lists are written as
arrays by home shard and mapped by workers.

Every vector is then a query: a greedy search goes from the medoids of its shards to its
neighbourhood, and the range is expanded from there until no new vector within reach
turns up, for a batch of neighbouring queries together. What is found is verified in double
precision. A batch gives the number of links of each query, and one edge to the least id of
its own components, never all pairs. Recall is audited against an exhaustive comparison of
some queries, and the search repeated with a wider beam where it is low.

Exact copies are one vector with a multiplicity. Defined cases: a vector that is null, zero
or holds a null or non-finite component links with nothing; vectors of different
lengths count as filled up with zeros; of rows with one id the one with the least vector counts; one without an id links with nothing, either.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import mapped
from .components import components
from .shared import give_back, lean, shared_path, table, written

#: Vectors a pivot, pivots at most, shards of a vector; beyond so many vectors a shard is cut by hash, each vector in two parts.
PER_PIVOT, MOST_PIVOTS, OVERLAP, MOST = 2048, 1 << 16, 2, 1 << 14
#: Links of a vector to near ones, to far ones, and back; candidates of each; what a detour may be longer (robust pruning).
NEAR, FAR, BACK, CANDIDATES, ALPHA = 16, 4, 12, 32, 1.2
#: Queries of a batch, and bits of a vector's place in its home shard.
BATCH, PLACE = 512, 32
#: Widths of the beam, one after the other while recall is below; queries of the audit; what the range is wider by while it is expanded.
BEAMS, RECALL, AUDITED, SLACK = (12, 48, 192), 0.98, 256, 0.05


def _rows(column, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that squares neither overflow nor vanish; exact."""
    x = x.astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True, initial=0))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)).astype(np.float32)


def pruned(x: np.ndarray, own: np.ndarray, among: np.ndarray, degree: int) -> np.ndarray:
    """Of the candidates ``among`` (owner, candidate; -1: none) those that no nearer kept one is near to; -1 where fewer."""
    held = x[np.maximum(among, 0)]
    to = np.einsum("bd,bld->bl", x[own], held)
    between = held @ held.transpose(0, 2, 1)
    alive, out, at = (among >= 0) & (among != own[:, None]), np.full((len(own), degree), -1, np.int64), np.arange(len(own))
    for k in range(degree):
        best = np.where(alive, to, -3).argmax(1)
        some = alive[at, best]
        out[some, k] = among[at, best][some]
        # distances are squared: 2 - 2 cos
        alive &= ALPHA**2 * (1 - between[at, best]) > 1 - to
        alive[at, best] = False
    return out


def linked(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (from, to) among the unit vectors ``x`` of a shard."""
    n, draw, out = len(x), np.random.default_rng(seed), []
    for begin in range(0, n, BATCH):
        own = np.arange(begin, min(begin + BATCH, n))
        likeness = x[own] @ x.T
        likeness[np.arange(len(own)), own] = -3
        k = min(CANDIDATES, n - 1)
        near = np.argpartition(-likeness, k - 1, axis=1)[:, :k] if k else np.full((len(own), 1), -1)
        if k:
            out.append((likeness.argmax(1), own))  # whatever is pruned, a vector is linked from its nearest one
        far = draw.integers(0, n, (len(own), CANDIDATES))
        both = np.concatenate([pruned(x, own, near, NEAR), pruned(x, own, far, FAR)], 1)
        out.append((np.repeat(own, both.shape[1])[both.ravel() >= 0], both.ravel()[both.ravel() >= 0]))
    a, b = (np.concatenate([o[k] for o in out]) for k in range(2)) if out else (np.zeros(0, np.int64),) * 2
    order = np.lexsort((-np.einsum("ed,ed->e", x[a], x[b]), b))
    source, target = a[order], b[order]
    turn = np.arange(len(target)) - np.searchsorted(target, target)
    few = turn < CANDIDATES
    lists = np.full((n, CANDIDATES), -1, np.int64)
    lists[target[few], turn[few]] = source[few]
    back = np.concatenate([pruned(x, np.arange(k, min(k + BATCH, n)), lists[k : k + BATCH], BACK) for k in range(0, n, BATCH)])
    some = back >= 0
    a, b = np.r_[a, np.repeat(np.arange(n), BACK)[some.ravel()]], np.r_[b, back[some]]
    return np.divmod(np.unique(a * n + b), n)


class Graph:
    """The united graph in the shared folder; a vector's key is its home shard and its place there."""

    def __init__(self, path: str, dims: int, kind: str, sizes: dict[int, int], medoids: dict[int, int]):
        self.path, self.dims, self.kind, self.sizes, self.medoids = path, dims, kind, sizes, medoids
        self.open: dict[int, dict[str, np.ndarray]] = {}

    def shard(self, s: int) -> dict[str, np.ndarray]:
        if s not in self.open:
            if len(self.open) >= 64:
                del self.open[next(iter(self.open))]
            types = {"ids": "i8", "times": "i8", "vectors": self.kind, "near": "i8", "near_at": "i8", "homes": "i8"}
            held = {k: mapped._array(self.path, s, k, t) for k, t in types.items()}
            if len(held["ids"]) != self.sizes[s] or len(held["near_at"]) != self.sizes[s] + 1 or len(held["near"]) != held["near_at"][-1]:
                raise OSError(f"shard {s} of {self.path} isn't whole")
            held["vectors"] = held["vectors"].reshape(-1, self.dims)
            self.open[s] = held
        return self.open[s]

    def each(self, keys: np.ndarray):
        """Of keys in order: positions, the shard's arrays and places, shard by shard."""
        shards = keys >> PLACE
        cuts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]]) if len(keys) else []
        for begin, end in zip(cuts, [*cuts[1:], len(keys)]):
            yield slice(begin, end), self.shard(int(shards[begin])), keys[begin:end] & ((1 << PLACE) - 1)

    def get(self, keys: np.ndarray, name: str) -> np.ndarray:
        out = np.zeros((len(keys), self.dims) if name == "vectors" else len(keys), self.kind if name == "vectors" else "i8")
        for at, held, places in self.each(keys):
            out[at] = held[name][places]
        return out

    def near(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys linked to each of ``keys``, one after the other, and their numbers."""
        found, sizes = [], np.zeros(len(keys), np.int64)
        for at, held, places in self.each(keys):
            begin, n = held["near_at"][places], held["near_at"][places + 1] - held["near_at"][places]
            sizes[at] = n
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append(held["near"][np.repeat(begin, n) + inside])
        return np.concatenate(found) if found else np.zeros(0, np.int64), sizes

    def greedy(self, keys: np.ndarray, q: np.ndarray, beam: int) -> np.ndarray:
        """The keys that a search from the medoids of each query's shards ends with: (query, beam), -1 where fewer."""
        homes = np.concatenate([held["homes"].reshape(-1, OVERLAP)[p] for _, held, p in self.each(keys)])
        entries = np.array([[self.medoids.get(int(s), -1) for s in h] for h in homes])
        entries = np.concatenate([entries, keys[:, None]], 1)
        have, score, done = (np.full((len(keys), beam), v) for v in (-1, np.float32(-3), True))
        for k in range(entries.shape[1]):
            fresh = (entries[:, k] >= 0) & ~(have == entries[:, [k]]).any(1)
            self._kept(have, score, done, q, np.flatnonzero(fresh), entries[fresh, k])
        while len(active := np.flatnonzero(~done.all(1))):
            best = np.where(done[active], -4, score[active]).argmax(1)
            done[active, best] = True
            at, back = np.unique(have[active, best], return_inverse=True)
            found, sizes = self.near(at)
            begin = np.cumsum(sizes) - sizes
            n = sizes[back]
            owner = np.repeat(active, n)
            to = found[np.repeat(begin[back], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            fresh = ~(have[owner] == to[:, None]).any(1)
            self._kept(have, score, done, q, owner[fresh], to[fresh])
        return have

    def _kept(self, have, score, done, q, owner, to) -> None:
        """Put candidates (owner, key) into the beams, where they are better than what is there."""
        if not len(to):
            return
        distinct, back = np.unique(to, return_inverse=True)
        x = _unit(self.get(distinct, "vectors"))
        s = np.einsum("ed,ed->e", q[owner], x[back])
        good = s > score[owner].min(1)
        owner, to, s = owner[good], to[good], s[good]
        order = np.lexsort((to, -s, owner))
        owner, to, s = owner[order], to[order], s[order]
        turn = np.arange(len(owner)) - np.searchsorted(owner, owner)
        beam = have.shape[1]
        few = turn < beam
        more, rows = np.full((len(q), beam), -1), np.full((len(q), beam), np.float32(-3))
        more[owner[few], turn[few]], rows[owner[few], turn[few]] = to[few], s[few]
        all_keys, all_scores, all_done = (np.concatenate(p, 1) for p in ((have, more), (score, rows), (done, more < 0)))
        order = np.argsort(-all_scores, 1, kind="stable")[:, :beam]
        have[:], score[:], done[:] = (np.take_along_axis(a, order, 1) for a in (all_keys, all_scores, all_done))

    def within(self, keys: np.ndarray, least: float, beam: int):
        """Verified links (query number, key) of queries in one shard, in slices."""
        q = _unit(self.get(keys, "vectors"))
        whole = _scaled(self.get(keys, "vectors"))
        norms = np.linalg.norm(whole, axis=1)
        start = self.greedy(keys, q, beam)
        fresh = known = np.unique(np.r_[start[start >= 0], keys])
        while len(fresh):
            grown = []
            for k in range(0, len(fresh), 1 << 14):
                part = fresh[k : k + (1 << 14)]
                vectors = self.get(part, "vectors")
                likeness = q @ _unit(vectors).T
                grown.append(part[(likeness >= least - SLACK).any(0)])
                a, b = np.nonzero(likeness >= least - 1e-3)
                for j in range(0, len(a), 1 << 15):
                    i, t = a[j : j + (1 << 15)], b[j : j + (1 << 15)]
                    to = _scaled(vectors[t])
                    cos = np.einsum("ed,ed->e", whole[i], to) / (norms[i] * np.linalg.norm(to, axis=1))
                    sure = (cos >= least) & (keys[i] != part[t])
                    yield i[sure], part[t[sure]]
            near = np.unique(self.near(np.concatenate(grown))[0])
            fresh = near[~np.isin(near, known, assume_unique=True)]
            known = np.union1d(known, fresh)


def _least(n: int, a: np.ndarray, b: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The least value in each component of n things under the links (a, b)."""
    value = value.copy()
    while True:
        before = value.copy()
        np.minimum.at(value, a, value[b])
        np.minimum.at(value, b, value[a])
        if (value == before).all():
            return value


def graph(nodes: DataFrame, dims: int, total: int) -> tuple[Graph, DataFrame]:
    """The graph of ``nodes`` (``node``, ``times``, ``vector`` of ``dims`` numbers), and the table of its keys."""
    vector = nodes.schema["vector"].dataType.simpleString()
    kind = "f4" if "float" in vector else "f8"
    n_pivots = min(MOST_PIVOTS, max(1, -(-total // PER_PIVOT)))
    pivots = nodes.select("vector", F.xxhash64("node", F.lit(1)).alias("turn"), "node").orderBy("turn", "node").limit(n_pivots).toArrow()
    pivots = _unit(_rows(pivots.column("vector"), dims))
    k = min(OVERLAP, n_pivots)

    def placed(batches):
        for b in batches:
            for begin in range(0, b.num_rows, 4096):
                part = b.slice(begin, 4096)
                likeness = _unit(_rows(part.column("vector"), dims)) @ pivots.T
                best = np.argpartition(-likeness, k - 1, 1)[:, :k]
                best = np.take_along_axis(best, np.argsort(-np.take_along_axis(likeness, best, 1), 1, kind="stable"), 1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(best) + 1, dtype=np.int32) * k), pa.array(best.ravel().astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "cells"])

    cells = written(nodes.select("node", "times", "vector").mapInArrow(lean(placed), f"node long, times long, vector {vector}, cells array<long>"), "cells")
    # a crowded cell is cut into parts by hash, and each of its vectors goes to two of them; there are no more cells than pivots
    sizes = cells.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    parts = F.broadcast(sizes.filter(F.col("n") > MOST).select("cell", F.ceil(2 * F.col("n") / MOST).alias("parts")))
    keyed, part = cells, lambda c, salt: (c * 4096 + F.coalesce(F.pmod(F.xxhash64("node", F.lit(salt)), F.col("parts")), F.lit(0))).cast("long")
    for j in range(k):
        cell = F.col("cells")[j]
        keyed = keyed.withColumn("cell", cell).join(parts, "cell", "left").withColumn(f"in{j}", F.array_distinct(F.array(part(F.col("cell"), 2), part(F.col("cell"), 3)))).drop("cell", "parts")
    homes = F.array(*(F.col(f"in{min(j, k - 1)}")[0] for j in range(OVERLAP)))
    keyed = keyed.withColumns({"homes": homes, "shards": F.array_distinct(F.concat(*(f"in{j}" for j in range(k))))})
    place = F.row_number().over(Window.partitionBy(F.col("homes")[0]).orderBy("node")) - 1
    keyed = keyed.withColumn("key", F.shiftleft(F.col("homes")[0], PLACE) + place)
    keyed = written(keyed.select("key", "node", "times", "vector", "homes", "shards"), "keyed")

    def built(t: pa.Table) -> pa.Table:
        t = t.sort_by("key")
        x, keys, shard = _unit(_rows(t.column("vector"), dims)), t.column("key").to_numpy(), t.column("shard")[0].as_py()
        a, b = linked(x, shard)
        order = np.lexsort((b, a))
        at = np.searchsorted(a[order], np.arange(len(keys) + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(at), pa.array(keys[b[order]]))
        middle = int((x @ x.mean(0)).argmax())
        rows = pa.table({"shard": pa.array(np.full(len(keys), shard)), "key": pa.array(keys), "near": lists})
        medoid = pa.table({"shard": pa.array([shard], pa.int64()), "key": pa.array([keys[middle]], pa.int64()), "near": pa.array([None], lists.type)})
        give_back()
        return pa.concat_tables([rows, medoid])

    links = keyed.select("key", "vector", F.explode("shards").alias("shard")).groupBy("shard").applyInArrow(built, "shard long, key long, near array<long>")
    links = written(links, "links")
    medoids = {r.shard: r.key for r in links.filter("near is null").collect()}
    united = links.filter("near is not null").groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    path = shared_path(nodes.sparkSession, "graph")

    def saved(t: pa.Table) -> pa.Table:
        t = t.sort_by("key")
        near, homes = t.column("near").combine_chunks(), t.column("homes").combine_chunks()
        s = t.column("key")[0].as_py() >> PLACE
        flat = {"ids": t.column("node").to_numpy(), "times": t.column("times").to_numpy(), "vectors": _rows(t.column("vector"), dims).astype(kind), "homes": homes.flatten().to_numpy()}
        mapped.save(path, s, **flat, near=near.flatten().to_numpy(), near_at=np.r_[0, np.cumsum(pc.list_value_length(near).to_numpy())].astype(np.int64))
        return pa.table({"shard": pa.array([s], pa.int64()), "n": pa.array([t.num_rows], pa.int64())})

    whole = keyed.drop("shards").join(united, "key").withColumn("home", F.shiftright("key", PLACE))
    sizes = {r.shard: r.n for r in whole.groupBy("home").applyInArrow(lambda t: saved(t), "shard long, n long").collect()}
    return Graph(path, dims, kind, sizes, medoids), keyed


def links(spark: SparkSession, found: Graph, least: float, beam: int) -> DataFrame:
    """``node`` and ``root`` (a lesser node of its component, or itself), and for queries ``links``, the number of vectors they link with."""
    if not found.sizes:
        return spark.createDataFrame([], "node long, root long, links long")
    units = spark.createDataFrame([(s, n) for s, n in sorted(found.sizes.items())], "shard long, n long")
    units = units.select("shard", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(BATCH).cast("long"))).alias("begin"))
    count = sum(-(-n // BATCH) for n in found.sizes.values())

    def work(batches):
        for b in batches:
            for shard, n, begin in zip(*(b.column(c).to_pylist() for c in ("shard", "n", "begin"))):
                keys = (shard << PLACE) + np.arange(begin, min(begin + BATCH, n))
                own, number = found.get(keys, "ids"), np.zeros(len(keys), np.int64)
                joined: list[tuple[np.ndarray, np.ndarray]] = []
                for at, to in found.within(keys, least, beam):
                    order = np.argsort(to, kind="stable")
                    at, to = at[order], to[order]
                    np.add.at(number, at, found.get(to, "times"))
                    joined.append((at, found.get(to, "ids")))
                at, to = (np.concatenate([j[k] for j in joined]) if joined else np.zeros(0, np.int64) for k in range(2))
                things, place = np.unique(np.r_[own, to], return_inverse=True)
                roots = _least(len(things), place[at], place[len(own) :], things)
                others = np.setdiff1d(np.arange(len(things)), place[: len(own)])
                node = np.r_[own, things[others]]
                said = pa.array(np.r_[number, np.zeros(len(others), np.int64)], mask=np.arange(len(node)) >= len(own))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.r_[roots[place[: len(own)]], roots[others]]), said], ["node", "root", "links"])

    return units.repartition(min(count, 4096)).mapInArrow(lean(work), "node long, root long, links long")


def recall(keyed: DataFrame, said: DataFrame, dims: int, least: float) -> float:
    """The share of links that were found, of ``AUDITED`` vectors chosen by hash, against a comparison with all."""
    own = keyed.withColumn("turn", F.xxhash64("node", F.lit(5))).orderBy("turn", "node").limit(AUDITED).select("node", "vector").toArrow()
    q, ids = _scaled(_rows(own.column("vector"), dims)), own.column("node").to_numpy()
    norms = np.linalg.norm(q, axis=1)

    def compared(batches):
        for b in batches:
            for begin in range(0, b.num_rows, 4096):
                part = b.slice(begin, 4096)
                x, node = _scaled(_rows(part.column("vector"), dims)), part.column("node").to_numpy()
                cos = q @ x.T / np.maximum(norms[:, None] * np.linalg.norm(x, axis=1), 1e-300)
                hit = (cos >= least) & (ids[:, None] != node)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(hit @ part.column("times").to_numpy())], ["node", "all"])

    true = keyed.select("node", "times", "vector").mapInArrow(compared, "node long, all long").groupBy("node").agg(F.sum("all").alias("all"))
    row = true.join(said.filter("links is not null"), "node").agg(F.sum("all").alias("all"), F.sum(F.least("all", "links")).alias("found")).first()
    return row["found"] / row["all"] if row["all"] else 1.0


def near_duplicates(rows: DataFrame, vector: str = "embedding", least: float = 0.9) -> tuple[DataFrame, float]:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for each ``vec_id``, and the audited recall."""
    spark, v = rows.sparkSession, F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    ids = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(finite, v).alias("vector")).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    ids = written(ids.withColumns({"a": F.xxhash64("vector"), "b": F.xxhash64(F.lit(7), "vector")}), "vectors")
    whole = ids.filter("vector is not null and vec_id is not null")
    copies = written(whole.groupBy("a", "b").agg(F.min("vec_id").alias("node"), F.count("*").alias("times")), "copies")
    size = whole.agg(F.max(F.size("vector")).alias("dims")).first().dims or 1
    total = copies.count()
    zero = F.lit(0).cast(ids.schema["vector"].dataType.elementType)
    nodes = whole.join(copies.select("node", "times"), F.col("vec_id") == F.col("node")).select("node", "times", F.concat("vector", F.array_repeat(zero, F.lit(size) - F.size("vector"))).alias("vector"))
    found, keyed = graph(nodes, size, total)
    for beam in BEAMS:
        said = written(links(spark, found, least, beam), "found")
        share = recall(keyed, said, size, least)
        if share >= RECALL:
            break
    roots = components(said.filter("node <> root"), "node", "root")
    counts = said.filter("links is not null").select("node", "links").join(roots, "node", "left")
    member = whole.select("vec_id", "a", "b").join(copies, ["a", "b"]).join(counts, "node")
    member = member.select(F.col("vec_id").alias("id"), (F.col("links") + F.col("times") - 1).alias("n"), F.coalesce("root", "node").alias("root"))
    out = ids.select("vec_id").join(member, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("root", "vec_id")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
    return out, share


def op13_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings``, linked where their cosine is 0.9 or more."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))[0]
