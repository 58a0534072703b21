"""Hard negatives from exact scores, found through a vector-approximation file.

Vectors of integers are dealt to blocks. In each block every dimension is cut into
``CELLS`` cells with as many rows each, and a cell is known by the least and greatest value
in it. For an anchor, a table with the least and greatest product of each cell (two
dimensions to an entry) gives bounds of each row's score by lookup alone. Only rows whose
bounds leave it open whether they belong to the answer are scored exactly: for the k first
rows those whose upper bound reaches the k-th lower bound, and in a window those that may
lie in it, and may be above the k-th of the rows that lie in it for sure. So the answers
are those of an exhaustive search.

All anchors meet all blocks: every group of anchors is sent to every block, and only a
block's k first rows for an anchor leave a task.

Defined cases: rows with a null id, label or vector, or with a component that is null or
not finite, take no part; of rows with one id, the one with the least label and vector does.
Vectors of other lengths count as filled up with zeros. Scores beyond 2^53 are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import lean, table, written

#: Rows of a block and anchors of a group, about; cells of a dimension.
BLOCK, GROUP, CELLS = 4096, 512, 32


def whole_vectors(rows: DataFrame, vector: Column, scale: int) -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` (floor of ``scale`` times each component) of the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull() & finite)
    numbers = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    one = kept.groupBy("vec_id").agg(F.min(F.struct(F.col("label").cast("long").alias("label"), numbers.alias("vector"))).alias("one"))
    return one.select(F.col("vec_id").cast("long").alias("vec_id"), "one.label", "one.vector")


def _matrix(column: pa.Array, dims: int = 0) -> np.ndarray:
    """Rows of numbers, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), max(dims, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _packed(t: pa.Table) -> pa.Table:
    """A block as one row: ids and labels (in the order of labels), values, cells and their bounds."""
    ids, labels, values = t.column("vec_id").to_numpy(), t.column("label").to_numpy(), _matrix(t.column("vector").combine_chunks())
    order = np.lexsort((ids, labels))
    values = np.pad(values[order], ((0, 0), (0, values.shape[1] % 2)))
    edges = np.quantile(values, np.arange(1, CELLS) / CELLS, axis=0, method="lower") if values.size else np.zeros((CELLS - 1, values.shape[1]))
    cells = (values[None] > edges[:, None]).sum(0).astype(np.uint8) if values.size else np.zeros(values.shape, np.uint8)
    big = np.iinfo(np.int64).max
    low = np.stack([np.where(cells == c, values, big).min(0, initial=big) for c in range(CELLS)], 1)
    high = np.stack([np.where(cells == c, values, -big).max(0, initial=-big) for c in range(CELLS)], 1)
    pairs = cells[:, 0::2].astype(np.uint16) * CELLS + cells[:, 1::2]
    # a cell without rows has no bounds; nothing looks it up
    low, high = np.where(low == big, 0, low), np.where(high == -big, 0, high)
    small = next(k for k in ("i2", "i4", "i8") if not values.size or np.abs(values).max() <= np.iinfo(k).max)
    said = {"ids": ids[order], "labels": labels[order], "values": values.astype(small), "cells": np.ascontiguousarray(pairs.T), "low": low, "high": high}
    return pa.table({"block": t.column("block")[:1], "dims": pa.array([values.shape[1]], pa.int32()), "kind": pa.array([small]), **{k: pa.array([v.tobytes()], pa.binary()) for k, v in said.items()}})


class _Block:
    """A block of the file, as read from its row."""

    def __init__(self, row: dict):
        self.dims = row["dims"]
        get = lambda k, t: np.frombuffer(row[k], t)
        self.ids, self.labels = get("ids", "i8"), get("labels", "i8")
        self.values = get("values", row["kind"]).reshape(len(self.ids), self.dims)
        self.cells = get("cells", "u2").reshape(self.dims // 2, len(self.ids)).astype(np.int32) + CELLS**2 * np.arange(self.dims // 2, dtype=np.int32)[:, None]
        self.low, self.high = (get(k, "i8").reshape(self.dims, CELLS) for k in ("low", "high"))

    def bounds(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all rows' scores, looked up."""
        ends = np.stack([anchor[:, None] * self.low, anchor[:, None] * self.high])
        one = (ends.min(0) + 1j * ends.max(0)).reshape(-1, 2, CELLS)
        both = np.take((one[:, 0, :, None] + one[:, 1, None, :]).ravel(), self.cells).sum(0)
        return both.real, both.imag

    def exact(self, anchor: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.values[at].astype(np.int64) @ anchor

    def first(self, at: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Which of the rows come first: higher scores, then lesser ids."""
        return np.lexsort((self.ids[at], -scores))[:k]

    def same(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _positives(block: _Block, anchor: int, label: int, q: np.ndarray, k: int):
    low, high = block.bounds(q)
    begin, end = block.same(label)
    own = np.flatnonzero(block.ids[begin:end] != anchor) + begin
    at = own[high[own] >= _kth(low[own], k)]
    scores = block.exact(q, at)
    best = block.first(at, scores, k)
    return block.ids[at[best]], scores[best]


def _negatives(block: _Block, anchor: int, label: int, q: np.ndarray, positives, window: tuple[int, int], k: int):
    low, high = block.bounds(q)
    begin, end = block.same(label)
    other = np.r_[0:begin, end : len(block.ids)]
    low, high = low[other], high[other]
    for positive, score in positives:
        least, most = window[0] * score, window[1] * score
        possible = (100 * high >= least) & (100 * low <= most)
        sure = (100 * low >= least) & (100 * high <= most)
        at = other[possible & (high >= _kth(low[sure], k))]
        scores = block.exact(q, at)
        inside = (100 * scores >= least) & (100 * scores <= most)
        at, scores = at[inside], scores[inside]
        best = block.first(at, scores, k)
        yield positive, score, block.ids[at[best]], scores[best]


def _met(blocks: DataFrame, anchors: DataFrame, n_blocks: int) -> DataFrame:
    """Every block beside every group of anchors.

    Groups go to the blocks, which are shuffled once. A copy of a group for each block is more
    than its file shows, so that no side may be broadcast by its size.
    """
    groups = anchors.groupBy("group").agg(F.collect_list(F.struct(*(c for c in anchors.columns if c != "group"))).alias("anchors"))
    asked = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    n = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_blocks)
    return asked.repartition(n, "block").hint("merge").join(blocks.repartition(n, "block"), "block")


def mined(vectors: DataFrame, anchor: Column, n_positives: int = 5, k: int = 10, window: tuple[int, int] = (30, 90), rows: int | None = None, asked: int | None = None) -> DataFrame:
    """Of each anchor and positive the first ``k`` rows of another label whose score is within ``window`` percent of the positive's.

    ``vectors`` is ``vec_id``, ``label``, ``vector`` (whole numbers), one row an id; ``rows``
    and ``asked`` say how many there are, and how many anchors, at most.
    """
    vectors = vectors.withColumn("anchor", anchor)
    rows, asked = rows or vectors.count(), asked or vectors.filter("anchor").count()
    n_blocks, n_groups = max(1, -(-rows // BLOCK)), max(1, -(-asked // GROUP))
    number = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    binary = ", ".join(f"{c} binary" for c in ("ids", "labels", "values", "cells", "low", "high"))
    packed = vectors.select("vec_id", "label", "vector", number(n_blocks, 1).alias("block")).groupBy("block").applyInArrow(_packed, f"block int, dims int, kind string, {binary}")
    blocks = written(packed, "va-file")
    anchors = written(vectors.filter("anchor").select("vec_id", "label", "vector", number(n_groups, 2).alias("group")), "anchors")

    def work(answer, names):
        def run(batches):
            for b in batches:
                for k in range(b.num_rows):
                    row = b.slice(k, 1)
                    block = _Block({c: row.column(c)[0].as_py() for c in ("dims", "kind", "ids", "labels", "values", "cells", "low", "high")})
                    held = row.column("anchors").flatten()
                    queries = _matrix(held.field("vector"), block.dims)
                    if np.abs(queries).sum(1).max(initial=0) * float(np.abs(block.values).max(initial=0)) >= 2**53:
                        raise ValueError("scores beyond 2^53")
                    out = [[] for _ in names]
                    lists = held.field("positives").to_pylist() if "positives" in [f.name for f in held.type] else [None] * len(held)
                    for i, (one, label, positives) in enumerate(zip(held.field("vec_id").to_pylist(), held.field("label").to_pylist(), lists)):
                        for values in answer(block, one, label, queries[i, : block.dims], positives):
                            for o, v in zip(out, values):
                                o.append(v)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o) if o else [], pa.int64()) for o in out], names)

        return lean(run)

    def first(block, one, label, q, _):
        ids, scores = _positives(block, one, label, q, n_positives)
        yield np.full(len(ids), one), ids, scores

    def second(block, one, label, q, positives):
        for positive, score, ids, scores in _negatives(block, one, label, q, [(p["positive_id"], p["positive_score"]) for p in positives], window, k):
            yield np.full(len(ids), one), np.full(len(ids), positive), np.full(len(ids), score), ids, scores

    names = ["anchor_id", "positive_id", "positive_score"]
    found = _met(blocks, anchors, n_blocks).mapInArrow(work(first, names), ", ".join(f"{n} long" for n in names))
    best = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    positives = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= n_positives)
    lists = positives.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asking = anchors.hint("merge").join(lists, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    names = [*names, "negative_id", "negative_score"]
    found = _met(blocks, asking, n_blocks).mapInArrow(work(second, names), ", ".join(f"{n} long" for n in names))
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each anchor (``vec_id`` divisible by 100) and each of its five positives, ten negatives out of all ``embeddings``."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = whole_vectors(rows.select("vec_id", label.alias("label"), "embedding"), F.col("embedding"), 256)
    chosen = F.col("vec_id") % 100 == 0
    out = mined(vectors, chosen, rows=rows.count(), asked=rows.filter(chosen).count())
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
