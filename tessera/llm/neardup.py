"""Near-duplicate documents: DartMinHash signatures, banded joining, exact verification.

A document is a weighted set: its word shingles (five words by default; letters A-Z
lower-cased; fewer words than that make one shingle) weighted by how often they occur.
Darts are thrown at each element by hashing: the ranks of an element's darts on each
unit of its weight are a Poisson process of rate one, drawn with exponential gaps, so
two documents see the same darts where their elements and weights agree. A document
keeps, for each coordinate, its earliest dart; a coordinate is equal in two documents
with a probability equal to their weighted Jaccard similarity. A document throws only
the darts up to a rank that fills all coordinates with good chance, doubled for those
it leaves empty: about k ln k darts, however many elements there are.

Joining: documents with the same elements and weights are one node. Nodes that share a
band are first held against one leader, the one of them whose bands are fullest, with
their exact similarity; components of these links are classes. In a second round, nodes of a band that are still
in different classes are held against each other, so that a link isn't lost because the
leader happened to be a stranger. Bands of more than ``CROWD`` nodes (a passage that
many documents share fills such bands) take another exact way for this: their nodes are
joined on the rarest fifth of their shingles. Nodes of one class are never paired again.

With 26 bands of 5 coordinates a pair at similarity 0.8 meets in no band with a
probability of 3e-5, at 0.85 of 1e-7.

Defined cases: null texts are empty ones; all documents without a word are one class.
Repeated rows are copies like others. A null doc_id counts in its class; the class id is
its least doc_id that isn't null (null if there is none). Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words
from .components import components
from .shared import free_names, lean, table, written

SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 26, 5
#: Nodes of a band from which on they are joined by rare shingles; slots of their counts, in parts; 64-bit words of parities.
CROWD, SLOTS, PARTS, PARITIES = 32, 1 << 22, 64, 8
LAST = 2**63 - 1


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every shingle, in order, and the number of its text."""
    held, owner = words.words_of(texts)
    bounds = words.runs(owner, len(texts))
    counts = np.diff(bounds)
    whole = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
    first = np.repeat(bounds[:-1], whole) + np.arange(int(whole.sum())) - np.repeat(np.cumsum(whole) - whole, whole)
    text = np.repeat(np.arange(len(texts)), whole)
    left = bounds[1:][text] - first
    out = np.zeros(len(first), np.uint64)
    for k in range(size):
        there = left > k
        out[there] = words.mix(out[there] * np.uint64(3) + held[np.minimum(first[there] + k, len(held) - 1)] + np.uint64(k + 1))
    return out, text


def units(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each shingle as a unit of weight: a hash of the shingle and of which occurrence it is."""
    mixed = words.mix(hashes + words.mix(owner.astype(np.uint64)))
    order = np.argsort(mixed)
    ranked = mixed[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.arange(len(ranked))
    turn = at - np.maximum.accumulate(np.where(new, at, 0))
    return words.salted(hashes[order] + turn.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 1), owner[order]


def signatures(keys: np.ndarray, owner: np.ndarray, n: int, k: int) -> np.ndarray:
    """DartMinHash signatures (n x k) of texts given as units of weight; zeros for a text without any."""
    out = np.zeros((n, k), np.uint64)
    weight = np.bincount(owner, minlength=n)
    reach = k * (np.log(k) + 2) / np.maximum(weight, 1)
    open_texts = weight > 0
    while open_texts.any():
        mine = open_texts[owner]
        base, text = keys[mine], owner[mine]
        rank, turn, darts = np.zeros(len(base)), 0, []
        while len(base):
            step = int(np.clip(200_000 // len(base), 1, 256))
            thrown = np.empty((len(base), step), np.uint64)
            for s in range(step):
                thrown[:, s] = words.salted(base, turn + s + 2)
            gaps = -np.log1p(-(thrown >> np.uint64(11)).astype(np.float64) * 2.0**-53)
            ranks = rank[:, None] + np.cumsum(gaps, axis=1)
            hit = ranks <= reach[text][:, None]
            ids, where = thrown[hit], np.broadcast_to(text[:, None], hit.shape)[hit]
            place = ((words.mix(ids) >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
            darts.append((where * k + place, ranks[hit], ids))
            go = hit[:, -1]
            base, text, rank, turn = base[go], text[go], ranks[go, -1], turn + step
        cell, ranks, ids = (np.concatenate(x) for x in zip(*darts))
        order = np.argsort(-ranks)
        flat = out.reshape(-1)
        flat[cell[order]] = ids[order]
        open_texts &= (out == 0).any(axis=1)
        out[open_texts] = 0
        reach = np.where(open_texts, reach * 2, reach)
    return out


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band of each signature."""
    cut = signature.reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), cut.shape[:2]).copy()
    for r in range(rows):
        out = words.mix(out * np.uint64(5) + cut[:, :, r])
    return out


def _nodes(keys: np.ndarray, owner: np.ndarray, n: int) -> list[bytes]:
    """16 bytes that tell a text's weighted set from others."""
    order = np.argsort(owner, kind="stable")
    bounds = words.runs(owner[order], n)
    two = np.stack([words.sums(words.salted(keys[order], s), bounds) for s in (90, 91)], axis=1)
    return [x.tobytes() for x in two]


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """``doc_id``, a hash ``h`` of the text, ``node`` and the ``bands`` of every document; no bands for one without a word."""

    def sign(batches):
        for batch in batches:
            for at, part in words.slices(words.texts_of(batch)):
                keys, owner = units(*shingles(part, size))
                hashes = band_hashes(signatures(keys, owner, len(part), bands * rows), bands, rows).view(np.int64)
                full = np.bincount(owner, minlength=len(part)) > 0
                values = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32), hashes[full].reshape(-1))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), batch.column("h").slice(at, len(part)), pa.array(_nodes(keys, owner, len(part)), pa.binary()), values], ["doc_id", "h", "node", "bands"])

    return docs.select("doc_id", "text", _text_hash().alias("h")).mapInArrow(lean(sign), "doc_id long, h long, node binary, bands array<long>")


def _text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _elements(docs: DataFrame, size: int) -> DataFrame:
    """``node`` and its sorted units of weight, as bytes."""

    def gather(batches):
        for batch in batches:
            for _, part in words.slices(words.texts_of(batch)):
                keys, owner = units(*shingles(part, size))
                order = np.lexsort((keys, owner))
                cut, held = words.runs(owner[order], len(part)), keys[order]
                yield pa.RecordBatch.from_arrays([pa.array(_nodes(keys, owner, len(part)), pa.binary()), pa.array([held[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())], ["node", "units"])

    return docs.select("text").mapInArrow(lean(gather), "node binary, units binary")


def _verified(pairs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) of nodes whose weighted Jaccard similarity is at least ``similarity``."""

    def keep(batches):
        for batch in batches:
            good = []
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) >= similarity * max(len(x), len(y)) else 0
                if both >= similarity * (len(x) + len(y) - both):
                    good.append(k)
            yield batch.select([0, 1]).take(pa.array(good, pa.int64()))

    with_a = pairs.join(held.select(F.col("node").alias("a"), F.col("units").alias("ua")), "a")
    both = with_a.join(held.select(F.col("node").alias("b"), F.col("units").alias("ub")), "b")
    return both.select("a", "b", "ua", "ub").mapInArrow(lean(keep), "a binary, b binary")


def _rare_pairs(crowd: DataFrame, similarity: float) -> DataFrame:
    """Pairs of nodes (``node``, ``root``, ``units``) of different classes that share a rare unit.

    The prefix filter of exact set-similarity joins: two sets at ``similarity`` share one
    of the units that are rarest in each, under any one order of units; here by how often
    they occur in the crowd (counted in a fixed number of slots), then by hash. Units that
    occur in one class only are left out, so that a large class isn't paired with itself,
    and so are units counted once. The parities of how many units fall on each of 512
    bits bound the symmetric difference of two sets from below.
    """

    def slot(units: np.ndarray) -> np.ndarray:
        return (units & np.uint64(SLOTS - 1)).astype(np.int64)

    def count(batches):
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for x in batch.column(0):
                np.add.at(total, slot(np.frombuffer(x.as_buffer(), np.uint64)), 1)
        full = np.flatnonzero(total)
        cut = np.searchsorted(full, np.arange(PARTS + 1) * (SLOTS // PARTS))
        some = np.flatnonzero(np.diff(cut))
        blobs = lambda x: pa.array([x[cut[k] : cut[k + 1]].tobytes() for k in some], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), blobs(full), blobs(total[full])], ["part", "slots", "n"])

    def add(t: pa.Table) -> pa.Table:
        """The counts of a range of slots, up to 2**31 - 1 (only their order matters)."""
        part, total = t.column("part")[0].as_py(), np.zeros(SLOTS // PARTS, np.int64)
        for k, n in zip(t.column("slots"), t.column("n")):
            total[np.frombuffer(k.as_buffer(), np.int64) - part * len(total)] += np.frombuffer(n.as_buffer(), np.int64)
        return pa.table({"part": pa.array([part], pa.int32()), "n": [np.minimum(total, 2**31 - 1).astype(np.int32).tobytes()]})

    counted = crowd.select("units").mapInArrow(lean(count), "part int, slots binary, n binary").groupBy("part").applyInArrow(add, "part int, n binary").toArrow()
    often = np.zeros((PARTS, SLOTS // PARTS), np.int32)
    for part, n in zip(counted.column("part").to_pylist(), counted.column("n").to_pylist()):
        often[part] = np.frombuffer(n, np.int32)
    often = often.reshape(-1)
    shared = crowd.sparkSession.sparkContext.broadcast(often)
    parities = [f"p{k}" for k in range(PARITIES)]

    def prefixes(batches):
        for batch in batches:
            for k, x in enumerate(batch.column("units")):
                units = np.frombuffer(x.as_buffer(), np.uint64)
                n = len(units)
                count = shared.value[slot(units)]
                order = np.lexsort((units, count))[: n - int(np.ceil(similarity * n - 1e-9)) + 1]
                pos = np.flatnonzero(count[order] > 1)
                first = units[order[pos]]
                bits = np.bincount((words.salted(units, 8) >> np.uint64(55)).astype(np.int64), minlength=64 * PARITIES) & 1
                parity = np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)
                same = lambda v, kind: pa.array([v] * len(first), kind)  # noqa: E731, B023
                nodes = [same(batch.column(c)[k].as_py(), pa.binary()) for c in ("node", "root")]
                yield pa.RecordBatch.from_arrays([pa.array(first.view(np.int64)), *nodes, same(n, pa.int32()), pa.array(pos.astype(np.int32)), *(same(int(v), pa.int64()) for v in parity)], ["unit", "node", "root", "n", "pos", *parities])

    rare = crowd.select("node", "root", "units").mapInArrow(lean(prefixes), "unit long, node binary, root binary, n int, pos int, " + ", ".join(f"{p} long" for p in parities))
    rare = _in_two_classes(written(rare, "prefixes"), "unit")
    x, y = rare.alias("x"), rare.alias("y")
    # of the smaller set fewer of the rarest units need be looked at
    inside = lambda z: F.col(f"{z}.pos") <= F.col(f"{z}.n") - F.ceil(F.lit(2 * similarity / (1 + similarity)) * F.col(f"{z}.n") - 1e-9)
    need = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("x.n") + F.col("y.n")) - 1e-9)
    apart = (
        (F.col("x.unit") == F.col("y.unit"))
        & (F.col("x.root") != F.col("y.root"))
        & (F.col("x.node") < F.col("y.node"))
        & F.when(F.col("x.n") <= F.col("y.n"), inside("x")).otherwise(inside("y"))
        & (F.least("x.pos", "y.pos") + F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) >= need)
        & (F.expr(" + ".join(f"bit_count(x.{p} ^ y.{p})" for p in parities)) <= F.col("x.n") + F.col("y.n") - 2 * need)
    )
    return x.join(y, apart).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _in_two_classes(rows: DataFrame, key: str) -> DataFrame:
    """The rows of those keys under which more than one ``root`` occurs."""
    mixed = rows.groupBy(key).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select(key)
    return rows.join(written(mixed, "mixed"), key)


def linked(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members (doc_id, h, node), links between nodes (a, b) and their components (node, root)."""
    members = written(signed(docs, bands, rows, size), "signed")
    lowest = F.coalesce("doc_id", F.lit(-(2**63)))
    reps = written(members.groupBy("node").agg(F.min(lowest).alias("rep"), F.min("bands").alias("bands")).filter("size(bands) > 0"), "nodes")
    places = reps.select("node", F.posexplode("bands")).select(F.xxhash64("pos", "col").alias("bucket"), "node")
    crowds = written(places.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "bands")
    members_of = written(places.join(crowds, "bucket"), "buckets")
    # the original of a family of copies is in the fullest bands: it leads them, so that each copy meets it
    weights = written(members_of.groupBy("node").agg(F.sum("n").alias("w")), "weights")
    weighted = written(members_of.join(weights, "node"), "weighted")
    leaders = written(weighted.groupBy("bucket").agg(F.max(F.struct("w", "node")).alias("t")).select("bucket", F.col("t.node").alias("leader")), "leaders")
    shared = written(weighted.drop("w").join(leaders, "bucket"), "shared")

    wanted = reps.join(shared.select("node").distinct(), "node").select(F.col("rep").alias("__rep"))
    texts = docs.select("doc_id", "text").join(wanted, F.coalesce("doc_id", F.lit(-(2**63))) == F.col("__rep"), "left_semi")
    held = written(_elements(texts, size).dropDuplicates(["node"]), "units")

    first = shared.filter("node <> leader").select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()
    links = written(_verified(first, held, similarity), "links")
    classes = written(components(links, "a", "b"), "classes")

    placed = written(shared.join(classes, "node", "left").select("bucket", "leader", "n", "node", F.coalesce("root", "node").alias("root")), "placed")
    mixed = written(_in_two_classes(placed, "bucket"), "mixed-buckets")
    few = mixed.filter(F.col("n") <= CROWD)
    x, y = few.filter("node <> leader").alias("x"), few.filter("node <> leader").alias("y")
    apart = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.root") != F.col("y.root")) & (F.col("x.node") < F.col("y.node"))
    second = x.join(y, apart).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    crowd = written(held.join(mixed.filter(F.col("n") > CROWD).select("node", "root").distinct(), "node"), "crowd")
    more = written(_verified(second.union(_rare_pairs(crowd, similarity)).distinct(), held, similarity), "links")
    links = links.union(more).distinct()
    return members.select("doc_id", "h", "node"), links, components(links, "a", "b")


def _placed(docs: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    """Every document (doc_id, h) with the ``root`` of its class, and each class's least document and size."""
    members, links, roots = linked(docs, **how)
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    known = written(roots.join(ends, "node"), "roots")
    placed = written(members.join(known, "node", "left").select("doc_id", "h", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "placed")
    head = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("id"), "h")).alias("head")
    return placed, written(placed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), head), "heads")


def classes_of(docs: DataFrame, **how) -> DataFrame:
    """``doc_id``, ``class_id`` (least doc_id of its class), ``class_size`` and ``n_links`` of every document.

    ``n_links`` counts links of the document's text to other texts that were verified.
    """
    placed, heads = _placed(docs, **how)
    return placed.join(heads, "root").select("doc_id", "class_id", "class_size", "n_links")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes_of(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: that with the least doc_id, then text hash; of repeated rows one."""
    id_, h, turn = free_names(docs, "head_id", "head_hash", "head_turn")
    heads = _placed(docs)[1].select(F.col("head.id").alias(id_), F.col("head.h").alias(h))
    keyed = docs.withColumns({id_: F.coalesce("doc_id", F.lit(LAST)), h: _text_hash()})
    first = F.row_number().over(Window.partitionBy(id_, h).orderBy(id_))
    return keyed.join(heads, [id_, h], "left_semi").withColumn(turn, first).filter(F.col(turn) == 1).select(*docs.columns)
