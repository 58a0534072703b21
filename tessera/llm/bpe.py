"""Byte-level BPE encoding and decoding.

Texts are split by the tokenizer's pattern in Spark. Every distinct piece of the corpus
is encoded once, by Spark's higher-order functions: a fold over the piece's bytes that
joins the pair of lowest rank again and again, with a literal rank map. The map is kept
as two literal arrays over pairs of ids, since looking up a key of a Spark map reads
through all of it. The encoded pieces (they grow with the vocabulary, not with the
text) are a sorted hash array that workers map, where each text's pieces are looked up;
texts are never shuffled, nor joined to their pieces by a shuffle. Pieces longer than
``LONG`` bytes are joined by a heap in Python, since a fold copies its state at each step.

Decoding concatenates the binary pieces of the ids.

Defined cases: a null text is an empty one, with no ids. Characters are never dropped:
what isn't in the vocabulary is encoded byte by byte. Other columns pass through.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mapped, words
from .shared import lean, planned_once, table, written

LONG, NEVER = 2_048, 1 << 17
#: Distinct pieces that a task encodes.
FOLD = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks from a file of base 64 strings and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The rank map over pairs of ids, as two arrays.

    The pair (a, b) has the entry ``held[base[a] + b]``, which is ``a << 17 | rank`` if the
    two join to a ranked string; any other entry has another number above its 17 bits, or is negative.
    Rows are laid over each other where none of their entries meet. One id more than
    there are stands for the ends of a piece.
    """
    rows: dict[int, list[tuple[int, int]]] = {}
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            if (a := ranks.get(piece[:cut])) is not None and (b := ranks.get(piece[cut:])) is not None:
                rows.setdefault(a, []).append((b, rank))
    n = max(ranks.values(), default=0) + 2
    base, held, high = np.zeros(n, np.int64), np.full(4 * n, -1, np.int64), 0
    free = held < 0
    for a, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        columns = np.array([b for b, _ in row])
        columns, row_ranks = columns[order := np.argsort(columns)], np.array([r for _, r in row])[order]
        start = 0
        while True:
            tries = np.flatnonzero(free[start : start + 4096]) + start - columns[0]
            tries = tries[tries >= 0]
            if len(free) < start + 4096 + 2 * n:
                held = np.append(held, np.full(4 * n, -1, np.int64))
                free = held < 0
            good = tries
            for c in columns:
                good = good[free[good + c]]
            if len(good):
                break
            start += 4096
        base[a] = good[0]
        held[good[0] + columns] = a << 17 | row_ranks
        free[good[0] + columns] = False
        high = max(high, int(good[0]))
    return base, held[: high + n]


def encode_pieces(pieces: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``pieces`` (column ``piece``) with ``ids``, null for those longer than ``LONG`` bytes.

    The fold's state is an array with a number for each part: the rank of the pair that it
    makes with the next part (17 bits, ``NEVER`` if none), the offset of its first byte
    (26 bits) and its id (17 bits). The least number is thus the leftmost pair of lowest
    rank. A part for the end stands at either side.
    """
    base, held = pair_table(ranks)
    ends, low, place = len(base) - 1, (1 << 17) - 1, ((1 << 26) - 1) << 17
    # free entries are null, which keeps the plan short
    literal = lambda x, kind: F.from_json(F.lit("[" + ",".join("null" if k < 0 else str(k) for k in x.tolist()) + "]"), f"array<{kind}>")
    bases, entries = literal(base, "int"), literal(held, "bigint")
    bytes_ids = literal(np.array([ranks.get(bytes([k]), ends) for k in range(256)]), "bigint")
    id_of = lambda part: part.bitwiseAND(low)

    # the literals stand once in the expression, however often they are looked up
    tables = F.struct(bases.alias("bases"), entries.alias("entries"), bytes_ids.alias("bytes"))

    def pair(t: Column, left: Column, right: Column) -> Column:
        """The rank of two ids, in the upper bits."""
        entry = F.get(t["entries"], F.get(t["bases"], left.cast("int")) + right)
        return F.shiftleft(F.least(entry.bitwiseXOR(F.shiftleft(left, 17)), F.lit(NEVER)), 43)

    def joined(t: Column, s: Column, least: Column, at: Column) -> Column:
        """The state after joining the parts at ``at`` and ``at`` + 1 (counted from 1)."""
        new = F.shiftright(least, 43)
        before = F.get(s, at - 2)
        return F.concat(
            F.slice(s, 1, at - 2),
            F.array(
                pair(t, id_of(before), new).bitwiseOR(before.bitwiseAND((1 << 43) - 1)),
                pair(t, new, id_of(F.get(s, at + 1))).bitwiseOR(least.bitwiseAND(place)).bitwiseOR(new),
            ),
            F.slice(s, at + 2, F.size(s)),
        )

    def step(t: Column, s: Column) -> Column:
        none = F.lit(NEVER << 43)
        return _let(F.array_min(s), lambda least: F.when(least < none, _let(F.array_position(s, least).cast("int"), lambda at: joined(t, s, least, at))).otherwise(s))

    def fold(t: Column, parts: Column) -> Column:
        last = F.size(parts) - 1
        start = F.transform(parts, lambda x, i: F.when((i == 0) | (i == last), F.lit(NEVER << 43).bitwiseOR(x)).otherwise(pair(t, x, F.get(parts, i + 1)).bitwiseOR(F.shiftleft(i.cast("long"), 17)).bitwiseOR(x)))
        return F.aggregate(F.slice(parts, 4, F.size(parts)), start, lambda s, _: step(t, s), lambda s: F.transform(F.slice(s, 2, F.size(s) - 2), lambda x: id_of(x).cast("int")))

    characters = F.split(F.decode(F.encode("piece", "UTF-8"), "ISO-8859-1"), "")
    end = F.array(F.lit(ends).cast("long"))
    parts = lambda t: F.concat(end, F.transform(characters, lambda c: F.get(t["bytes"], F.ascii(c))), end)
    return pieces.withColumn("ids", F.when(F.octet_length("piece") <= LONG, _let(tables, lambda t: _let(parts(t), lambda x: fold(t, x)))))


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: pairs of lowest rank first, leftmost first, by a heap."""
    end, after, before = len(piece), list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))
    stop = list(range(1, end + 1))
    alive = [True] * end
    heap = [(r, i, i + 2) for i in range(end - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, to = heapq.heappop(heap)
        if not alive[i] or after[i] >= end or stop[after[i]] != to:
            continue
        j = after[i]
        alive[j], stop[i], after[i] = False, to, after[j]
        if after[i] < end:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < end and (r := ranks.get(piece[a : stop[after[a]]])) is not None:
                heapq.heappush(heap, (r, a, stop[after[a]]))
    return [ranks[piece[i : stop[i]]] for i in range(end) if alive[i]]


def split_pieces(text: Column, pattern: str) -> Column:
    """All matches of the tokenizer's pattern, with its classes as in Unicode."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + pattern), F.lit(0))


def _hashes(pieces: pa.Array) -> np.ndarray:
    data, bounds = words.raw_bytes(pieces.cast(pa.large_string()))
    return words.span_hashes(data, bounds[:-1], bounds[1:], lower=False)


def dictionary(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> mapped.Mapped:
    """The ids of every distinct piece of the texts, by the piece's hash."""
    pieces = written(docs.select(F.explode(split_pieces(F.col("text"), pattern)).alias("piece")).distinct(), "pieces")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def keyed(batches):
        for batch in batches:
            ids = batch.column("ids")
            if ids.null_count:
                ids = pa.array([merge_long(p.as_py().encode(), shared.value) if x is None else x for p, x in zip(batch.column("piece"), ids.to_pylist())], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(batch.column("piece")).view(np.int64)), ids], ["key", "ids"])

    # the fold is the dearest step: its tasks hold so many pieces each, however small their files are
    n = pieces.count()
    rows = encode_pieces(pieces.repartition(1 + n // FOLD), ranks).mapInArrow(lean(keyed), "key long, ids array<int>")
    with planned_once(docs.sparkSession):
        return mapped.build(rows, n, "pieces", {"ids": "u4"})


class Vocabulary:
    """The bytes of all ids, one after the other, to decode many ids at once."""

    def __init__(self, ranks: dict[bytes, int]):
        held = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            held[rank] = piece
        self.bounds = np.cumsum([0, *map(len, held)])
        self.bytes = np.frombuffer(b"".join(held), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids, and how many each gave."""
        ids = ids.astype(np.int64)
        sizes = self.bounds[ids + 1] - self.bounds[ids]
        begin = np.cumsum(sizes) - sizes
        return self.bytes[np.arange(int(sizes.sum())) + np.repeat(self.bounds[ids] - begin, sizes)], sizes


def look_up(batch: pa.RecordBatch, found: mapped.Mapped, limit: int = 200_000) -> Iterator:
    """Runs of rows (first, end) of a batch with a column ``pieces``: their ids, and the bounds of each row's."""
    lists = batch.column("pieces")
    bounds, at = lists.offsets.to_numpy().astype(np.int64), 0
    while at < len(lists):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        ids, sizes = found.lists(_hashes(lists.values.slice(bounds[at], bounds[end] - bounds[at])), "ids")
        yield at, end, ids, np.concatenate([[0], np.cumsum(sizes)])[bounds[at : end + 1] - bounds[at]]
        at = end


def op9_bpe(spark: SparkSession, sf_dir: str, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Lengths and digests of every document's ids and of the bytes that they decode to."""
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with the ids of ``text`` in ``ids`` and the bytes they decode to in ``decoded``."""
    return _encoded(docs, docs.columns, path, pattern, whole=True)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens`` and the SHA-256 of the ids (as unsigned 32-bit) and of the decoded bytes."""
    return _encoded(docs, [c for c in docs.columns if c != "text"], path, pattern, whole=False)


def _encoded(docs: DataFrame, kept: list[str], path: str, pattern: str, whole: bool) -> DataFrame:
    ranks = read_ranks(path)
    found = dictionary(docs, ranks, pattern)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(ranks))
    added = {"ids": "array<int>", "decoded": "binary"} if whole else {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    kept = [c for c in kept if c not in added and c != "pieces"]

    def digest(parts) -> pa.Array:
        return pa.array([hashlib.sha256(x).hexdigest() for x in parts], pa.string())

    def work(batches):
        for batch in batches:
            for at, end, ids, cut in look_up(batch, found):
                raw, sizes = vocabulary.value.decode(ids)
                ends = np.concatenate([[0], np.cumsum(sizes)])[cut]
                texts = [raw[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                ids = ids.astype("<u4")
                if whole:
                    new = [pa.ListArray.from_arrays(cut.astype(np.int32), pa.array(ids.view(np.int32))), pa.array(texts, pa.binary())]
                else:
                    new = [pa.array(np.diff(cut)), digest(ids[a:b].tobytes() for a, b in zip(cut, cut[1:])), digest(texts)]
                yield pa.RecordBatch.from_arrays([*(batch.column(n).slice(at, end - at) for n in kept), *new], [*kept, *added])

    fields = {**dict(docs.select(*kept).dtypes), **added}
    pieces = docs.select(*kept, split_pieces(F.col("text"), pattern).alias("pieces"))
    return pieces.mapInArrow(lean(work), ", ".join(f"`{n}` {t}" for n, t in fields.items()))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ``doc_id``, ``lang`` and ``source`` with its token count and digests."""
    import public_tokenizers

    return digests(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
