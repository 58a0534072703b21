"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only.

A seed is a mask over a window of tokens: tokens at its 1s are hashed, those at its 0s
are ignored, so a window still hits if tokens there were replaced. Each window of each
document is hashed under every mask; a fixed bitmap (built from the benchmark's hashes,
held in the plan as a literal) drops nearly all windows before the join with the
benchmark's hashes. At a hit, document and item are laid over each other and
compared token by token over every run of ``OVERLAP`` tokens of the item (all of a shorter
one) that holds the hit: in one of them at least ``LEAST`` must be equal for it to count.

With each hash goes the part of the item that such runs can cover, and with each window the
part of the document: both are a few dozen tokens, however long item and document are.

Everything up to the verified hits is one stage without a shuffle when the benchmark's
hash table is small enough to be broadcast, which is decided by its bytes; above that
the surviving windows (not the documents) are shuffled to it.

Tokens are the letter and digit runs of the lower-cased text. Shorter items have seeds of
their own, by how many tokens ``LEAST`` lets differ; under every pattern of so many
replaced tokens some window still hits (the tests try all of them). Items of fewer than
five tokens must occur as they are.

Defined cases: null and empty texts and items have no tokens and never match. Repeated
rows give one result row for each (doc_id, item_id). A null doc_id is kept as such. Other
columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import free_names, table, written

#: Seeds of equal span by the fewest tokens of the items that they serve.
SEEDS = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("1111",),
    5: ("1101", "1011"),  # one of 5 replaced
    6: ("11101", "10111"),
    8: ("111011", "110111"),
    10: ("11011001", "10001111", "10110101"),  # two of 10
    15: ("110100011", "111001001"),  # three of 15
    20: ("111010000111", "101110100011", "100001101111", "111010010001", "111000001101"),  # four of 20
}
OVERLAP, LEAST = 20, 0.8
#: Above so many bytes the benchmark's hashes aren't broadcast; the bitmap has at most so many bits.
MOST_BROADCAST, MOST_BITS = 64 << 20, 1 << 24


def tokens(text: Column) -> Column:
    """64-bit hashes of the text's tokens."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(found, lambda x: F.xxhash64(x))


def _hash(mask: str) -> Column:
    """The hash of the tokens from ``at`` on under the mask's 1s; the mask is part of it."""
    return F.xxhash64(F.lit(mask), *(F.get("tokens", F.col("at") + i) for i, bit in enumerate(mask) if bit == "1"))


def _windows(rows: DataFrame, span: int) -> DataFrame:
    """Each row once for every window of ``span`` tokens, from ``at`` on."""
    last = F.size("tokens") - span
    return rows.withColumn("at", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))))


def _hashed(rows: DataFrame, masks: tuple[str, ...], keep=None) -> DataFrame:
    """``rows`` with ``at`` and ``h`` for each window under each of the masks, which are equally long.

    ``keep`` says of a hash whether it is wanted; windows without such a hash go first.
    """
    hashes = [_hash(m) for m in masks]
    found = _windows(rows, len(masks[0]))
    if keep is not None:
        wanted = keep(hashes[0])
        for h in hashes[1:]:
            wanted = wanted | keep(h)
        found = found.filter(wanted)
    found = found.withColumn("h", F.explode(F.array(*hashes)))
    return found if keep is None else found.filter(keep(F.col("h")))


def _bitmap(hashes: DataFrame, bits: int):
    """A test of whether a hash may be among ``hashes``: its bit in a literal bitmap of ``bits`` bits."""
    place = F.col("h").bitwiseAND(bits - 1)
    rows = hashes.groupBy(F.shiftright(place, 6).cast("int").alias("k")).agg(F.bit_or(F.expr("shiftleft(1L, int(h & 63))")).alias("m")).collect()
    held = [0] * (bits // 64)
    for r in rows:
        held[r.k] = r.m
    literal = F.from_json(F.lit(json.dumps(held, separators=(",", ":"))), "array<bigint>")
    return lambda h: F.getbit(F.get(literal, F.shiftright(h.bitwiseAND(bits - 1), 6).cast("int")), h.bitwiseAND(63)) == 1


def contaminated(docs: DataFrame, benchmark: DataFrame, overlap: int = OVERLAP, least: float = LEAST) -> DataFrame:
    """``doc_id``, ``item_id``, ``overlap`` (tokens equal around the best hit) and ``share`` of every contamination."""
    items = written(benchmark.select("item_id", tokens(F.col("text")).alias("tokens")).distinct(), "items")
    texts = docs.select("doc_id", tokens(F.col("text")).alias("tokens"))
    size = F.size("tokens")
    least_of = sorted(SEEDS)
    of = lambda low, above: size >= low if above is None else size.between(low, above - 1)
    ranges = list(zip(least_of, [*least_of[1:], None]))
    there = items.agg(*(F.coalesce(F.bool_or(of(*r)), F.lit(False)) for r in ranges)).first()
    sets = [(SEEDS[r[0]], items.filter(of(*r))) for r, some in zip(ranges, there) if some or r is ranges[-1]]
    found = [_hits(texts, part, masks, overlap, least) for masks, part in sets]
    hits = found[0]
    for more in found[1:]:
        hits = hits.union(more)
    return hits.groupBy("doc_id", "item_id").agg(F.max("overlap").alias("overlap"), F.max("share").alias("share"))


def _hits(texts: DataFrame, items: DataFrame, masks: tuple[str, ...], overlap: int, least: float) -> DataFrame:
    """Verified hits of the items in the texts under masks of one length."""
    span = len(masks[0])
    most = max(overlap, span)
    width, size = F.least(F.size("tokens"), F.lit(most)), F.size("tokens")
    first, last = F.greatest(F.lit(0), F.col("at") + span - F.col("width")), F.least(F.col("at"), size - F.col("width"))
    held = _hashed(items, masks).withColumn("width", width).withColumns({"first": first, "last": last})
    part = F.slice("tokens", F.col("first") + 1, F.col("last") - F.col("first") + F.col("width"))
    table_ = written(held.select("h", "item_id", "width", (F.col("at") - F.col("first")).alias("back"), part.alias("item")), "item-hashes")
    n = table_.count()
    bits = min(MOST_BITS, max(1 << 15, 1 << (64 * max(1, n) - 1).bit_length()))
    # cut out where windows are made: rows with the whole document would pile up in a task
    lead = F.least(F.col("at"), F.lit(most))
    around = F.slice("tokens", F.col("at") - lead + 1, F.lit(2 * most + span))
    windows = _hashed(texts, masks, _bitmap(table_.select("h"), bits)).select("doc_id", "h", lead.alias("lead"), around.alias("around"))
    met = windows.join(F.broadcast(table_) if n * 8 * (2 * most + 4) <= MOST_BROADCAST else table_, "h")
    met = met.withColumn("same", F.expr("transform(item, (x, i) -> if(x <=> get(around, lead - back + i), 1, 0))"))
    equal = F.expr("array_max(transform(sequence(0, size(item) - width), s -> aggregate(slice(same, s + 1, width), 0, (n, x) -> n + x)))")
    return met.select("doc_id", "item_id", equal.alias("overlap"), (equal / F.col("width")).alias("share")).filter(F.col("share") >= least)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    (id_,) = free_names(docs, "leaked_id")
    found = written(contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(id_)).distinct(), "contaminated")
    return docs.join(found, docs["doc_id"].eqNullSafe(found[id_]), "left_anti")
