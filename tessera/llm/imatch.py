"""I-Match document fingerprints, with DataFrame functions only.

Terms (runs of letters and digits, lower-cased) are kept if their inverse document
frequency lies in a band: ``LEAST_SHARE`` to ``MOST_SHARE`` of all documents contain
them. A document's kept terms, distinct and sorted, are cut down to several randomised
subsets of the lexicon, and each subset's terms are hashed. How small the subsets are
follows the number of kept terms n: they hold a term with a chance of 1/m, 1/2m and 1/4m,
where m is the power of two not above n (at least 8), so that a term or two of the document are in each
and a hash survives some edits. The fingerprint is the level m and the hashes, four hex
digits each (``....`` for a subset without a term).

The likeness of two fingerprints is the share of equal hashes among those subsets, of
the sizes that both have, in which either has a term; 1 for equal fingerprints.

The lexicon is bounded: as many terms as a document has on average, divided by
``LEAST_SHARE``, can be in the band. It is held as a Bloom filter of a fixed 2**24 bits
in the plan (an array literal), so that documents are never shuffled to look up terms.

The text edited by the following document: documents are dealt by ranges of doc_id (cut
points are percentiles), and an id of many rows by ranges of its texts' hashes, to parts
of about ``PART_BYTES``; within a part the next document is the next row, and the first
row of each part, one per part, serves the last row of the part before.

Defined cases: a null text is an empty one. Texts without a kept term have the
fingerprint ``0`` and are alike only to each other. Documents of equal doc_id follow each
other in the order of their texts' hashes; a null doc_id comes last. Other columns are ignored.
"""

from __future__ import annotations

import collections
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import table, written

LEAST_SHARE, MOST_SHARE, SUBSETS, BITS, PROBES = 1 / 1000, 1 / 10, 24, 1 << 24, 3
#: Bytes of text of a part; more parts than ``MOST_PARTS`` aren't named in the plan (parts grow then, and their sorts spill).
PART_BYTES, MOST_PARTS = 32 << 20, 10_000
#: Where rows without a doc_id are: after all others.
NO_ID = -(2**63)


def terms(text: Column) -> Column:
    """64-bit hashes of the distinct terms of a text."""
    found = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(found, lambda x: x != ""), lambda x: F.xxhash64(x)))


def _probe(h: Column, k: int) -> Column:
    """The k-th bit of a hash in the filter."""
    return F.shiftrightunsigned(h, 20 * k).bitwiseAND(BITS - 1)


def lexicon(texts: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE):
    """A function that keeps of an array of terms those in the band, by document frequencies over all of ``texts``.

    The frequency of a single document is never in the band, so that a term needs two.
    """
    n = texts.count()
    counted = texts.select(F.explode(terms(F.col("text"))).alias("h")).groupBy("h").agg(F.count("*").alias("df"))
    band = counted.filter((F.col("df") >= max(2, least * n)) & (F.col("df") <= max(2, most * n)))
    bits = band.select(F.explode(F.array(*(_probe(F.col("h"), k) for k in range(PROBES)))).alias("b"))
    words = bits.groupBy(F.shiftright("b", 6).cast("int").alias("k")).agg(F.bit_or(F.expr("shiftleft(1L, int(b & 63))")).alias("m"))
    held = [0] * (BITS // 64)
    for r in words.collect():
        held[r.k] = r.m
    literal = F.from_json(F.lit(json.dumps(held, separators=(",", ":"))), "array<bigint>")

    def inside(held: Column, h: Column) -> Column:
        one = lambda k: F.getbit(F.get(held, F.shiftright(_probe(h, k), 6).cast("int")), _probe(h, k).bitwiseAND(63)) == 1
        return one(0) & one(1) & one(2)

    # the literal stands once in the expression, however often it is probed
    return lambda found: F.transform(F.array(literal), lambda held: F.filter(found, lambda h: inside(held, h)))[0]


def kept_terms(text: Column, inside) -> Column:
    """The text's distinct terms in the band, sorted."""
    return F.sort_array(inside(terms(text)))


def fingerprint(kept: Column) -> Column:
    """The fingerprint of an array of kept terms (a column).

    Each of three families deals the lexicon out by ``level`` bits of the terms' hashes;
    the first eight of its 2**level parts are subsets, their halves and quarters by the
    next two bits the smaller ones.
    """
    n = F.size(kept)
    level = F.greatest(F.lit(3), F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1
    digits = lambda s: F.when(F.size(s) == 0, "....").otherwise(F.right(F.hex(F.xxhash64(s)), F.lit(4)))

    def family(j: int) -> Column:
        part = lambda t: F.shiftrightunsigned(t, 21 * j)
        more = lambda t: F.call_function("shiftright", part(t), level)
        few = F.filter(kept, lambda t: part(t).bitwiseAND(mask) < SUBSETS // 3)

        def subset(held: Column, k: Column) -> Column:
            whole = F.filter(held, lambda t: part(t).bitwiseAND(mask) == k)
            half = lambda a: F.filter(a, lambda t: more(t).bitwiseAND(1) == 0)
            quarter = lambda a: F.filter(a, lambda t: more(t).bitwiseAND(3) == 0)
            return F.transform(F.array(whole), lambda a: F.concat(digits(a), digits(half(a)), digits(quarter(a))))[0]

        return F.transform(F.array(few), lambda held: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SUBSETS // 3 - 1)), lambda k: subset(held, k)), ""))[0]

    return F.when(n == 0, "0").otherwise(F.concat(F.lpad(F.hex(level), 2, "0"), *(family(j) for j in range(3))))


def likeness(a: str, b: str) -> Column:
    """The likeness of two fingerprint columns, from 0 to 1."""
    x, y = F.col(a), F.col(b)
    level = lambda c: F.conv(F.substring(c, 1, 2), 16, 10).cast("int")
    apart = level(y) - level(x)
    part = lambda c, k, size: F.substr(c, (F.lit(3) + 12 * k + 4 * size).cast("int"), F.lit(4))

    def of(k: Column) -> Column:
        sizes = F.sequence(F.greatest(F.lit(0), apart), F.least(F.lit(2), F.lit(2) + apart))
        pairs = F.transform(sizes, lambda s: F.struct(part(x, k, s).alias("p"), part(y, k, s - apart).alias("q")))
        return F.filter(pairs, lambda z: (z["p"] != "....") | (z["q"] != "...."))

    seen = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), of))
    share = F.transform(F.array(seen), lambda s: F.size(F.filter(s, lambda z: z["p"] == z["q"])) / F.greatest(F.size(s), F.lit(1)))[0]
    return F.when(x == y, 1.0).when((x == "0") | (y == "0") | (F.abs(apart) > 2), 0.0).otherwise(share.cast("double"))


def _parts(docs: DataFrame, least: int) -> tuple[Column, int]:
    """The number of a row's part (a column) and how many tasks to deal them to: parts follow each other in the order of doc_id (descending) and the text's hash.

    There is a part for every ``PART_BYTES`` of text, ``least`` at least and ``MOST_PARTS``
    at most. Cut points are percentiles of doc_id; an id (or null) on which several of
    them fall is cut by its texts' hashes as often.
    """
    key = F.coalesce("doc_id", F.lit(NO_ID))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(MOST_PARTS, max(least, -(-size // PART_BYTES)))
    cuts = docs.select(F.percentile_approx(key, [k / parts for k in range(1, parts)], max(10_000, 10 * parts))).first()[0] if parts > 1 else None
    often = collections.Counter(cuts or [])
    cuts = sorted(often, reverse=True)
    # two steps of about the root of the number of cuts each
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[k : k + step] for k in range(0, len(cuts), step)]
    below = lambda xs: F.size(F.filter(xs, lambda c: key < c))
    if not cuts:
        return F.lit(0).cast("long"), parts
    coarse = below(F.array(*(F.lit(g[0]) for g in groups)))
    fine = below(F.get(F.array(*(F.array(*map(F.lit, g)) for g in groups)), F.greatest(coarse - 1, F.lit(0))))
    part = F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)
    hot = [c for c in cuts if often[c] > 1]
    pieces = F.lit(1)
    if hot:
        pieces = F.coalesce(F.get(F.array(*(F.lit(often[c] + 1) for c in hot)), F.array_position(F.array(*map(F.lit, hot)), key).cast("int") - 1), F.lit(1))
    # the hash's first 32 bits, largest first
    place = F.floor((F.lit(2**31 - 1) - F.shiftright("hash", 32)) * pieces / F.lit(2**32))
    return (part * (MOST_PARTS + 1) + place).cast("long"), 2 * parts


def followed(docs: DataFrame, parts: int, sign) -> DataFrame:
    """``docs`` (doc_id, text) with their fingerprint (``sign`` of the text) and the next document's text and fingerprint.

    The next document is that of the next smaller doc_id; after the last comes the first.
    ``parts`` is the least number of parts.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    part, tasks = _parts(docs, parts)
    rows = docs.withColumn("part", part)
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash").desc(), F.col("text").desc()]
    ranked = rows.withColumn("fingerprint", sign(F.col("text"))).repartition(tasks, "part").withColumn("next", F.lead(F.struct("text", "fingerprint")).over(Window.partitionBy("part").orderBy(*order)))
    # the first row of each part: its place without carrying texts, then its text
    place = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), "hash")
    tops = written(rows.groupBy("part").agg(F.max(place).alias("top")), "tops")
    heads = rows.withColumn("top", place).join(F.broadcast(tops), ["part", "top"]).groupBy("part").agg(F.max("text").alias("text"))
    heads = written(heads, "heads").withColumn("fingerprint", sign(F.col("text")))
    ring = Window.orderBy("part")
    turns = tops.select("part", F.coalesce(F.lead("part").over(ring), F.first("part").over(ring)).alias("then"))
    after = heads.select(F.col("part").alias("then"), F.struct("text", "fingerprint").alias("after")).join(F.broadcast(turns), "then").select("part", "after")
    # texts of heads grow with the parts, so they aren't broadcast; rows are in order of part already
    return ranked.join(written(after, "after").hint("merge"), "part").select("doc_id", "text", "fingerprint", F.coalesce("next", "after").alias("next"))


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    inside = lexicon(docs)
    rows = followed(docs, int(spark.conf.get("spark.sql.shuffle.partitions")), lambda text: fingerprint_of(text, inside))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr(F.col("next.text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", F.col("next.fingerprint").alias("next_fingerprint"), edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", fingerprint_of(F.col("edited"), inside).alias("edited_fingerprint"), "next_fingerprint")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next_fingerprint").alias("near_next"))


def fingerprint_of(text: Column, inside) -> Column:
    """The fingerprint of a text column."""
    return F.transform(F.array(kept_terms(text, inside)), fingerprint)[0]
