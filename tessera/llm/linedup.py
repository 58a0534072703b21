"""Line dedup: an exact set-similarity self-join of lines, and removal of later matches.

A line's tokens are its distinct words between ASCII white space, A-Z lower-cased. Two
lines match if the Jaccard similarity of their tokens is at least ``similarity``. A line
goes if any earlier line (by doc_id, then by place) matches it; blank lines stay.

1. Token frequencies over all texts, in a fixed number of slots (an array of 4 MB is
   broadcast). The order by slot frequency, then hash, is a total order of tokens, so the
   filters below are exact, whatever shares a slot.
2. Lines of equal sets are one set. The first line of each set gives its rarest tokens, as
   many as the prefix filter asks for; sets meet in a join on a prefix token under the length
   and the positional filter and under a bitmap filter: 128 parities of the tokens bound the
   symmetric difference from below. This join is a semi-join: it leaves the sets that have
   any partner, however many, so a family of variants costs a row a member, not a row a pair.
3. Only those sets' tokens (64-bit hashes) are gathered. Each set is verified against the
   ``LEADERS`` earliest partners under each of its tokens; sets that match are settled, the
   rest are held against more leaders, and at last against all earlier partners. So a large
   family is verified against its first members, and no match is lost.
4. For sets that repeat or match, the place of the line that stays (if any) is written as
   a sorted hash array that workers map. The last pass reads the texts once more and
   drops lines, found by a hash of their bytes; texts are never shuffled.

Defined cases: a null text is an empty one and stays null. A null doc_id comes after all
others. Rows that repeat a doc_id, or have none, are documents of their own in the order of
a hash of their texts (``row``); only rows of equal id and text are one document: a line
that stays is kept in each. Other columns pass through.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import mapped, words
from .shared import free_names, lean, table, written

SIMILARITY, SLOTS, LAST = 0.8, 1 << 20, 2**63 - 1
#: How many of the earliest lines under a token a line is held against, before all others are.
LEADERS = (4, 64)
#: Lines of a shard of the lines' tokens.
TOKEN_ROWS = 200_000
PLACE = ("doc", "row", "line")
LINE = "raw long, set long, doc long, row long, line int, n int, low long, high long, prefix array<int>"


class Lines:
    """The lines of a run of texts: owner, place in the text, first byte and end."""

    def __init__(self, texts: pa.Array):
        self.data, self.texts = words.raw_bytes(texts)
        breaks = np.flatnonzero(self.data == 10)
        owner = np.concatenate([np.arange(len(texts)), np.searchsorted(self.texts, breaks, "right") - 1])
        starts = np.concatenate([self.texts[:-1], breaks + 1])
        order = np.lexsort((starts, owner))
        self.owner, self.starts = owner[order], starts[order]
        self.first = np.searchsorted(self.owner, np.arange(len(texts) + 1))
        self.place = np.arange(len(order)) - self.first[self.owner]
        last = np.append(self.owner[1:] != self.owner[:-1], True)
        self.ends = np.where(last, self.texts[1:][self.owner], np.append(self.starts[1:], 0) - 1)
        self.raw = self.data.tobytes()

    def __len__(self):
        return len(self.starts)

    def keys(self) -> np.ndarray:
        """A hash of each line's bytes."""
        held = memoryview(self.raw)
        return np.array([xxhash.xxh64_intdigest(held[a:b]) for a, b in zip(self.starts.tolist(), self.ends.tolist())], np.uint64)

    def tokens(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct tokens of each line, rarest first: line, and token (frequency rank above 36 bits of hash)."""
        begin, end, _ = words.spans_of(self.data, self.texts)
        hashes, line = words.span_hashes(self.data, begin, end), np.searchsorted(self.starts, begin, "right") - 1
        token = rank[(hashes & np.uint64(SLOTS - 1)).astype(np.int64)] | (hashes >> np.uint64(28))
        if len(self) >= 1 << 20:  # one very long text
            return _distinct(line, token)
        held = np.sort((line.astype(np.uint64) << np.uint64(44)) | token)
        if len(held):
            held = held[np.append(True, held[1:] != held[:-1])]
        return (held >> np.uint64(44)).astype(np.int64), held & np.uint64((1 << 44) - 1)

    def hashes(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct 64-bit token hashes in order of the lines ``which``, and the bounds of each line's."""
        held = pa.array([self.raw[a:b] for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist())], pa.large_binary())
        found, owner = words.words_of(held)
        owner, found = _distinct(owner, found)
        return found, words.runs(owner, len(which))


def _distinct(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (values[1:] != values[:-1]))[: len(owner)]
    return owner[new], values[new]


def _docs(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


def _texts(part: pa.Array) -> np.ndarray:
    """A hash of each text."""
    return np.array([xxhash.xxh64_intdigest(x.as_buffer()) for x in part], np.uint64).view(np.int64)


def frequencies(docs: DataFrame) -> np.ndarray:
    """How often words of each slot occur in all texts, as ranks in bits 36 to 43."""
    parts = SLOTS >> 14

    def count(batches):
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, part in words.slices(words.texts_of(batch)):
                held, _ = words.words_of(part)
                total += np.bincount((held & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        if total.any():
            cut = total.reshape(parts, -1)
            small = cut.max() < 1 << 32
            yield pa.RecordBatch.from_pydict({"part": np.arange(parts, dtype=np.int32), "n": [x.astype(np.uint32 if small else np.uint64).tobytes() for x in cut]})

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(SLOTS // parts, np.int64)
        for x in t.column("n"):
            total += np.frombuffer(x.as_py(), np.uint32 if len(x.as_buffer()) == 4 * len(total) else np.uint64).astype(np.int64)
        return pa.table({"part": t.column("part").slice(0, 1), "n": [total.tobytes()]})

    found = docs.select("text").mapInArrow(lean(count), "part int, n binary").groupBy("part").applyInArrow(add, "part int, n binary").toArrow()
    out = np.zeros((parts, SLOTS // parts), np.int64)
    for part, n in zip(found.column("part").to_pylist(), found.column("n").to_pylist()):
        out[part] = np.frombuffer(n, np.int64)
    # a rank for every frequency up to 64, above that eight for each power of two
    n = out.reshape(-1).astype(np.float64)
    ranks = np.where(n <= 64, n, np.minimum(64 + 8 * np.log2(np.maximum(n, 64) / 64), 255))
    return ranks.astype(np.uint64) << np.uint64(36)


def _line_rows(docs: DataFrame, rank, t: Fraction) -> DataFrame:
    """Every line with a token (columns of ``LINE``) and its rarest tokens."""

    def describe(batches):
        for batch in batches:
            ids = _docs(batch)
            for at, part in words.slices(words.texts_of(batch)):
                lines = Lines(part)
                line, tokens = lines.tokens(rank.value)
                cut = words.runs(line, len(lines))
                n = np.diff(cut)
                full = np.flatnonzero(n)
                mixed = words.salted(tokens, 6)
                sets = words.sums(mixed, cut)[full]
                bit, upper = np.uint64(1) << (mixed >> np.uint64(58)), (mixed >> np.uint64(57) & np.uint64(1)).astype(bool)
                parity = lambda x: pa.array((np.bitwise_xor.reduceat(x, cut[full]) if len(full) else sets).view(np.int64))  # noqa: E731, B023
                low, high = parity(np.where(upper, np.uint64(0), bit)), parity(np.where(upper, bit, np.uint64(0)))
                size = n[full] - (n[full] * t.numerator + t.denominator - 1) // t.denominator + 1
                begin = np.cumsum(size) - size
                held = tokens[np.repeat(cut[full], size) + np.arange(int(size.sum())) - np.repeat(begin, size)]
                prefix = pa.ListArray.from_arrays(np.append(begin, size.sum()).astype(np.int32), (held & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32))
                places = [pa.array(ids[at + lines.owner[full]]), pa.array(_texts(part)[lines.owner[full]]), pa.array(lines.place[full].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([pa.array(lines.keys()[full].view(np.int64)), pa.array(sets.view(np.int64)), *places, pa.array(n[full].astype(np.int32)), low, high, prefix], ["raw", "set", *PLACE, "n", "low", "high", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(lean(describe), LINE)


def _heads(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """The first line of each set, told by a mapped table of those sets that occur more than once."""
    again = firsts.filter("n > 1").select(F.col("set").alias("key"), *(F.col(f"first.{c}").cast("long").alias(c) for c in PLACE))
    known = mapped.build(again, again.count(), "repeated-sets", {c: "i8" for c in PLACE})

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(_stands(known, batch.column("set"), *(batch.column(c) for c in PLACE))))

    return lines.mapInArrow(lean(keep), LINE)


def _stands(known: mapped.Mapped, keys: pa.Array, *place: pa.Array, missing: bool = True) -> np.ndarray:
    """Whether each row is in the place that ``known`` has for its key; ``missing`` where it has none."""
    keys = keys.to_numpy(zero_copy_only=False).view(np.uint64)
    shards, places = known.find(keys)
    out = np.full(len(keys), missing)
    for s in np.unique(shards[places >= 0]):
        at, held = np.flatnonzero((shards == s) & (places >= 0)), known.shard(int(s))
        out[at] = np.logical_and.reduce([held[c][places[at]] == v.to_numpy(zero_copy_only=False)[at] for c, v in zip(PLACE, place)])
    return out


def _exploded(heads: DataFrame) -> DataFrame:
    """A row for each prefix token; ``p`` holds the number of tokens and the token's position."""
    packed = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("pos"))
    return heads.select("set", "n", "low", "high", F.posexplode("prefix").alias("pos", "token")).select("token", "set", packed.alias("p"), "low", "high")


def _crowded(kin: DataFrame, crowd: mapped.Mapped, more: int, asked: mapped.Mapped | None = None, gone: mapped.Mapped | None = None) -> DataFrame:
    """Rows as of ``_exploded``, with the lines' places, for tokens of more than ``more`` sets (and among ``asked``), of sets that aren't ``gone``."""
    kept = ("set", *PLACE, "low", "high")

    def explode(batches):
        for batch in batches:
            if gone:
                batch = batch.filter(pa.array(~gone.has(batch.column("set").to_numpy(zero_copy_only=False).view(np.uint64))))
            prefix = batch.column("prefix")
            tokens, size = prefix.flatten(), prefix.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(batch)), size)
            pos = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            keys = tokens.to_numpy(zero_copy_only=False).view(np.uint32).astype(np.uint64)
            keep = crowd.get(keys, "n") > more
            if asked:
                keep &= asked.has(keys)
            keep = np.flatnonzero(keep)
            n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)[owner[keep]]
            own = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays([tokens.take(pa.array(keep)), *(batch.column(c).take(own) for c in kept), pa.array(n << 32 | pos[keep])], ["token", *kept, "p"])

    return kin.mapInArrow(lean(explode), "token int, set long, doc long, row long, line int, low long, high long, p long")


def _near(share: Fraction):
    """The prefix, length, positional and bitmap filters between rows x and y."""
    a, b = share.numerator, share.denominator
    x, y = ({"n": f"({s}.p >> 32)", "pos": f"({s}.p & 4294967295)"} for s in "xy")
    up = lambda num, den: f"(({num} + {den} - 1) div {den})"
    need = up(f"{a} * ({x['n']} + {y['n']})", a + b)
    inside = lambda z: f"{z['pos']} < {z['n']} - {up(f'{2 * a} * ' + z['n'], a + b)} + 1"
    on = F.expr("x.token = y.token")
    for rule in (
        f"{b} * least({x['n']}, {y['n']}) >= {a} * greatest({x['n']}, {y['n']})",
        f"bit_count(x.low ^ y.low) + bit_count(x.high ^ y.high) <= {x['n']} + {y['n']} - 2 * {need}",
        f"if({x['n']} <= {y['n']}, {inside(x)}, {inside(y)})",
        f"least({x['pos']}, {y['pos']}) + least({x['n']} - {x['pos']}, {y['n']} - {y['pos']}) >= {need}",
        "x.set <> y.set",
    ):
        on &= F.expr(rule)
    return on


def _gathered(kin: DataFrame, docs: DataFrame) -> mapped.Mapped:
    """The token hashes of the sets in ``kin``, read from the texts."""
    places = written(kin.select(F.col("raw").alias("key"), "set", *(F.col(c).cast("long").alias(c) for c in PLACE)).dropDuplicates(["key"]), "places")
    wanted = mapped.build(places, places.count(), "wanted-lines", {"set": "i8", **{c: "i8" for c in PLACE}})

    def gather(batches):
        for batch in batches:
            ids = _docs(batch)
            for at, part in words.slices(words.texts_of(batch)):
                lines, row = Lines(part), _texts(part)
                keys = lines.keys()
                full = np.flatnonzero(_stands(wanted, pa.array(keys), pa.array(ids[at + lines.owner]), pa.array(row[lines.owner]), pa.array(lines.place), missing=False))
                held, cut = lines.hashes(full)
                tokens = pa.ListArray.from_arrays(cut.astype(np.int32), pa.array(held.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(wanted.get(keys[full], "set")), tokens], ["key", "tokens"])

    # rows of equal id and text are one document: their lines come more than once
    found = docs.select("doc_id", "text").mapInArrow(lean(gather), "key long, tokens array<long>")
    return mapped.build(found, places.count(), "line-tokens", {"tokens": "u8"}, shard_rows=TOKEN_ROWS)


def _verified(pairs: DataFrame, tokens: mapped.Mapped, share: Fraction) -> DataFrame:
    """The later sets (``y``) of pairs (``x``, ``y``) whose exact similarity is at least ``share``."""

    def keep(batches):
        for whole in batches:
            for at in range(0, len(whole), 20_000):
                batch = whole.slice(at, 20_000)
                (p, n_p), (q, n_q) = (tokens.lists(batch.column(c).to_numpy().view(np.uint64), "tokens") for c in "xy")
                own = lambda held, n: words.mix(held) + words.salted(np.repeat(np.arange(len(batch)), n).astype(np.uint64), 11)  # noqa: E731, B023
                both = np.bincount(np.repeat(np.arange(len(batch)), n_q)[np.isin(own(q, n_q), own(p, n_p))], minlength=len(batch))
                good = share.denominator * both >= share.numerator * (n_p + n_q - both)
                yield batch.select(["y"]).filter(pa.array(good))

    return pairs.mapInArrow(lean(keep), "y long").distinct()


def _matched(docs: DataFrame, lines: DataFrame, firsts: DataFrame, share: Fraction) -> DataFrame:
    """Sets (``set``) whose first line matches an earlier line."""
    near = _near(share)
    heads = written(_heads(lines, firsts), "heads")
    rows = _exploded(heads)
    partnered = written(rows.alias("y").join(rows.alias("x"), near, "left_semi").select(F.col("set").alias("key")).distinct(), "partnered")
    some = mapped.build(partnered, partnered.count(), "partnered-sets", {})

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(some.has(batch.column("set").to_numpy(zero_copy_only=False).view(np.uint64))))

    kin = written(heads.mapInArrow(lean(keep), LINE), "kin")
    tokens = _gathered(kin, docs)
    token = F.col("token").cast("long").bitwiseAND(0xFFFFFFFF).alias("key")
    counts = written(kin.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("n")).filter("n > 1").select(token, "n"), "crowd")
    crowd = mapped.build(counts, counts.count(), "crowd", {"n": "i8"})
    earlier = F.expr("x.doc < y.doc or x.doc = y.doc and (x.row < y.row or x.row = y.row and x.line < y.line)")
    gone, done = None, 1
    for k in (*LEADERS, None):
        left, rows = _crowded(kin, crowd, done), _crowded(kin, crowd, done)
        if gone is not None:
            settled = mapped.build(gone.select(F.col("set").alias("key")), gone.count(), "settled", {})
            left = written(_crowded(kin, crowd, done, gone=settled), "unsettled")
            asked = written(left.select(token).distinct(), "asked")
            rows = _crowded(kin, crowd, done, mapped.build(asked, asked.count(), "asked", {}))
        if k:
            rows = rows.withColumn("turn", F.row_number().over(Window.partitionBy("token").orderBy(*PLACE))).filter(F.col("turn") <= k).drop("turn")
        pairs = rows.alias("x").join(left.alias("y"), near & earlier).select(F.expr("x.set as x"), F.expr("y.set as y")).distinct()
        more = written(_verified(pairs, tokens, share).withColumnRenamed("y", "set"), "matched")
        gone, done = more if gone is None else gone.union(more), k
    return gone


def standing(docs: DataFrame, similarity: float = SIMILARITY) -> mapped.Mapped:
    """For lines that repeat or match, by their bytes: document, row and place of the line that stays (-1: none)."""
    share = Fraction(str(similarity))
    rank = docs.sparkSession.sparkContext.broadcast(frequencies(docs))
    lines = written(_line_rows(docs, rank, share), "lines")
    rank.destroy()
    firsts = written(lines.groupBy("set").agg(F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("n")), "firsts")
    gone = _matched(docs, lines, firsts, share).withColumn("gone", F.lit(True))
    known = firsts.join(gone, "set", "left").filter("n > 1 or gone")
    known = written(known.select("set", F.col("first.doc").alias("doc"), F.col("first.row").alias("row"), F.when(F.col("gone"), -1).otherwise(F.col("first.line")).cast("long").alias("line")), "known")
    raws = lines.groupBy("raw").agg(F.min("set").alias("set"))
    rows = written(raws.join(known, "set").select(F.col("raw").alias("key"), *PLACE), "standing")
    return mapped.build(rows, rows.count(), "standing", {c: "i8" for c in PLACE})


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with their later matching lines removed from ``text``, ``n_lines`` and ``n_links``, the lines removed."""
    known = standing(docs, similarity)
    docs = docs.drop("n_lines", "n_links")

    def drop(batches):
        for batch in batches:
            ids, texts = _docs(batch), words.texts_of(batch)
            out, n_lines, n_gone = [], [], []
            for at, part in words.slices(texts):
                lines, row = Lines(part), _texts(part)
                gone = ~_stands(known, pa.array(lines.keys()), pa.array(ids[at + lines.owner]), pa.array(row[lines.owner]), pa.array(lines.place))
                n_lines.append(np.bincount(lines.owner, minlength=len(part)))
                n_gone.append(np.bincount(lines.owner[gone], minlength=len(part)))
                for i, n in enumerate(n_gone[-1]):
                    if n:
                        kept = lines.first[i] + np.flatnonzero(~gone[lines.first[i] : lines.first[i + 1]])
                        out.append(b"\n".join(lines.raw[lines.starts[j] : lines.ends[j]] for j in kept).decode())
                    else:
                        out.append(batch.column("text")[at + i].as_py())
            count = lambda x: pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64))
            columns = [pa.array(out, pa.string()) if n == "text" else c for n, c in zip(batch.schema.names, batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, count(n_lines), count(n_gone)], [*batch.schema.names, "n_lines", "n_links"])

    fields = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(lean(drop), f"{fields}, n_lines long, n_links long")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later matches of lines; those of which no word is left go."""
    added = ["n_lines", "n_links"]
    own = dict(zip(added, free_names(docs, *added)))
    out = dedup_lines(docs.withColumnsRenamed(own)).filter(r"n_links = 0 or text rlike '[^\\x20\\x09-\\x0D]'").drop(*added)
    out = out.withColumnsRenamed({v: k for k, v in own.items() if v in out.columns})
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
