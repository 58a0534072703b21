"""Interpolated modified Kneser-Ney language model over words, of order 3 (or 2), counted in Spark.

The model's tables grow with the corpus, so none of them is collected or broadcast.
Counts are merged in shards, each of a bounded number of tokens, and written as sorted
hash arrays to the shared folder, which workers memory-map to score:

- words: the sorted 64-bit hashes of the vocabulary and their counts; a word's place in
  this order is its id (32 bits);
- pairs: the sorted pairs of ids, in shards by a hash of the pair, so that a frequent
  word's followers are spread over all of them. Beside each pair stand, at order 3, the
  words that follow it with their counts, and how many different words precede it; at
  order 2, how often it occurs;
- contexts: by id, the total of a word's followers, how many of them count one, two and
  more, and how many different words precede it.

Trigrams are counted once and shuffled to the shard of their first two words, and each
shard passes on how many different words it saw before each pair of the last two. All
followers of one pair are in one shard: no more rows than there are words.

A trigram's probability is its discounted count over its context's total, plus the mass
so freed times that of its last two words, which is made in the same way from how many
different words precede the pair; so is the last word's, interpolated with a uniform
distribution over the vocabulary and one unknown word. The three discounts of each order
come from the counts of counts. After a context that wasn't seen the lower order stands
alone.

Tokens are runs of other bytes than ASCII white space, A-Z lower-cased, and one end for
each text; the first token follows two starts, which are no tokens.

Defined cases: a null text is an empty one (only the end). Repeated rows count, and are
scored, as often as they occur. Without training rows every token is unknown. A null
doc_id is trained on. Where counts of counts are too few for the discounts, they are
0.5, 1 and 1.5. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mapped, words
from .langid import held_out
from .shared import freed_shuffles, lean, passing, shared_path, table

#: Tokens that a task gathers before it passes counts on; rows of a shard; ids of a part of the contexts.
GATHER, SHARD, PART_BITS = 4_000_000, 2_000_000, 18
#: Followers of a pair up to which its sums are taken when they are needed, and pairs of a block of widths.
FEW, BLOCK = 16, 64
#: Of each place in a block: a mask of the bytes before it, eight to a number; every second byte of a number.
EARLIER = np.where(np.arange(BLOCK) < np.arange(BLOCK)[:, None], np.uint8(255), np.uint8(0)).view(np.uint64)
EVEN = np.uint64(0x00FF00FF00FF00FF)
END = np.uint64(0x5851F42D4C957F2D)
#: In place of a follower's id: the pair ends a text.
NONE = 0xFFFFFFFF
LOW = np.uint64(0xFFFFFFFF)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens with an end after each text's, and the bounds of the texts."""
    held, owner = words.words_of(texts)
    bounds = words.runs(owner, len(texts)) + np.arange(len(texts) + 1)
    out = np.empty(len(held) + len(texts), np.uint64)
    out[np.arange(len(held)) + owner] = held
    out[bounds[1:] - 1] = END
    return out, bounds


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _gathered(batches, each):
    """Distinct keys and counts of ``each(texts)``, for every ``GATHER`` keys or so."""
    held, n = [], 0
    for batch in batches:
        for _, part in words.slices(words.texts_of(batch)):
            held.append(np.unique(each(part), return_counts=True))
            n += len(held[-1][0])
            if n >= GATHER:
                yield _merge(held)
                held, n = [], 0
    if held:
        yield _merge(held)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte by byte of their numbers, so that equal bytes stand together, compressed."""
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() for x in arrays]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(blob, rows: int, *dtypes: str) -> list[np.ndarray]:
    widths = [np.dtype(t).itemsize for t in dtypes]
    data, out, at = np.frombuffer(pa.decompress(blob, rows * sum(widths), codec="zstd"), np.uint8), [], 0
    for t, w in zip(dtypes, widths):
        out.append(np.ascontiguousarray(data[at : at + rows * w].reshape(w, rows).T).view(t).reshape(-1))
        at += rows * w
    return out


def _grams_packed(keys: np.ndarray, *others: np.ndarray) -> bytes:
    """Sorted pairs of ids, the first ids as steps, and what stands beside them."""
    return _packed(np.diff(keys >> np.uint64(32), prepend=np.uint64(0)).astype(np.uint32), (keys & LOW).astype(np.uint32), *others)


def _grams_unpacked(blob, rows: int, *dtypes: str) -> list[np.ndarray]:
    steps, low, *others = _unpacked(blob, rows, "u4", "u4", *dtypes)
    return [(np.cumsum(steps, dtype=np.uint64) << np.uint64(32)) | low, *others]


def _by_shard(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the keys by shard that keeps their own within it, and the bounds of the shards."""
    shards = mapped.shard_of(keys, bits)
    order = np.argsort(shards.astype(np.uint16) if bits <= 16 else shards, kind="stable")
    return order, np.searchsorted(shards[order], np.arange((1 << bits) + 1))


def _narrow(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in 32 bits where they fit, else in 64."""
    return x.astype(np.uint32 if not x.size or x.max() < 1 << 32 else np.int64)


def _trigrams_merged(keys: np.ndarray, after: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (pair, follower) in order, and the sums of their counts (without: one each)."""
    order = np.lexsort((after, keys))
    keys, after, n = keys[order], after[order], n if n is None else n[order]
    first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (after[1:] != after[:-1]))) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(first, append=len(keys)) if n is None else np.add.reduceat(n, first) if len(first) else n
    return keys[first], after[first], n


def _kinds(n: np.ndarray) -> np.ndarray:
    """Of each count: itself, and whether it is one, two, more."""
    return np.stack([n, n == 1, n == 2, n >= 3], axis=1).astype(np.int64)


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how many counts are 1, 2, 3 and 4."""
    n1, n2, n3, n4 = map(float, n)
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    found = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(found, [0, 0.05, 0.1, 0.15], [0, 1, 2, 3])


class Model:
    """Where the model's tables are, and its few numbers; picklable."""

    def __init__(self, order: int, vocabulary: mapped.Mapped, bigrams: mapped.Mapped, contexts: str, tokens: int, size: int):
        self.order, self.vocabulary, self.bigrams, self.contexts = order, vocabulary, bigrams, contexts
        #: Training tokens, words of the vocabulary, different bigrams.
        self.tokens, self.size, self.types = tokens, size, 0
        #: Discounts of the words, pairs and trigrams; the mass of the uniform distribution.
        self.d1, self.d2, self.d3, self.free = np.zeros(4), np.zeros(4), np.zeros(4), 1.0

    def _known(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (-1: unknown) and count of each of these different words."""
        ids, counts = np.full(len(distinct), -1, np.int64), np.zeros(len(distinct), np.int64)
        for s, at in _each_shard(mapped.shard_of(distinct, self.vocabulary.bits)):
            held = self.vocabulary.shard(s)
            places, found = _places(held["keys"], distinct[at])
            ids[at[found]], counts[at[found]] = self.vocabulary.base[s] + places, held["n"][places]
        return ids, counts

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (-1: unknown) and count of each token."""
        distinct, back = np.unique(hashes, return_inverse=True)
        ids, counts = self._known(distinct)
        return ids[back], counts[back]

    def pairs(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The context of each token, and the key of both."""
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[bounds[:-1]] = self.size  # the start
        return before, (before.astype(np.uint64) << np.uint64(32)) | (ids.astype(np.uint64) & np.uint64(0xFFFFFFFF))

    def trigrams(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pair before each token, and the token; then each text's last pair, before no token."""
        keys = self.pairs(ids, bounds)[1]
        before = np.empty_like(keys)
        before[1:] = keys[:-1]
        before[bounds[:-1]] = (self.size << 32) | self.size
        return np.append(before, keys[bounds[1:] - 1]), np.append(ids, np.full(len(bounds) - 1, NONE)).astype(np.uint32)

    def _pairs_held(self, pairs: np.ndarray, shards: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each of these different pairs: its count and, at order 3, where its followers begin, how many there are, their total and the mass that their discounts free."""
        counts, start, size, total, mass = *np.zeros((4, len(pairs)), np.int64), np.zeros(len(pairs))
        for s, at in _each_shard(shards):
            held = self.bigrams.shard(s)
            places, found = _places(held["keys"], pairs[at])
            at = at[found]
            if len(held["n"]):  # a shard of the two starts alone has no counts
                n = held["n"][places].astype(np.int64)
                many = np.flatnonzero(n == 255)
                if len(many):
                    n[many] = held["many_n"][np.searchsorted(held["many"], pairs[at[many]])]
                counts[at] = n
            if self.order == 3 and len(at):
                start[at], size[at], kinds = _widths(held, places)
                total[at], mass[at] = kinds[:, 0], kinds[:, 1:] @ self.d3[1:]
        return counts, start, size, total, mass

    def _followers(self, shards: np.ndarray, places: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each pair, given its place (-1: none), is followed by the id; its total and its followers by kind."""
        counts, kinds, held = np.zeros(len(places), np.int64), np.zeros((len(places), 4), np.int64), np.flatnonzero(places >= 0)
        for s, at in _each_shard(shards[held]):
            at = held[at]
            start, size, kinds[at] = _widths(self.bigrams.shard(s), places[at])
            open_ = np.flatnonzero(size)
            counts[at[open_]] = _counts_of(self.bigrams.shard(s), start[open_], size[open_], ids[at[open_]])
        return counts, kinds

    def _context(self, ids: np.ndarray) -> np.ndarray:
        """The five numbers of each id."""
        out = np.zeros((len(ids), 5), np.int64)
        for p, at in _each_shard(ids >> PART_BITS):
            held = _CONTEXTS.get((self.contexts, p))
            if held is None:
                for other in [k for k in _CONTEXTS if k[0] != self.contexts]:
                    del _CONTEXTS[other]
                held = mapped._array(self.contexts, p, "five", "u4")
                held = _CONTEXTS[(self.contexts, p)] = (held if len(held) else mapped._array(self.contexts, p, "five", "i8")).reshape(-1, 5)
            out[at] = held[ids[at] & ((1 << PART_BITS) - 1)]
        return out

    def score(self, hashes: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        """Of each text: tokens, known tokens, log10 probability under add-one unigrams and under the model.

        What depends on a word or on a pair is taken once for each different one.
        """
        words_, back = np.unique(hashes, return_inverse=True)
        own, counts = self._known(words_)
        base = np.log10((counts + 1.0) / (self.tokens + self.size + 1.0))[back]
        ids, held = own[back], np.flatnonzero(own >= 0)
        known = ids >= 0
        p = np.full(len(words_), self.free / (self.size + 1.0))
        if len(held):
            # a word's total and free mass as a context; the start comes after all words
            five = self._context(np.append(own[held], self.size))
            cont = five[:-1, 4]
            p[held] += (cont - self.d1[np.minimum(cont, 3)]) / self.types
            p, total, mass = p[back], np.zeros(len(words_) + 1, np.int64), np.zeros(len(words_) + 1)
            total[np.append(held, -1)], mass[np.append(held, -1)] = five[:, 0], five[:, 1:4] @ self.d2[1:]
            word = np.empty(len(ids), np.int64)
            word[1:] = back[:-1]
            word[bounds[:-1]] = len(words_)
            before, keys = self.pairs(ids, bounds)
            valid = np.flatnonzero(np.append(known & (before >= 0), True))
            pairs, at = np.unique(np.append(keys, np.uint64((self.size << 32) | self.size))[valid], return_inverse=True)
            of = np.full(len(keys) + 1, len(pairs))  # no pair: a row of zeros after all
            of[valid] = at
            shards = mapped.shard_of(pairs, self.bigrams.bits)
            c, start, size, total3, mass3 = (np.append(x, x.dtype.type(0)) for x in self._pairs_held(pairs, shards))
            after = np.flatnonzero(total[word] > 0)
            n, word = c[of[after]], word[after]
            p[after] = (n - self.d2[np.minimum(n, 3)] + mass[word] * p[after]) / total[word]
            if self.order == 3:
                pair = np.arange(-1, len(ids) - 1)
                pair[bounds[:-1]] = len(ids)  # two starts
                seen = np.flatnonzero(total3[of[pair]] > 0)
                of = of[pair[seen]]
                n, asked = np.zeros(len(seen), np.int64), np.flatnonzero(known[seen])
                for s, at in _each_shard(shards[of[asked]]):
                    at = asked[at]
                    n[at] = _counts_of(self.bigrams.shard(s), start[of[at]], size[of[at]], ids[seen[at]])
                p[seen] = (n - self.d3[np.minimum(n, 3)] + mass3[of] * p[seen]) / total3[of]
        else:
            p = p[back]
        return {"n_tokens": np.diff(bounds), "n_known": words.sums(known.astype(np.int64), bounds), "base_score": words.sums(base, bounds), "score": words.sums(np.log10(p), bounds)}


def _each_shard(shards: np.ndarray):
    """Each shard's number and its places in the array, from one sort: work doesn't grow with the number of shards."""
    order = np.argsort(shards.astype(np.uint16) if len(shards) and shards.max() < 1 << 16 else shards, kind="stable")
    held = shards[order]
    cut = np.flatnonzero(held[1:] != held[:-1]) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(order)] if len(order) else []):
        yield int(held[a]), order[a:b]


def _places(held: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of those keys that are held, and which these are."""
    if not len(held):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = np.minimum(np.searchsorted(held, keys), len(held) - 1)
    found = np.flatnonzero(held[places] == keys)
    return places[found], found


def _counts_at(held: dict, at: np.ndarray) -> np.ndarray:
    """Counts of the followers at these places of a shard."""
    out = held["count"][at].astype(np.int64)
    lots = np.flatnonzero(out == 255)
    if len(lots):
        out[lots] = held["lots_n"][np.searchsorted(held["lots"], at[lots])]
    return out


def _before(width: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The sum of the widths before each place in its block: eight bytes at once, in four lanes of 16 bits."""
    held = width.view(np.uint64).reshape(-1, BLOCK // 8)[places // BLOCK] & EARLIER[places % BLOCK]
    lanes = ((held & EVEN) + ((held >> np.uint64(8)) & EVEN)).sum(axis=1)
    return ((lanes * np.uint64(0x0001000100010001)) >> np.uint64(48)).astype(np.int64)


def _widths(held: dict, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each of a shard's pairs at these places: where its followers begin, how many there are, and they by kind."""
    block = places // BLOCK
    start = held["start"][block] + _before(held["width"], places)
    size = held["width"][places].astype(np.int64)
    if len(held["wide"]):
        more = np.append(0, np.cumsum(held["wide_n"] - 255))
        start += more[np.searchsorted(held["wide"], places)] - more[np.searchsorted(held["wide"], block * BLOCK)]
        full = np.flatnonzero(size == 255)
        size[full] = held["wide_n"][np.searchsorted(held["wide"], places[full])]
    kinds = np.zeros((len(places), 4), np.int64)
    few, many = np.flatnonzero((size > 0) & (size <= FEW)), np.flatnonzero(size > FEW)
    if len(few):
        ends = np.cumsum(size[few])
        first = ends - size[few]
        n = _counts_at(held, np.arange(ends[-1]) + np.repeat(start[few] - first, size[few]))
        for k, part in enumerate((n, n == 1, n == 2)):
            kinds[few, k] = np.add.reduceat(part, first, dtype=np.int64)
        kinds[few, 3] = size[few] - kinds[few, 1] - kinds[few, 2]
    if len(many):
        kinds[many] = held["big_kinds"].reshape(-1, 4)[np.searchsorted(held["big"], places[many])]
    return start, size, kinds


def _counts_of(held: dict, start: np.ndarray, size: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """How often each id stands among a shard's followers from ``start`` on, ``size`` of them, one or more."""
    low, high, counts = start.copy(), start + size, np.zeros(len(ids), np.int64)
    open_ = np.arange(len(ids))
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        less = held["after"][middle] < ids[open_]
        low[open_[less]], high[open_[~less]] = middle[less] + 1, middle[~less]
        open_ = open_[low[open_] < high[open_]]
    asked = np.flatnonzero(low < start + size)
    asked = asked[held["after"][low[asked]] == ids[asked]]
    counts[asked] = _counts_at(held, low[asked])
    return counts


def _save_followers(path: str, shard: int, keys: np.ndarray, after: np.ndarray, n: np.ndarray) -> None:
    """Write a shard's pairs and their followers: distinct (pair, follower) in order, with counts."""
    real = after != NONE
    pairs, first = np.unique(keys, return_index=True)
    size = np.add.reduceat(real.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    after, n = after[real], n[real]
    start = np.cumsum(size) - size
    width = np.zeros(-(-len(pairs) // BLOCK) * BLOCK, np.uint8)
    width[: len(pairs)] = np.minimum(size, 255)
    wide, big, lots = np.flatnonzero(size >= 255), np.flatnonzero(size > FEW), np.flatnonzero(n >= 255)
    upto = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(_kinds(n), axis=0)])
    mapped.save(
        path, shard, keys=pairs, width=width, start=start[::BLOCK], wide=wide, wide_n=size[wide], big=big,
        big_kinds=(upto[start[big] + size[big]] - upto[start[big]]).reshape(-1), after=after, count=np.minimum(n, 255).astype(np.uint8), lots=lots, lots_n=n[lots],
    )


#: Parts of the contexts that are open in this process, of one model at a time.
_CONTEXTS: dict = {}


def _vocabulary(texts: DataFrame) -> tuple[mapped.Mapped, int, int]:
    """The words' table, how many words there are and how many tokens."""

    def count(batches):
        for keys, n in _gathered(batches, lambda part: tokens_of(part)[0]):
            yield pa.RecordBatch.from_pydict({"key": keys.view(np.int64), "n": n})

    with passing(texts.mapInArrow(lean(count), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "words") as counted:
        size, tokens = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if size >= 2**32 - 2:
            raise ValueError("more words than ids of 32 bits")
        return mapped.build(counted, size, "vocabulary", {"n": "u4" if tokens < 1 << 32 else "i8"}), size, tokens


def fit(texts: DataFrame, order: int = 3) -> Model:
    """Count and write the model of the column ``text`` of all rows; ``order`` is 3 or 2."""
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    with freed_shuffles(texts.sparkSession):
        return _fit(texts.select("text"), order)


def _fit(texts: DataFrame, order: int) -> Model:
    spark = texts.sparkSession
    vocabulary, size, tokens = _vocabulary(texts)
    bits = mapped.shard_bits(tokens, SHARD)
    values = {"n": "u1", "many": "u8", "many_n": "i8"}
    if order == 3:
        values |= {"width": "u1", "after": "u4", "count": "u1"} | dict.fromkeys(("start", "wide", "wide_n", "big", "big_kinds", "lots", "lots_n"), "i8")
    bigrams = mapped.Mapped(shared_path(spark, "pairs"), bits, values)
    model = Model(order, vocabulary, bigrams, shared_path(spark, "contexts"), tokens, size)
    blobs = "shard int, size long, blob binary"

    def sent(keys: np.ndarray, *others: np.ndarray) -> pa.Table:
        """A blob for each shard of sorted keys and of what stands beside them."""
        by, cut = _by_shard(keys, bits)
        full = np.flatnonzero(np.diff(cut))
        packed = [_grams_packed(*(x[by[cut[s] : cut[s + 1]]] for x in (keys, *others))) for s in full]
        return pa.table({"shard": full.astype(np.int32), "size": np.diff(cut)[full], "blob": pa.array(packed, pa.binary())})

    def received(t: pa.Table, *dtypes: str) -> list[np.ndarray]:
        parts = [_grams_unpacked(b.as_buffer(), n, *dtypes) for b, n in zip(t.column("blob").combine_chunks(), t.column("size").to_pylist())]
        return [np.concatenate(x) for x in zip(*parts)]

    def pairs(part: pa.Array) -> np.ndarray:
        hashes, bounds = tokens_of(part)
        return model.pairs(model.ids(hashes)[0], bounds)[1]

    def count_pairs(batches):
        for keys, n in _gathered(batches, pairs):
            yield from sent(keys, n).to_batches()

    def count_trigrams(batches):
        held, n = [], 0

        def merged():
            keys, after = (np.concatenate(x) for x in zip(*held))
            held.clear()
            return sent(*_trigrams_merged(keys, after)).to_batches()

        for batch in batches:
            for _, part in words.slices(words.texts_of(batch)):
                hashes, bounds = tokens_of(part)
                held.append(model.trigrams(model.ids(hashes)[0], bounds))
                n += len(held[-1][0])
                if n >= GATHER:
                    yield from merged()
                    n = 0
        if held:
            yield from merged()

    def counts_of_counts(n: np.ndarray) -> bytes:
        return np.bincount(np.minimum(n, 5), minlength=6)[1:5].astype(np.int64).tobytes()

    def merge_trigrams(t: pa.Table) -> pa.Table:
        """Write a shard's followers; return the counts of its counts and, for each shard of pairs, how many words it saw before each."""
        keys, after, n = _trigrams_merged(*received(t, "u4", "i8"))
        _save_followers(bigrams.path, t.column("shard")[0].as_py(), keys, after, n)
        real = after != NONE
        ends, preceding = np.unique((keys[real] << np.uint64(32)) | after[real], return_counts=True)
        return pa.concat_tables([pa.table({"shard": pa.array([-1], pa.int32()), "size": [0], "blob": pa.array([counts_of_counts(n[real])], pa.binary())}), sent(ends, preceding)])

    def merge(t: pa.Table) -> pa.Table:
        """Write a shard's pairs; return the counts of its counts and, in blobs by part, what it adds to each id's five numbers."""
        keys, n = _merge([tuple(received(t, "i8"))])
        shard, many = t.column("shard")[0].as_py(), n >= 255
        if order == 2:
            mapped.save(bigrams.path, shard, keys=keys)
            held = keys
        else:
            held = mapped._array(bigrams.path, shard, "keys", "u8")
        short = np.zeros(len(held), np.uint8)
        short[np.searchsorted(held, keys)] = np.minimum(n, 255)
        mapped.save(bigrams.path, shard, n=short, many=keys[many], many_n=n[many])
        out = {"part": [-1], "size": [0], "wide": [False], "blob": [counts_of_counts(n)]}
        before, after = (keys >> np.uint64(32)).astype(np.int64), (keys & LOW).astype(np.int64)
        ids, start = np.unique(before, return_index=True)
        kinds = _kinds(n)
        own, back = np.unique(np.append(ids, after), return_inverse=True)
        five = np.zeros((len(own), 5), np.int64)
        five[back[: len(ids)], :4] = np.add.reduceat(kinds, start, axis=0) if len(ids) else kinds
        five[:, 4] = np.bincount(back[len(ids) :], minlength=len(own))
        cut = np.searchsorted(own >> PART_BITS, np.arange((size >> PART_BITS) + 2))
        for p in np.flatnonzero(np.diff(cut)):
            a, b = cut[p], cut[p + 1]
            held = _narrow(five[a:b])
            out["part"].append(int(p))
            out["size"].append(int(b - a))
            out["wide"].append(held.itemsize == 8)
            out["blob"].append(_packed(np.diff(own[a:b] & ((1 << PART_BITS) - 1), prepend=0).astype(np.uint32), *held.T))
        return pa.table({"part": pa.array(out["part"], pa.int32()), "size": pa.array(out["size"], pa.int64()), "wide": out["wide"], "blob": pa.array(out["blob"], pa.binary())})

    def total(rows: DataFrame, column: str) -> np.ndarray:
        return sum((np.frombuffer(r[0], np.int64) for r in rows.select(column).toLocalIterator()), np.zeros(4, np.int64))

    def add(t: pa.Table) -> pa.Table:
        """Write a part of the contexts; return the counts of its continuation counts, and their sum."""
        part = t.column("part")[0].as_py()
        sums = np.zeros((min(size + 1 - (part << PART_BITS), 1 << PART_BITS), 5), np.int64)
        for rows, wide, blob in zip(t.column("size").to_pylist(), t.column("wide").to_pylist(), t.column("blob").combine_chunks()):
            steps, *five = _unpacked(blob.as_buffer(), rows, "u4", *["i8" if wide else "u4"] * 5)
            sums[np.cumsum(steps, dtype=np.int64)] += np.stack(five, axis=1).astype(np.int64)
        mapped.save(model.contexts, part, five=_narrow(sums.reshape(-1)))
        counts = np.bincount(np.minimum(sums[:, 4], 5), minlength=6)
        return pa.table({f"n{k}": [int(counts[k])] for k in range(1, 5)} | {"more": [int(counts[3:].sum())], "types": [int(sums[:, 4].sum())]})

    def contexts(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Write the pairs' counts and the contexts; the counts of counts of the words (then of three and more, and the sum) and of the pairs."""
        with passing(counted.groupBy("shard").applyInArrow(merge, "part int, size long, wide boolean, blob binary"), "merged") as merged:
            numbers = "n1 long, n2 long, n3 long, n4 long, more long, types long"
            low = merged.filter("part >= 0").groupBy("part").applyInArrow(add, numbers).agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n1", "n2", "n3", "n4", "more", "types"))).first()
            return low, total(merged.filter("part < 0"))

    def total(rows: DataFrame) -> np.ndarray:
        return sum((np.frombuffer(r[0], np.int64) for r in rows.select("blob").toLocalIterator()), np.zeros(4, np.int64))

    counted = texts.mapInArrow(lean(count_trigrams if order == 3 else count_pairs), blobs)
    if order == 3:
        with passing(counted.groupBy("shard").applyInArrow(merge_trigrams, blobs), "preceding") as preceding:
            model.d3 = discounts(total(preceding.filter("shard < 0")))
            low, high = contexts(preceding.filter("shard >= 0"))
    else:
        low, high = contexts(counted)
    model.d1, model.d2, model.types = discounts(low[:4]), discounts(high), low[5]
    if model.types:
        model.free = float(model.d1[1] * low[0] + model.d1[2] * low[1] + model.d1[3] * low[4]) / model.types
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without ``text``, with the columns that ``Model.score`` gives."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = {"n_tokens": "long", "n_known": "long", "base_score": "double", "score": "double"}
    docs = docs.drop(*added)
    kept = [c for c in docs.columns if c != "text"]

    def work(batches):
        for batch in batches:
            for at, part in words.slices(words.texts_of(batch)):
                found = shared.value.score(*tokens_of(part))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(at, len(part)) for c in kept), *(pa.array(found[c]) for c in added)], [*kept, *added])

    return docs.mapInArrow(lean(work), ", ".join(f"`{n}` {t}" for n, t in {**dict(docs.select(*kept).dtypes), **added}.items()))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    left = held_out(docs, 7, 2)
    model = fit(docs.filter(~left))
    return scored(docs.select("doc_id", left.alias("held_out"), "text"), model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
