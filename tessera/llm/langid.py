"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting and scoring both run as Arrow batches in tasks. What reaches the driver and is
broadcast again is a matrix of ``buckets`` x languages log-probabilities: its size
depends on these two numbers, never on the documents.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every
text if no labelled row was learnt from. Documents of null lang aren't learnt from. Ties
go to the language first in the alphabet. Repeated rows are predicted (and, where they
are labelled, learnt from) as often as they occur. Other columns pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import free_names, lean, table, written
from .words import SLICE_BYTES, mix, slices, sums, texts_of

BUCKETS, ORDERS, UNKNOWN = 1 << 16, (1, 2, 3), "und"
#: Languages whose log-probabilities are broadcast at a time: 1,000 x 65,536 floats are 262 MB. More of them take a pass over the texts each.
AT_ONCE = 1_000
#: Log-probabilities gathered at a time (32 MB), whatever the number of languages.
GATHERED = 1 << 22
_LETTER = re.compile(r"[^\W\d_]")


def gram_buckets(texts: list[str], buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS):
    """Buckets of the n-grams of each text: for each order, the buckets and the bounds of each text's."""
    joined = "\0".join(x.replace("\0", " ").lower() for x in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.append(np.flatnonzero(points == 0), len(points))
    for order in orders:
        n = max(0, len(points) - order + 1)
        code, whole = np.full(n, order, np.uint64), np.ones(n, bool)
        for k in range(order):
            part = points[k : k + n]
            code = code * np.uint64(0x9E3779B97F4A7C15) + part
            whole &= part != 0
        kept = np.flatnonzero(whole)
        bounds = np.concatenate([[0], np.searchsorted(kept, ends)])
        yield (mix(code[kept]) & np.uint64(buckets - 1)).astype(np.int64), bounds


class Model:
    """Blocks of languages in order, each with log-probabilities of buckets (rows) in languages (columns), and of the languages."""

    def __init__(self, blocks: list[Block]):
        self.blocks = blocks

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and its posterior probability for each text; of equal ones the first language."""
        names, best, total = _nothing(len(texts))
        for block in self.blocks:
            names, best, total = block.better(texts, names, best, total)
        return _decided(texts, names, total)


class Block:
    def __init__(self, languages: list[str], matrix: np.ndarray, prior: np.ndarray, buckets: int, orders: tuple[int, ...]):
        self.languages, self.matrix, self.prior, self.buckets, self.orders = languages, matrix, prior, buckets, orders

    def better(self, texts: list[str], names: list[str], best: np.ndarray, total: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The best language of each text and its log-probability after this block's, and the sum of all so far over the best."""
        own = np.tile(self.prior, (len(texts), 1))
        for held, bounds in gram_buckets(texts, self.buckets, self.orders):
            step = max(1, GATHERED // max(1, len(held)))
            for k in range(0, len(self.languages), step):
                own[:, k : k + step] += sums(self.matrix[:, k : k + step][held].astype(np.float64), bounds)
        first, most = own.argmax(axis=1), own.max(axis=1)
        above = np.maximum(best, most)
        total = total * np.exp(best - above) + np.exp(own - above[:, None]).sum(axis=1)
        return [self.languages[f] if m > b else n for f, m, b, n in zip(first, most, best, names)], above, total


def _nothing(n: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    return [UNKNOWN] * n, np.full(n, -np.inf), np.zeros(n)


def _decided(texts: list[str], names: list[str], total: np.ndarray) -> tuple[list[str], np.ndarray]:
    """``und`` and no probability for texts without a letter, or without a language to choose."""
    known = np.array([bool(_LETTER.search(x)) for x in texts], bool) & (total > 0)
    return [n if k else UNKNOWN for n, k in zip(names, known)], np.where(known, 1 / np.where(total > 0, total, 1), 0.0)


def fit(labelled: DataFrame, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS, smoothing: float = 0.5) -> Model:
    """Learn from the columns ``text`` and ``lang`` of all rows."""
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")

    def count(batches):
        held: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for at, part in slices(texts_of(batch), SLICE_BYTES // 2):
                own = langs[at : at + len(part)]
                texts = np.array(part.to_pylist(), object)
                for lang in sorted(set(own)):
                    mine = texts[own == lang].tolist()
                    total = held.setdefault(lang, np.zeros(buckets, np.int64))
                    docs[lang] = docs.get(lang, 0) + len(mine)
                    for found, _ in gram_buckets(mine, buckets, orders):
                        total += np.bincount(found, minlength=buckets)
        for lang, total in held.items():
            full = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * (len(full) + 1), "bucket": np.append(full, -1), "n": np.append(total[full], docs[lang])})

    counted = labelled.select("text", "lang").filter("text is not null and lang is not null").mapInArrow(lean(count), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counted = written(counted, "grams")
    docs = {r.lang: r.n for r in counted.filter("bucket = -1").collect()}
    languages, whole, blocks = sorted(docs), max(1, sum(docs.values())), []
    for k in range(0, len(languages), AT_ONCE):
        own = languages[k : k + AT_ONCE]
        found = counted.filter((F.col("lang") >= own[0]) & (F.col("lang") <= own[-1]) & (F.col("bucket") >= 0)).toArrow()
        column = {x: i for i, x in enumerate(own)}
        counts = np.zeros((buckets, len(own)))
        counts[found.column("bucket").to_numpy(), np.array([column[x] for x in found.column("lang").to_pylist()], np.int64)] = found.column("n").to_numpy()
        matrix = np.log((counts + smoothing) / (counts.sum(axis=0) + smoothing * buckets)).astype(np.float32)
        blocks.append(Block(own, matrix, np.log(np.array([docs[x] for x in own]) / whole), buckets, orders))
    return Model(blocks)


def identify(docs: DataFrame, model: Model, lang_column: str = "lang_pred", score_column: str = "score") -> DataFrame:
    """``docs`` with the predicted language of ``text`` and its probability."""
    out = docs.drop(lang_column, score_column)
    names = free_names(out, "best_name", "best_log", "best_total")
    kept, kinds = out.columns, out.dtypes
    fields = lambda pairs: ", ".join(f"`{n}` {t}" for n, t in pairs)
    blocks: list[Block | None] = list(model.blocks) or [None]
    for k, block in enumerate(blocks):
        shared, first, last = docs.sparkSession.sparkContext.broadcast(block), k == 0, k == len(blocks) - 1

        def score(batches, shared=shared, first=first, last=last):
            for batch in batches:
                parts = []
                for at, part in slices(texts_of(batch), SLICE_BYTES // 2):
                    texts = part.to_pylist()
                    state = _nothing(len(texts)) if first else [batch.column(c).slice(at, len(part)) for c in names]
                    if not first:
                        state = state[0].to_pylist(), state[1].to_numpy(), state[2].to_numpy()
                    if shared.value:
                        state = shared.value.better(texts, *state)
                    parts.append(_decided(texts, state[0], state[2]) if last else state)
                columns = list(zip(*parts)) if parts else [[]] * (2 if last else 3)
                said = [pa.array([x for p in columns[0] for x in p], pa.string()), *(pa.array(np.concatenate([np.asarray(x) for x in c]) if c else np.zeros(0)) for c in columns[1:])]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *said], [*kept, *([lang_column, score_column] if last else names)])

        added = [(lang_column, "string"), (score_column, "double")] if last else list(zip(names, ("string", "double", "double")))
        out = out.mapInArrow(lean(score), fields([*kinds, *added]))
        out = out if last else written(out, "languages")
    return out


def held_out(docs: DataFrame, parts: int = 4, left: int = 2):
    """Whether a document is kept from training: by the CRC-32 of its id's text."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string")) % parts == left, F.lit(False))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out(docs)))
    return identify(docs.select("doc_id", held_out(docs).alias("held_out"), "text"), model).drop("text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.5) -> DataFrame:
    """Documents whose language is recognised with a probability of ``least`` or more."""
    model = fit(docs.filter(~held_out(docs)))
    lang, score = free_names(docs, "predicted", "score")
    return identify(docs, model, lang, score).filter((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)
