"""Importance resampling: documents drawn by how much likelier a target makes them.

Words and word pairs of every text are hashed to ``BUCKETS`` buckets. Two generative
models, of the target's texts and of all texts, give each bucket a log-probability; a
document's log-weight is the sum of their differences over its n-grams. The sample is
the top k by log-weight plus Gumbel noise, which draws without replacement in proportion
to the weights; the noise is a hash of the seed and the doc_id, so a run repeats itself.

The target is given by ids; they are written as a sorted array that workers map, and
texts are never shuffled. The k-th score is found by counting scores by 16 of their bits
at a time: four small tables reach the driver, whatever k is.

Defined cases: null and empty texts have log-weight 0. Repeated rows are drawn together.
Rows tied with the k-th score all stay. Without a target row, or without rows, all
log-weights are 0. A null doc_id is never in the target; its noise is that of id 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mapped, words
from .shared import lean, table, written

BUCKETS, SMOOTHING, SEED = 1 << 16, 1.0, 17


def grams(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, and the number of the text of each."""
    held, owner = words.words_of(texts)
    pair = words.mix(held[:-1] * np.uint64(3) + words.mix(held[1:]))[owner[:-1] == owner[1:]] if len(held) else held
    both = np.concatenate([words.salted(held, 3), pair])
    return (both & np.uint64(buckets - 1)).astype(np.int64), np.concatenate([owner, owner[:-1][owner[:-1] == owner[1:]]])


def log_ratios(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """For each bucket the log-probability under the target less that under all documents."""
    ids = written(target.select(F.col("doc_id").cast("long").alias("key")).filter("key is not null").distinct(), "target")
    wanted = mapped.build(ids, ids.count(), "target-ids", {})

    def count(batches):
        total = np.zeros((2, buckets), np.int64)
        for batch in batches:
            own = batch.column("doc_id").cast(pa.int64())
            inside = wanted.has(own.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)) & own.is_valid().to_numpy(zero_copy_only=False)
            for at, part in words.slices(words.texts_of(batch)):
                bucket, owner = grams(part, buckets)
                total[0] += np.bincount(bucket, minlength=buckets)
                total[1] += np.bincount(bucket[inside[at + owner]], minlength=buckets)
        full = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_pydict({"bucket": full, "raw": total[0][full], "target": total[1][full]})

    found = docs.select("doc_id", "text").mapInArrow(lean(count), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    counts = np.zeros((2, buckets))
    for k, name in enumerate(("raw", "target")):
        counts[k][found.column("bucket").to_numpy()] = found.column(name).to_numpy()
    if not counts[1].any():
        return np.zeros(buckets)
    logs = np.log((counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * buckets))
    return logs[1] - logs[0]


def weighed(docs: DataFrame, ratios: np.ndarray, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``log_weight`` and ``score``, the log-weight with Gumbel noise."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def work(batches):
        for batch in batches:
            own = batch.column("doc_id").cast(pa.int64())
            draw = (words.salted(own.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64), seed) >> np.uint64(11)).astype(np.float64)
            noise = -np.log(-np.log((draw + 0.5) * 2.0**-53))
            weights = np.zeros(len(own))
            for at, part in words.slices(words.texts_of(batch)):
                bucket, owner = grams(part, len(shared.value))
                weights[at : at + len(part)] = np.bincount(owner, shared.value[bucket], len(part))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(weights), pa.array(weights + noise)], ["doc_id", "log_weight", "score"])

    return docs.select("doc_id", "text").mapInArrow(lean(work), "doc_id long, log_weight double, score double")


def top(rows: DataFrame, k: int, by: str) -> DataFrame:
    """The rows whose ``by`` is among the k largest, with those tied with the last."""
    if k <= 0:
        return rows.limit(0)
    bits, sign = F.col("__bits"), -(2**63)
    ordered = written(_ordered(rows, by), "ordered")
    least, left = 0, k
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned(bits, shift).bitwiseAND(0xFFFF)
        same = F.lit(True) if shift == 48 else F.shiftrightunsigned(bits, shift + 16) == least
        for r in sorted(ordered.filter(same).groupBy(digit.alias("d")).count().collect(), key=lambda r: -r.d):
            if r["count"] >= left:
                least = least << 16 | r.d
                break
            left -= r["count"]
        else:
            return rows
    return ordered.filter(bits.bitwiseXOR(sign) >= least - 2**63).drop("__bits")


def _ordered(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` with ``__bits``, 64 bits that grow (as an unsigned number) with the double ``by``."""

    def add(batches):
        for batch in batches:
            held = (batch.column(by).to_numpy(zero_copy_only=False) + 0.0).view(np.int64)
            bits = np.where(held < 0, ~held, held ^ np.int64(-(2**63)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits)], [*batch.schema.names, "__bits"])

    return rows.mapInArrow(lean(add), ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", __bits long")


def resample(docs: DataFrame, target: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """The sample of ``fraction`` of ``docs``: ``doc_id``, ``log_weight`` and ``score``."""
    rows = written(weighed(docs, log_ratios(docs, target), seed), "weighed")
    return top(rows, round(fraction * rows.count()), "score")


def op6_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample like the clean labelled documents, as large a share of all as they are of the labelled ones."""
    labels = table(spark, sf_dir, "labels")
    clean = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    share = labels.agg(F.avg(clean.cast("int"))).first()[0]
    return resample(table(spark, sf_dir, "documents"), labels.filter(clean), share or 0.0)
