"""Sorted hash arrays in the shared folder, memory-mapped by Python workers.

A table too large to broadcast is cut into shards by the upper bits of Spark's
``xxhash64`` of its 64-bit key. Each shard is written by one task as plain arrays: the sorted keys and,
beside them, value arrays (for list columns the values and their bounds). Workers map the
files; the operating system shares the pages among the workers of a machine. Where the
shared folder isn't a file system path, workers read a shard into memory and hold a few.

Files are written under a name of their own and then renamed, so that a task that is
run again, or twice, leaves one whole file. A shard whose file is lost or cut short is an
error where it is first read, never an empty shard.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_path, short_plans

#: Rows of a shard at most; smaller tables are cut into up to ``SPREAD`` shards of ``LEAST_ROWS`` or more, so that no single task writes one.
SHARD_ROWS, LEAST_ROWS, SPREAD = 4_000_000, 1 << 16, 16
#: Tables that a worker keeps open, and shards of each that it holds where it can't map them.
OPEN_TABLES, HELD_SHARDS = 8, 8


def shard_bits(rows: int, shard_rows: int = SHARD_ROWS) -> int:
    """Bits of the shard number so that a shard holds about ``shard_rows`` rows or fewer."""
    parts = max(rows / shard_rows, min(SPREAD, rows / LEAST_ROWS), 1)
    return int(np.ceil(np.log2(parts)))


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (xxhash64(keys) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def xxhash64(keys: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of each key as a long: the XXH64 of its 8 bytes under the seed 42."""
    # The five primes of XXH64.
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turned = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    h = (np.uint64(42 + 8) + p5) ^ (turned(keys.astype(np.uint64) * p2, 31) * p1)
    h = turned(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def save(path: str, shard: int, **arrays: np.ndarray) -> None:
    """Write a shard's arrays, each in a file of its own."""
    store, base = fs.FileSystem.from_uri(path)
    store.create_dir(base, recursive=True)
    for name, values in arrays.items():
        temporary = f"{base}/.{uuid.uuid4().hex}"
        with store.open_output_stream(temporary) as out:
            out.write(np.ascontiguousarray(values).view(np.uint8).data)
        store.move(temporary, f"{base}/{shard:06d}.{name}.{values.dtype.str[1:]}")


def _array(path: str, shard: int, name: str, dtype: str) -> np.ndarray:
    store, base = fs.FileSystem.from_uri(path)
    file = f"{base}/{shard:06d}.{name}.{np.dtype(dtype).str[1:]}"
    info = store.get_file_info(file)
    if info.type == fs.FileType.NotFound or not info.size:
        return np.zeros(0, dtype)
    if not isinstance(store, fs.LocalFileSystem):
        with store.open_input_stream(file) as held:
            return np.frombuffer(held.read(), dtype)
    return np.asarray(np.memmap(file, dtype, "r"))  # a plain array, as each result of a memmap's looks for its file


class Mapped:
    """What workers need to map a table: picklable, opened at first use in each worker."""

    def __init__(self, path: str, bits: int, values: dict[str, str]):
        self.path, self.bits, self.values = path, bits, values
        #: Keys of each shard, and of those before it: a key's place among all is ``base[shard] + place``.
        self.sizes = self.base = np.zeros(1 << bits, np.int64)
        self.known = False

    def sized(self, rows) -> Mapped:
        """With the sizes of the shards, from rows (shard, n)."""
        self.sizes = np.zeros(1 << self.bits, np.int64)
        for r in rows:
            self.sizes[r.shard] = r.n
        self.base, self.known = np.cumsum(self.sizes) - self.sizes, True
        return self

    def shard(self, number: int) -> dict[str, np.ndarray]:
        held = _OPEN[self.path] = _OPEN.pop(self.path, {})
        if number not in held:
            while len(_OPEN) > OPEN_TABLES:
                del _OPEN[next(iter(_OPEN))]
            while len(held) >= HELD_SHARDS and not isinstance(next(iter(held.values()))["keys"].base, np.memmap):
                del held[next(iter(held))]
            found = {k: _array(self.path, number, k, t) for k, t in {"keys": "u8", **self.values}.items()}
            if self.known and len(found["keys"]) != self.sizes[number]:
                raise OSError(f"{self.path}: shard {number} has {len(found['keys'])} of {self.sizes[number]} keys")
            held[number] = found
        return held[number]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard and place of each key (place -1: not there). Keys may come in any order."""
        distinct, back = np.unique(keys, return_inverse=True)
        shards, places = shard_of(distinct, self.bits), np.full(len(distinct), -1, np.int64)
        for s in np.unique(shards):
            at, held = np.flatnonzero(shards == s), self.shard(int(s))["keys"]
            if len(held):
                found = np.minimum(np.searchsorted(held, distinct[at]), len(held) - 1)
                places[at] = np.where(held[found] == distinct[at], found, -1)
        return shards[back], places[back]

    def get(self, keys: np.ndarray, name: str, default=0) -> np.ndarray:
        """The value of each key in the array ``name``."""
        distinct, back = np.unique(keys, return_inverse=True)
        shards, places = self.find(distinct)
        out = np.full(len(distinct), default, self.values[name])
        for s in np.unique(shards[places >= 0]):
            at = np.flatnonzero((shards == s) & (places >= 0))
            out[at] = self.shard(int(s))[name][places[at]]
        return out[back]

    def lists(self, keys: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray]:
        """The ragged values of each key one after the other, and their lengths (0: no such key)."""
        shards, places = self.find(keys)
        sizes = np.zeros(len(keys), np.int64)
        for s in np.unique(shards[places >= 0]):
            at, held = np.flatnonzero((shards == s) & (places >= 0)), self.shard(int(s))[f"{name}_at"]
            sizes[at] = held[places[at] + 1] - held[places[at]]
        begin = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), self.values[name])
        for s in np.unique(shards[places >= 0]):
            at, held = np.flatnonzero((shards == s) & (places >= 0)), self.shard(int(s))
            inside = np.arange(int(sizes[at].sum())) - np.repeat(np.cumsum(sizes[at]) - sizes[at], sizes[at])
            out[np.repeat(begin[at], sizes[at]) + inside] = held[name][np.repeat(held[f"{name}_at"][places[at]].astype(np.int64), sizes[at]) + inside]
        return out, sizes

    def has(self, keys: np.ndarray) -> np.ndarray:
        return self.find(keys)[1] >= 0


_OPEN: dict[str, dict[int, dict[str, np.ndarray]]] = {}


def build(df: DataFrame, rows: int, name: str, values: dict[str, str], shard_rows: int = SHARD_ROWS) -> Mapped:
    """Write ``df`` (``key`` long, without repeats, and value columns) as a mapped table.

    ``rows`` is its size, or a bound on it; ``values`` names the numpy type of each value column.
    """
    spark, bits = df.sparkSession, shard_bits(rows, shard_rows)
    out = Mapped(shared_path(spark, name), bits, dict(values))

    def write(t: pa.Table) -> pa.Table:
        keys = t.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys, kind="stable")
        s = t.column("shard")[0].as_py()
        arrays = {}
        for k in values:
            column = t.column(k).combine_chunks()
            if pa.types.is_list(column.type):
                column = column.take(pa.array(order))
                arrays |= {k: column.values.to_numpy(zero_copy_only=False).astype(out.values[k]), f"{k}_at": column.offsets.to_numpy().astype(np.int64)}
            else:
                arrays[k] = column.to_numpy(zero_copy_only=False)[order].astype(out.values[k])
        save(out.path, s, keys=keys[order], **arrays)
        return pa.table({"shard": pa.array([s], pa.int64()), "n": pa.array([len(keys)], pa.int64())})

    held = df.select(F.col("key").cast("long"), *values)
    out.values |= {f"{n}_at": "i8" for n, t in held.dtypes if t.startswith("array")}
    shard = F.shiftrightunsigned(F.xxhash64("key"), 64 - bits) if bits else F.lit(0).cast("long")
    with short_plans(spark):
        done = held.withColumn("shard", shard).groupBy("shard").applyInArrow(write, "shard long, n long").collect()
    return out.sized(done)
