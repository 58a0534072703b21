"""Record pairs: self-joins under constraints, with labels from value differences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import deadband_label, is_blank
from ..functions.hashing import sha_number
from .selection import positions


def _ends(records: DataFrame, suffix: str) -> DataFrame:
    return records.select(*(F.col(c).alias(f"{c}_{suffix}") for c in records.columns))


def same_key_pairs(records: DataFrame, key: list[str], near: float = 10.0, far: float = 30.0) -> DataFrame:
    """Unordered pairs of records (``id``, ``value``, key columns) that agree in every key column.

    Blank keys pair with nothing. The band on the difference is part of the join, so
    pairs within it are never materialised. Keys that hold many records are split by
    adaptive skew handling, since both sides are shuffled by the key alone.
    """
    whole = records
    for k in key:
        whole = whole.filter(~is_blank(F.col(k).cast("string")))
    a, b = _ends(whole, "a"), _ends(whole, "b")
    on = F.col("id_a") < F.col("id_b")
    for k in key:
        on &= F.col(f"{k}_a") == F.col(f"{k}_b")
    return _labelled(a.join(b, on & _outside(near, far)), near, far)


def _outside(near: float, far: float) -> Column:
    d = F.abs(F.col("value_a") - F.col("value_b"))
    return (d <= near) | (d >= far)


def _labelled(pairs: DataFrame, near: float, far: float) -> DataFrame:
    d = F.abs(F.col("value_a") - F.col("value_b"))
    return pairs.withColumns({"difference": d, "label": deadband_label(d, near, far)})


def all_pairs(records: DataFrame, blocks: int = 8, near: float = 10.0, far: float = 30.0, per_block: int = 20_000) -> DataFrame:
    """All unordered pairs of records (``id``, ``value`` and others), outside the band.

    A square of blocks instead of a nested loop over one broadcast side: each record goes
    to the ``blocks`` cells of its row or column, and cells are joined by equality. Work
    is spread over blocks * (blocks + 1) / 2 even tasks. Records are counted first: there
    are more blocks where one would hold over ``per_block`` of them.
    """
    blocks = max(blocks, -(-records.count() // per_block))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    cells = records.withColumn("own", block).withColumn("other", other)
    # the pair of blocks {i, j}: a comes from i, b from j, and where i = j from the same
    left = cells.withColumn("cell", F.col("own") * blocks + F.col("other")).drop("own", "other")
    right = cells.withColumn("cell", F.col("other") * blocks + F.col("own")).drop("own", "other")
    a, b = _ends(left, "a"), _ends(right, "b")
    on = (F.col("cell_a") == F.col("cell_b")) & (F.col("id_a") < F.col("id_b"))
    return _labelled(a.join(b, on & _outside(near, far)), near, far).drop("cell_a", "cell_b")


#: Of the rounds of ``permuted``: 2^31 - 1, so that products are longs, and what tells the rounds apart.
PRIME, MULTIPLIER = (1 << 31) - 1, 1103515245

#: Draws of a group that are made together.
DRAWS = 1 << 20


def permuted(number: Column, n: Column, seed: int, *tweak: Column, rounds: int = 6, walks: int = 24) -> Column:
    """The place of ``number`` in a keyed permutation of 0 to ``n`` - 1, one for each ``tweak``; null where the walk doesn't end.

    A Feistel network over a grid of a * b cells, a the root of ``n``, that has fewer than a
    cells beyond ``n``. A round adds the cube of a linear function modulo a prime, with a term from
    the key and the tweak. Who comes to one of these walks on, ``walks`` steps at most: in a
    permutation of a million, a chance of 1e-72 for more.
    """
    a = F.greatest(F.lit(1), F.ceil(F.sqrt(n.cast("double")))).cast("long")
    b = F.floor((n - 1) / a).cast("long") + 1
    grid = lambda left, right, a, b, t: F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"), a.alias("a"), b.alias("b"), t.alias("t"))

    def turn(x: Column, k: Column) -> Column:
        def mixed(c: Column) -> Column:
            y = (c % PRIME * ((k + 1) * MULTIPLIER % PRIME) + x["t"]) % PRIME
            return y * y % PRIME * y % PRIME

        even = grid(F.pmod(x["l"] + mixed(x["r"]), x["a"]), x["r"], x["a"], x["b"], x["t"])
        odd = grid(x["l"], F.pmod(x["r"] + mixed(x["l"]), x["b"]), x["a"], x["b"], x["t"])
        return F.when(k % 2 == 0, even).otherwise(odd)

    once = lambda x: F.aggregate(F.array(*(F.lit(k).cast("long") for k in range(rounds))), x, turn)
    value = lambda x: x["l"] * x["b"] + x["r"]
    start = grid(F.floor(number / b), F.pmod(number, b), a, b, sha_number(seed, *tweak) % PRIME)
    walk = lambda x, step: F.when((step > 0) & (value(x) < n), x).otherwise(once(x))
    return F.aggregate(F.sequence(F.lit(0), F.lit(walks)), start, walk, lambda x: F.when(value(x) < n, value(x)))


def _permuted(number: np.ndarray, n: int, term: int, rounds: int = 6, walks: int = 24) -> np.ndarray:
    """``permuted`` over an array, with the term from key and tweak; fails where a walk doesn't end."""
    a = max(1, int(np.ceil(np.sqrt(float(n)))))
    b = (n - 1) // a + 1

    def once(left, right):
        def mixed(c, k):
            y = (c % PRIME * ((k + 1) * MULTIPLIER % PRIME) + term) % PRIME
            return y * y % PRIME * y % PRIME

        for k in range(rounds):
            left, right = ((left + mixed(right, k)) % a, right) if k % 2 == 0 else (left, (right + mixed(left, k)) % b)
        return left, right

    left, right = once(number // b, number % b)
    for _ in range(walks):
        out = np.flatnonzero(left * b + right >= n)
        if not len(out):
            break
        left[out], right[out] = once(left[out], right[out])
    value = left * b + right
    if (value >= n).any():
        raise ValueError("a walk of the permutation didn't end")
    return value


def _triangle(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of numbers of the triangle: the row from the root, put right by one where the double is off."""
    j = np.floor((1 + np.sqrt(8.0 * x + 1)) / 2).astype(np.int64)
    j = np.where(j * (j - 1) // 2 > x, j - 1, np.where((j + 1) * j // 2 <= x, j + 1, j))
    return x - j * (j - 1) // 2, j


def sampled_pairs(records: DataFrame, group: list[str], key: str, fraction: float, seed: int = 0) -> DataFrame:
    """A deterministic sample of each group's unordered pairs without replacement: ``id_a``, ``id_b``, in any order.

    A group of n records (in the order of ``key``, hex digits) has n(n-1)/2 pairs, numbered by
    the triangle they fill. ``ceil(fraction * pairs)`` numbers are drawn: the first places
    of a keyed permutation of them all, so no pair is made that isn't drawn, and
    none twice. A group's draws are dealt to tasks by ranges of ``DRAWS``, and its ids go to each range, so
    that draws aren't shuffled; a task holds one group's ids and one range. Null is a group like others.
    """
    placed = positions(records.select("id", *group, key), group, key, "id").withColumnRenamed("n_group", "n").drop(key)
    n, tasks = F.col("n"), 4 * int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = F.when(n % 2 == 0, F.floor(n / 2) * (n - 1)).otherwise(n * F.floor((n - 1) / 2))
    drawn = F.least(total, F.ceil(F.lit(fraction) * total).cast("long"))
    term = sha_number(seed, *(F.coalesce(F.col(g).cast("string"), F.lit("")) for g in group)) % PRIME
    told = placed.withColumns({"total": total, "drawn": drawn, "term": term}).filter("drawn > 0").drop("n")
    dealt = told.withColumn("begin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("drawn") - 1, F.lit(DRAWS).cast("long"))))

    def draw(held: pa.Table) -> pa.Table:
        first = {c: held[c][0] for c in [*group, "total", "drawn", "term", "begin"]}
        begin, end = first["begin"].as_py(), min(first["begin"].as_py() + DRAWS, first["drawn"].as_py())
        i, j = _triangle(_permuted(np.arange(begin, end), first["total"].as_py(), first["term"].as_py()))
        ids = held["id"].combine_chunks().take(pa.array(np.argsort(held["position"].to_numpy())))
        return pa.table({**{g: pa.repeat(first[g], end - begin) for g in group}, "id_a": ids.take(pa.array(i)), "id_b": ids.take(pa.array(j))})

    kind = {f.name: f.dataType for f in dealt.schema.fields}
    schema = T.StructType([T.StructField(g, kind[g]) for g in group] + [T.StructField(c, kind["id"]) for c in ("id_a", "id_b")])
    return dealt.repartition(tasks, *group, "begin").groupBy(*group, "begin").applyInArrow(draw, schema)


def sample_properties(drawn: DataFrame, records: DataFrame, group: str, fraction: float) -> DataFrame:
    """Of each group's drawn pairs: how many, how many differ, how many ends are of another group, and whether they are spread.

    A record is missed by chance with about (1 - fraction)^(n - 1); a spread draw meets
    all but that share of the n records, within six standard deviations. ``many``: n is over 20.
    """
    own = records.select(F.col("id").alias("end"), F.col(group).alias("__own"))
    ends = drawn.select(F.col(group).alias("__g"), F.explode(F.array("id_a", "id_b")).alias("end")).join(own, "end")
    met = ends.groupBy("__g").agg(F.count_distinct("end").alias("met"), F.count_if(~F.col("__own").eqNullSafe(F.col("__g"))).alias("foreign_ends"))
    pairs = drawn.groupBy(F.col(group).alias("__h")).agg(F.count("*").alias("drawn"), F.count_distinct(F.least("id_a", "id_b"), F.greatest("id_a", "id_b")).alias("pairs"))
    sizes = records.groupBy(group).agg(F.count("*").alias("n"))
    out = sizes.join(pairs, F.col(group).eqNullSafe(F.col("__h"))).join(met, F.col(group).eqNullSafe(F.col("__g")))
    missed = F.pow(F.lit(1 - fraction), F.col("n") - 1)
    spread = F.abs(F.col("met") - F.col("n") * (1 - missed)) <= 6 * F.sqrt(F.col("n") * missed * (1 - missed)) + 2
    return out.select(group, "drawn", "pairs", F.col("foreign_ends").cast("int").alias("foreign_ends"), (F.col("n") > 20).alias("many"), spread.alias("spread"))


def group_sizes(records: DataFrame, key: str) -> DataFrame:
    """Of every key that holds two records or more: how many, and how many pairs they make."""
    n = F.count("*")
    return records.filter(~is_blank(F.col(key).cast("string"))).groupBy(key).agg(n.alias("n"), (n * (n - 1) / 2).cast("long").alias("pairs")).filter("n >= 2")


def both_directions(pairs: DataFrame) -> DataFrame:
    """Every pair twice, once from each end: ``direction``, ``source`` and ``target``."""
    out = pairs.withColumn("__forth", F.explode(F.array(F.lit(True), F.lit(False))))
    by = lambda there, back: F.when(F.col("__forth"), there).otherwise(back)
    ends = {"source": by(F.col("id_a"), F.col("id_b")), "target": by(F.col("id_b"), F.col("id_a"))}
    # a flag tells the two apart: texts would be compared twice in every row
    return out.withColumns({"direction": by(F.lit("a_to_b"), F.lit("b_to_a")), **ends}).drop("__forth")


def materialised(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs (``id_a``, ``id_b``, others) with each end's record as a struct."""
    ends = lambda s: records.select(F.col("id").alias(f"id_{s}"), F.struct(*records.columns).alias(f"record_{s}"))
    return pairs.join(ends("a"), "id_a").join(ends("b"), "id_b")


def with_found(ends: DataFrame, records: DataFrame, text: str) -> DataFrame:
    """Records that are to be paired (``id``, others), each with the record under its id (``found``, null without one) and what is wrong with it (``fault``).

    A record is looked up once, however many pairs it is in; see ``strict``. A record that is there twice is so in the pairs.
    """
    own = records.select(F.col("id").alias("__id"), F.struct(*records.columns).alias("found")).hint("merge")
    out = ends.join(own, F.col("id") == F.col("__id"), "left").drop("__id")
    fault = F.when(F.col("found").isNull(), "no record ").when(~F.col(text).eqNullSafe(F.col("found")[text]), "another record under ")
    return out.withColumn("fault", F.concat(fault, F.coalesce(F.col("id").cast("string"), F.lit("null"))))


def strict(pairs: DataFrame) -> DataFrame:
    """Pairs of ``with_found`` records; a task fails at a pair whose end isn't there, or isn't the record that its text says."""
    for s in ("a", "b"):
        failed = F.raise_error(F.col(f"fault_{s}"))
        pairs = pairs.withColumn(f"found_{s}", F.when(F.col(f"fault_{s}").isNotNull(), failed).otherwise(F.col(f"found_{s}")))
    return pairs.drop("fault_a", "fault_b")


def strictly_materialised(pairs: DataFrame, records: DataFrame, text: str) -> DataFrame:
    """``materialised``, but a task fails at a pair whose end isn't there, or isn't the record that ``{text}_a`` and ``{text}_b`` say."""
    ends = lambda s: records.select(F.col("id").alias(f"id_{s}"), F.struct(*records.columns).alias(f"record_{s}"))
    out = pairs.join(ends("a"), "id_a", "left").join(ends("b"), "id_b", "left")
    for s in ("a", "b"):
        record, said = F.col(f"record_{s}"), F.col(f"{text}_{s}")
        fault = F.when(record.isNull(), "no record ").when(~said.eqNullSafe(record[text]), "another record under ")
        failed = F.raise_error(F.concat(fault, F.coalesce(F.col(f"id_{s}").cast("string"), F.lit("null"))))
        out = out.withColumn(f"record_{s}", F.when(fault.isNotNull(), failed).otherwise(record))
    return out
