"""Nearest neighbours by exhaustive similarity, and votes of their labels."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scores


def tanimoto(a: Column, b: Column) -> Column:
    """Common bits over all bits of two fingerprints (arrays of long)."""
    both = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda s, x: s + x)
    either = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseOR(y))), F.lit(0), lambda s, x: s + x)
    return F.coalesce(F.try_divide(both.cast("double"), either), F.lit(0.0))


def sign_bits(vector: Column) -> Column:
    """A fingerprint of the signs of the numbers: an array with a long for every 64 of them."""
    bit = lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    word = lambda k: F.aggregate(F.transform(F.slice(vector, k * 64 + 1, 64), bit), F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(x))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(vector) - 1) / 64).cast("int")), word)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def weighted_tanimoto(a: Column, b: Column, other_a: Column, other_b: Column, weights: tuple[float, float] = (0.8, 0.2)) -> Column:
    """The weighted mean of the similarities of two pairs of fingerprints; -1 where one is missing."""
    whole = a.isNotNull() & b.isNotNull() & other_a.isNotNull() & other_b.isNotNull()
    return F.when(whole, weights[0] * tanimoto(a, b) + weights[1] * tanimoto(other_a, other_b)).otherwise(-1.0)


def candidate_count(n_sources: Column, top_n: int | None = None, fraction: float = 0.01) -> Column:
    """How many candidates a query keeps: ``top_n`` if given, else a share of the sources, one at least; never more than there are."""
    wanted = F.lit(top_n) if top_n and top_n > 0 else F.greatest(F.lit(1), F.ceil(n_sources * F.lit(fraction)))
    return F.least(wanted, n_sources).cast("long")


def reranked(near: DataFrame, score, k: int) -> DataFrame:
    """Of each query's candidates the ``k`` best by another ``score``; ties by ``s_id``."""
    order = Window.partitionBy("q_id").orderBy(F.col("score").desc(), F.col("s_id"))
    return near.withColumn("score", score).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def frozen(votes: DataFrame, split: str, param: str, tuned_on: str, label: str, predicted: str) -> DataFrame:
    """The parameter with the most right votes on ``tuned_on`` (the least of equals), and its counts on every split."""
    counts = votes.groupBy(split, param).agg(F.count("*").alias("n"), F.count_if(F.col(label) == F.col(predicted)).alias("correct"))
    best = counts.filter(F.col(split) == tuned_on).agg(F.max_by(param, F.struct("correct", -F.col(param))).alias(param))
    return counts.join(F.broadcast(best), param)


def vote_slices(votes: DataFrame, label: str, predicted: str, columns: list[str], flags: dict[str, Column]) -> DataFrame:
    """Votes counted over all (``overall``), by each value of ``columns`` and by each flag: ``slice``, ``slice_value`` and confusion counts.

    Every vote goes to each of its slices in one pass, so the table is read once.
    """
    cell = lambda name, value: F.struct(F.lit(name).alias("slice"), value.alias("slice_value"))
    cells = [cell("overall", F.lit("all")), *(cell(c, F.col(c).cast("string")) for c in columns)]
    cells += [cell(f"{k}_missing", F.when(v, "true").otherwise("false")) for k, v in flags.items()]
    rows = votes.select(label, predicted, F.inline(F.array(*cells))).filter("slice_value is not null")
    from ..functions.metrics import confusion

    return confusion(rows, label, predicted, ["slice", "slice_value"])


def candidates(queries: DataFrame, sources: DataFrame, score, k: int, least: int = 16, per_block: int = 50_000, asked_at_once: int = 5_000) -> DataFrame:
    """The ``k`` best sources of each query: ``q_id``, ``s_id`` and ``score``; ties by ``s_id``.

    Queries (a stated set) are held against all sources in blocks: both sides are counted
    and cut, sources into ``least`` blocks or more of about ``per_block`` rows, queries into
    groups of about ``asked_at_once``. Each block meets each group under a key of its own,
    so a task's work doesn't grow with the tables. Blocks keep their own k best before the
    k best of all are taken.
    """
    parts = max(least, -(-sources.count() // per_block))
    groups = max(1, -(-queries.count() // asked_at_once))
    number = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = sources.withColumn("block", number("s_id", parts)).withColumn("asked", every(groups))
    asked = queries.withColumn("asked", number("q_id", groups)).withColumn("block", every(parts))
    met = asked.join(held, ["block", "asked"]).drop("asked").withColumn("score", score)
    order = [F.col("score").desc(), F.col("s_id")]
    near = met.withColumn("r", F.row_number().over(Window.partitionBy("q_id", "block").orderBy(*order))).filter(F.col("r") <= k)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("q_id").orderBy(*order))).filter(F.col("rank") <= k).drop("r", "block")


def block_candidates(queries: DataFrame, sources: DataFrame, score: Column, measure, k: int, apart: tuple[int | None, float] | None = None, margin: float = 0.0, per_block: int = 50_000, asked_at_once: int = 20_000) -> DataFrame:
    """As ``candidates``: the same square of blocks, but a block's scores are a product of matrices, and only its best leave the task.

    A query leaves every block of sources with its k best, so there are no more of these than ``per_block`` asks for;
    what else it takes for all tasks to have work comes from smaller groups of queries. Columns that neither
    score nor caller need are better joined later than carried along.

    ``measure`` (see ``scores``) says what ``score`` does, to within ``margin``; all that come so near to
    a block's k-th are kept, and ``score`` itself decides between them. ``apart`` is a modulus
    and the score of sources that leave the same remainder as the query's id; without a
    modulus, of the query itself.
    """
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_queries, n_sources = queries.count(), sources.count()
    parts = max(1, -(-n_sources // per_block))
    groups = max(1, -(-n_queries // asked_at_once), min(-(-4 * tasks // parts), -(-n_queries // scores.ROWS)))
    # few queries leave tasks idle that more blocks of sources can use
    parts = max(parts, min(-(-4 * tasks // groups), -(-n_sources // scores.COLUMNS)))
    number = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = sources.withColumns({"block": number("s_id", parts), "asked": every(groups)})
    asked = queries.withColumns({"asked": number("q_id", groups), "block": every(parts)})
    near = best_of_blocks(asked, held, ["block", "asked"], measure, k, apart, margin, parts * groups)
    return _best(near.withColumn("score", score), k)


def best_of_blocks(asked: DataFrame, held: DataFrame, cell: list[str], measure, k: int, apart, margin: float, tasks: int) -> DataFrame:
    """Each query beside the k best sources of every ``cell`` (columns of both) that it is in, and those within ``margin`` of the k-th."""
    fields = [f for f in [*asked.schema.fields, *held.schema.fields] if f.name not in cell]

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.drop_columns(cell), right.drop_columns(cell).sort_by("s_id")
        q, s = scores.best(left, right, measure, k, apart, margin)
        rows = [left.take(q).columns, right.take(s).columns]
        return pa.Table.from_arrays([c for side in rows for c in side], names=[*left.column_names, *right.column_names])

    # cells are few and even, and their work isn't in proportion to their bytes
    dealt = lambda df: df.repartition(tasks, *cell).groupBy(*cell)
    return dealt(asked).cogroup(dealt(held)).applyInArrow(best, T.StructType(fields))


def popcount(fp: Column) -> Column:
    return F.aggregate(F.transform(fp, lambda x: F.bit_count(x)), F.lit(0), lambda s, x: s + x)


def _blocks(sources: DataFrame, asked: DataFrame, sizes: dict[int, int], groups: int, per_block: int, k: int) -> DataFrame:
    """Every query beside the k best sources of each popcount in its ``visits``, block by block and group by group."""
    many = {c: -(-n // per_block) for c, n in sizes.items() if n > per_block}
    blocks = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in many.items() for x in pair)), F.col("s_count")), F.lit(1)) if many else F.lit(1)
    own = F.pmod(F.xxhash64("s_id"), blocks).cast("int")
    held = sources.withColumns({"block": own, "group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
    wide = asked.withColumn("s_count", F.explode("visits")).drop("visits")
    wide = wide.withColumns({"block": F.explode(F.sequence(F.lit(0), blocks - 1)), "group": F.pmod(F.xxhash64("q_id"), F.lit(groups)).cast("int")})
    tasks = 4 * int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = best_of_blocks(wide, held, ["s_count", "block", "group"], scores.Tanimoto("q_fp", "s_fp"), k, None, 0.0, tasks)
    return met.withColumn("score", tanimoto(F.col("q_fp"), F.col("s_fp")))


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q_id").orderBy(F.col("score").desc(), F.col("s_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def popcount_visits(queries: DataFrame, sources: DataFrame, k: int, per_block: int = 50_000, asked_at_once: int = 5_000) -> tuple[DataFrame, DataFrame, dict[int, int]]:
    """The first round of ``pruned_candidates``: each query with its k best so far, the popcounts still to visit, and the sources by popcount.

    Two fingerprints can't be more alike than the lesser popcount over the greater. A query
    first meets the popcounts nearest to its own that hold k sources; with its k-th score there
    (``bound``) all popcounts whose share is less are ruled out. The driver gets a number
    for each popcount, as many as a fingerprint has bits at most.
    """
    sources = sources.withColumn("s_count", popcount(F.col("s_fp")))
    sizes = {r.s_count: r.n for r in sources.groupBy("s_count").agg(F.count("*").alias("n")).collect()}
    held = sorted(sizes)
    asked = queries.withColumn("q_count", popcount(F.col("q_fp")))
    first = []
    for c in [r[0] for r in asked.select("q_count").distinct().collect()]:
        near, n = [], 0
        for x in sorted(held, key=lambda x: (abs(x - c), x)):
            if n >= k:
                break
            near.append(x)
            n += sizes[x]
        first.append((c, near))
    rounds = queries.sparkSession.createDataFrame(first, "q_count int, visits array<int>")
    asked = asked.join(F.broadcast(rounds), "q_count")
    groups = max(1, -(-queries.count() // asked_at_once))
    best = _best(_blocks(sources, asked, sizes, groups, per_block, k), k)
    bound = best.groupBy(F.col("q_id").alias("b_id")).agg(F.when(F.count("*") == k, F.min("score")).otherwise(-1.0).alias("bound"))
    share = lambda x: F.coalesce(F.try_divide(F.least(x, F.col("q_count")).cast("double"), F.greatest(x, F.col("q_count"))), F.lit(0.0))
    every = F.array(*map(F.lit, held)).cast("array<int>")
    left = asked.join(bound, F.col("q_id") == F.col("b_id")).drop("b_id")
    left = left.withColumn("more", F.filter(F.array_except(every, F.col("visits")), lambda x: share(x) >= F.col("bound")))
    return best.drop("rank"), left, sizes


def pruned_candidates(queries: DataFrame, sources: DataFrame, k: int, per_block: int = 50_000, asked_at_once: int = 5_000) -> DataFrame:
    """As ``candidates`` with ``tanimoto``: the same rows, without comparing pairs whose popcounts rule them out.

    ``queries`` have ``q_id`` and ``q_fp``, ``sources`` ``s_id`` and ``s_fp``, both other columns.
    """
    best, left, sizes = popcount_visits(queries, sources, k, per_block, asked_at_once)
    groups = max(1, -(-queries.count() // asked_at_once))
    held = sources.withColumn("s_count", popcount(F.col("s_fp")))
    more = _blocks(held, left.drop("visits").withColumnRenamed("more", "visits"), sizes, groups, per_block, k).filter(F.col("score") >= F.col("bound")).drop("bound")
    return _best(best.unionByName(more), k).drop("q_count")


def compared_share(queries: DataFrame, sources: DataFrame, k: int) -> float:
    """The share of all pairs that ``pruned_candidates`` compares."""
    _, left, sizes = popcount_visits(queries, sources, k)
    per = F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair))
    visited = F.aggregate(F.concat("visits", "more"), F.lit(0).cast("long"), lambda s, c: s + F.element_at(per, c))
    row = left.agg(F.sum(visited).alias("met"), F.count("*").alias("asked")).first()
    return row["met"] / (row["asked"] * sum(sizes.values()))


def mean_vote(rows: DataFrame, query: list[str], label: str, tie: int = 1) -> DataFrame:
    """``probability``, the plain mean of each query's neighbours' labels, and ``predicted``; one half goes to ``tie``."""
    out = rows.groupBy(*query).agg(F.avg(F.col(label).cast("double")).alias("probability"))
    return out.withColumn("predicted", F.when(F.col("probability") == 0.5, tie).otherwise((F.col("probability") > 0.5).cast("int")))


def weighted_vote(rows: DataFrame, query: list[str], label: str, weight: str, tie: int = 1) -> DataFrame:
    """``probability`` and ``predicted`` of each query from its neighbours' labels.

    Weights below 0 count as 0. If no weight is above 0, or one isn't finite, all
    neighbours count alike. A probability of one half goes to ``tie``.
    """
    w, y = F.col(weight), F.col(label).cast("double")
    clipped = F.greatest(w, F.lit(0.0))
    plain = (F.max(w) <= 0) | F.bool_or(F.isnan(w) | (F.abs(w) == float("inf")))
    p = F.when(plain, F.avg(y)).otherwise(F.sum(clipped * y) / F.greatest(F.sum(clipped), F.lit(1e-12)))
    out = rows.groupBy(*query).agg(p.alias("probability"))
    return out.withColumn("predicted", F.when(F.col("probability") == 0.5, tie).otherwise((F.col("probability") > 0.5).cast("int")))
