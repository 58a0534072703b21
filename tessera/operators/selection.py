"""Allocation, stratified selection and splits, without a global order of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import kept_table
from .ordered import quantiles


def largest_remainder(counts: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """Quotas in proportion to ``n``: whole shares, then the largest remainders; zero quotas go.

    ``counts`` has a row for each stratum, so its windows are over strata, not rows.
    """
    whole = Window.partitionBy()
    available = F.sum(n).over(whole)
    share = counts.withColumn("t", F.least(F.lit(total).cast("long"), available))
    share = share.withColumn("raw", F.col("t") * (F.col(n) / F.sum(n).over(whole))).withColumn("low", F.floor("raw"))
    turn = F.row_number().over(Window.partitionBy().orderBy((F.col("raw") - F.col("low")).desc(), F.col(n).desc(), F.col(key)))
    quota = F.col("low") + (turn <= F.col("t") - F.sum("low").over(whole)).cast("int")
    return share.withColumn("quota", quota.cast("long")).filter("quota > 0").select(key, n, "quota")


def first_by_key(rows: DataFrame, group: list[str], key: str, quota: Column, tie: str) -> DataFrame:
    """Of each group the rows with the smallest ``key`` (hex digits), as many as ``quota`` says; null is a group like others.

    ``quota`` is an expression over the group's columns and ``n``, its number of rows. The
    rows are counted by the key's first four digits; ranges wholly inside or outside need
    no order, and only the one range of each group that the quota cuts is ranked.
    """
    prefix = F.substring(key, 1, 4)
    ranges = rows.groupBy(*group, prefix.alias("prefix")).agg(F.count("*").alias("c"))
    over = Window.partitionBy(*group)
    ranges = ranges.withColumns({"n": F.sum("c").over(over), "before": F.sum("c").over(over.orderBy("prefix")) - F.col("c")})
    left = (quota - F.col("before")).alias("left")
    cut = ranges.select(*(F.col(g).alias(f"__{g}") for g in group), F.col("prefix").alias("__prefix"), F.col("c").alias("__c"), left.alias("__left")).filter("__left > 0")
    on = prefix.eqNullSafe(F.col("__prefix"))
    for g in group:
        on &= F.col(g).eqNullSafe(F.col(f"__{g}"))
    met = rows.join(cut, on)
    whole = met.filter("__left >= __c")
    turn = F.row_number().over(Window.partitionBy(*group, "__prefix").orderBy(key, tie))
    part = met.filter("__left < __c").withColumn("__turn", turn).filter(F.col("__turn") <= F.col("__left"))
    return whole.select(*rows.columns).unionByName(part.select(*rows.columns))


def first_k(rows: DataFrame, group: list[str], key: str, k: int, tie: str) -> DataFrame:
    """Of each group the ``k`` rows with the smallest ``key``, in one pass, for a ``k`` that fits in a task.

    Spark limits the groups before it shuffles, so no task sees more than ``k`` rows of a group from each other.
    """
    if not group:
        return rows.orderBy(key, tie).limit(k)
    turn = F.row_number().over(Window.partitionBy(*group).orderBy(key, tie))
    return rows.withColumn("__turn", turn).filter(F.col("__turn") <= k).drop("__turn")


def first_by_bound(rows: DataFrame, sizes: DataFrame, group: list[str], key: str, k: int, tie: str, spare: int = 4) -> DataFrame:
    """As ``first_k``, for a ``key`` that spreads evenly (a digest's hex digits): only rows below a bound are kept, written and ranked.

    ``sizes`` has a row for each group of ``rows``, and ``n``, its number of rows. About ``spare``
    times ``k`` + 100 rows of a group are below its bound, so rows are read once, and neither shuffled nor
    sorted. Where a group has fewer below it than are wanted, ``first_by_key`` takes them from all rows.
    """
    share = F.least(F.lit(1.0), F.lit(float(spare * (k + 100))) / F.col("n"))
    # the bound's first 12 digits; rows of a group of that few all come first
    bound = F.when(share < 1, F.lpad(F.lower(F.hex(F.floor(share * F.lit(float(1 << 48))))), 12, "0")).otherwise("g")
    bounds = sizes.select(*(F.col(g).alias(f"__{g}") for g in group), F.col("n").alias("__n"), bound.alias("__bound"))
    on = F.lit(True)
    for g in group:
        on &= F.col(g).eqNullSafe(F.col(f"__{g}"))
    # coalesced, a null is first, and no filter for nulls works the key out once more
    below = F.coalesce(F.col(key), F.lit("")) < F.col("__bound")
    near = kept_table(rows.join(F.broadcast(bounds), on & below).select(*rows.columns), "below-bounds")
    held = near.groupBy(*(F.col(g).alias(f"__h_{g}") for g in group)).agg(F.count("*").alias("__held"))
    met = F.lit(True)
    for g in group:
        met &= F.col(f"__{g}").eqNullSafe(F.col(f"__h_{g}"))
    short = bounds.join(held, met, "left").filter(F.coalesce("__held", F.lit(0)) < F.least(F.col("__n"), F.lit(k)))
    return first_by_key(rows, group, key, F.lit(k), tie) if short.limit(1).collect() else first_k(near, group, key, k, tie)


def positions(rows: DataFrame, group: list[str], key: str, tie: str) -> DataFrame:
    """``position`` (from 0) of each row in its group in the order of ``key`` (hex digits), and the group's size ``n_group``.

    Rows are counted by the key's first four digits; only rows of one such range are ranked together.
    """
    prefix = F.substring(key, 1, 4)
    over = Window.partitionBy(*group)
    ranges = rows.groupBy(*group, prefix.alias("__prefix")).agg(F.count("*").alias("__c"))
    ranges = ranges.withColumns({"n_group": F.sum("__c").over(over), "__before": F.sum("__c").over(over.orderBy("__prefix")) - F.col("__c")}).drop("__c")
    ranges = ranges.select(*(F.col(g).alias(f"__{g}") for g in group), "__prefix", "n_group", "__before")
    on = F.col("__p") == F.col("__prefix")
    for g in group:
        on &= F.col(g).eqNullSafe(F.col(f"__{g}"))
    met = rows.withColumn("__p", prefix).join(ranges, on)
    turn = F.row_number().over(Window.partitionBy(*group, "__p").orderBy(key, tie))
    return met.withColumn("position", F.col("__before") + turn - 1).select(*rows.columns, "position", "n_group")


def shrunk(counts: DataFrame, n: str, key: str, tie: str, cap: int) -> DataFrame:
    """Which entities move out, most rows first, until the rest holds at most ``cap`` rows (``moved``).

    The running sum is over the distinct numbers of rows; entities of equal numbers have their
    places in the order of ``key`` from ``positions``.
    """
    sizes = counts.groupBy(F.col(n).alias("__n")).agg(F.sum(n).alias("__s"))
    more = F.coalesce(F.sum("__s").over(Window.orderBy(F.col("__n").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumns({"__more": more, "__all": F.sum("__s").over(Window.partitionBy())})
    placed = positions(counts, [n], key, tie).join(sizes, F.col(n) == F.col("__n"))
    before = F.col("__more") + F.col("position") * F.col(n)
    return placed.withColumn("moved", F.col("__all") - before > cap).select(*counts.columns, "moved")


def folds(rows: DataFrame, label: str, key: str, k: int) -> DataFrame:
    """``fold`` 0 to k - 1, even within each label, in the order of ``key``; the first folds take what is left over."""
    placed = positions(rows, [label], key, key)
    size, more, at = F.floor(F.col("n_group") / k), F.col("n_group") % k, F.col("position")
    large = more * (size + 1)
    fold = F.when(at < large, F.floor(at / (size + 1))).otherwise(more + F.floor((at - large) / F.greatest(size, F.lit(1))))
    return placed.withColumn("fold", fold).select(*rows.columns, "fold")


def without_overlap(rows: DataFrame, reference: DataFrame, row_id: str, raw: str, normal: Column, other_raw: str, other_normal: Column) -> DataFrame:
    """Rows none of whose forms (raw, normalised) equals a form of a reference text."""
    known = reference.select(F.explode(F.array(F.col(other_raw), other_normal)).alias("form")).filter("form is not null").distinct()
    hits = rows.select(row_id, F.explode(F.array(F.col(raw), normal)).alias("form")).join(known, "form", "left_semi").select(row_id).distinct()
    return rows.join(hits, row_id, "left_anti")


def routed(pairs: DataFrame, selected: DataFrame, no_train: DataFrame) -> DataFrame:
    """``route`` of each pair (id_a, id_b): ``eval`` if selected in either order, ``discard`` with an end that mustn't be trained on, else ``train``."""
    order = lambda d: d.select(F.least("id_a", "id_b").alias("lo"), F.greatest("id_a", "id_b").alias("hi")).distinct().withColumn("hit", F.lit(True))
    ends = lambda c: no_train.select(F.col("id").alias(c)).distinct().withColumn(f"no_{c}", F.lit(True))
    out = pairs.withColumns({"lo": F.least("id_a", "id_b"), "hi": F.greatest("id_a", "id_b")}).join(order(selected), ["lo", "hi"], "left")
    out = out.join(ends("id_a"), "id_a", "left").join(ends("id_b"), "id_b", "left")
    route = F.when(F.col("hit"), "eval").when(F.col("no_id_a") | F.col("no_id_b"), "discard").otherwise("train")
    return out.withColumn("route", route).select(*pairs.columns, "route")


def incident_costs(pairs: DataFrame, a: str, b: str, n: str | None = None) -> DataFrame:
    """How many pair ends each entity holds; a pair of an entity with itself counts twice. A row stands for ``n`` pairs, where given."""
    held = F.col(n) if n else F.lit(1).cast("long")
    return pairs.select(F.explode(F.array(a, b)).alias("entity"), held.alias("__n")).groupBy("entity").agg(F.sum("__n").alias("cost"))


def support_graph(pairs: DataFrame, a: str, b: str, n: str | None = None) -> DataFrame:
    """Edges between entities with the number of pairs, in both directions; loops once. A row stands for ``n`` pairs, where given."""
    edges = pairs.groupBy(F.least(a, b).alias("entity"), F.greatest(a, b).alias("neighbour")).agg(F.sum(n or F.lit(1).cast("long")).alias("weight"))
    return edges.union(edges.filter("entity <> neighbour").select("neighbour", "entity", "weight"))


def degrees(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Of each entity the number of distinct pairs; a loop counts once."""
    distinct = pairs.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct()
    return distinct.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("entity")).groupBy("entity").agg(F.count("*").alias("degree"))


def degree_summary(entities: DataFrame, degree: str) -> DataFrame:
    """One row: least, quartiles, mean, 95th percentile and most of ``degree``."""
    marks = quantiles(entities, [], degree, {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95})
    ends = entities.agg(F.min(degree).alias("least"), F.avg(degree).alias("mean"), F.max(degree).alias("most"))
    both = ends.unionByName(marks.drop("n"), allowMissingColumns=True)
    six = lambda c: F.round(F.max(c), 6).alias(c)
    return both.agg(F.max("least").alias("least"), six("p25"), six("p50"), six("mean"), six("p75"), six("p95"), F.max("most").alias("most"))


def split_overlaps(rows: DataFrame, split: str, key: str) -> DataFrame:
    """For every two splits how many distinct keys are in both, from one grouping by key."""
    sets = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_set(split)).alias("s")).filter("size(s) > 1")
    two = F.expr("filter(flatten(transform(s, x -> transform(s, y -> struct(x as left, y as right)))), p -> p.left < p.right)")
    return sets.select(F.inline(two)).groupBy("left", "right").agg(F.count("*").alias("shared"))


def pair_overlap(held: DataFrame, train: DataFrame) -> DataFrame:
    """Of held-out pairs (source, target): how many occur in ``train`` as they are, in either order, and with both ends in it."""
    way = train.select("source", "target").distinct().withColumn("same", F.lit(1))
    either = train.select(F.least("source", "target").alias("lo"), F.greatest("source", "target").alias("hi")).distinct().withColumn("pair", F.lit(1))
    ends = train.select(F.explode(F.array("source", "target")).alias("end")).distinct()
    rows = held.select("source", "target", F.least("source", "target").alias("lo"), F.greatest("source", "target").alias("hi"))
    rows = rows.join(way, ["source", "target"], "left").join(either, ["lo", "hi"], "left")
    for c in ("source", "target"):
        rows = rows.join(ends.select(F.col("end").alias(c), F.lit(1).alias(f"has_{c}")), c, "left")
    both = F.col("has_source").isNotNull() & F.col("has_target").isNotNull()
    return rows.agg(F.count("*").alias("pairs"), F.count("same").alias("directed"), F.count("pair").alias("either"), F.count_if(both).alias("both_ends"))


def selections(pairs: DataFrame, selected: DataFrame, added: list[str]) -> DataFrame:
    """A row for each time that a pair (``id_a`` < ``id_b``) was selected, with the selection's columns ``added``."""
    return pairs.join(selected.select("id_a", "id_b", *added), ["id_a", "id_b"])


def kept_from_training(selected: DataFrame, subset: str = "subset", both: str = "no_overlap", target: str = "a_seen_only") -> DataFrame:
    """``entity``: those that no training pair may hold. Both ends of ``both`` pairs, the second (by direction) of ``target`` pairs.

    ``selected`` has ``entity_a``, ``entity_b`` and ``direction``.
    """
    forth = F.col("direction") == "a_to_b"
    first, second = F.when(forth, F.col("entity_a")).otherwise(F.col("entity_b")), F.when(forth, F.col("entity_b")).otherwise(F.col("entity_a"))
    ends = F.when(F.col(subset) == both, F.array(first, second)).when(F.col(subset) == target, F.array(second))
    return selected.select(F.explode(ends).alias("entity")).distinct()


def pool_order(subset: Column, first_kept: Column, second_kept: Column, degrees: Column, priority: Column) -> Column:
    """What candidates of a pool are taken by, least first: preferred ends, then high degrees, then the hash.

    ``no_overlap`` prefers pairs with more ends that are kept from training anyway,
    ``a_seen_only`` those of which the second end is and the first isn't, others those with fewer.
    """
    a, b = first_kept.cast("int"), second_kept.cast("int")
    preferred = F.when(subset == "no_overlap", -(a + b)).when(subset == "a_seen_only", a - b).otherwise(a + b)
    return F.struct(preferred.alias("preferred"), (-degrees).alias("degrees"), priority.alias("priority"))
