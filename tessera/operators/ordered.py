"""Running sums, ranks and quantiles in an order, without a task that holds a whole group.

A number is a key of 64 bits that sorts as it does. Keys are cut into ranges by their first
digits: 16 bits, or 32 where more than ``MOST`` keys share these, or 48. Sums of ranges are
small, and are summed up first; only keys of one range are then ordered together. The
ranges follow from counts alone, so that a task that is run again finds the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys of a range, unless its first 48 bits are equal: then 65,536 at most.
MOST = 1 << 17

_LARGEST = 2**63 - 1


def order_key(value: Column) -> Column:
    """A long that sorts as the number does: -0.0 as 0.0, NaN last; null for null."""
    number = value.cast("double") + F.lit(0.0)
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(number, F.lit(0.0))).cast("long")
    return F.when(value.isNotNull(), F.when(bits < 0, bits.bitwiseXOR(F.lit(_LARGEST))).otherwise(bits))


def _same(a: DataFrame, b: DataFrame, columns: dict[str, str]) -> Column:
    """Null-safe equality of columns of ``a`` and ``b``."""
    out = F.lit(True)
    for x, y in columns.items():
        out &= a[x].eqNullSafe(b[y])
    return out


def ranges(keys: DataFrame, by: list[str], key: str, most: int | None = None) -> DataFrame:
    """``keys`` (a row for each key of a group) with ``range``, the least key that its range could hold."""
    most = most or MOST
    out, start = keys, F.shiftleft(F.shiftright(key, 48), 48)
    out = out.withColumn("range", start)
    for bits in (32, 16):
        heavy = out.groupBy(*by, "range").agg(F.count("*").alias("__n")).filter(F.col("__n") > most)
        heavy = heavy.select(*(F.col(c).alias(f"__{c}") for c in by), F.col("range").alias("__range"))
        met = out.join(heavy, _same(out, heavy, {**{c: f"__{c}" for c in by}, "range": "__range"}), "left")
        finer = F.shiftleft(F.shiftright(key, bits), bits)
        out = met.withColumn("range", F.when(F.col("__range").isNotNull(), finer).otherwise(F.col("range"))).select(*keys.columns, "range")
    return out


def range_sums(ranged: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """For each range the sums of ``values`` over it (``{v}``), over those before it in its group (``{v}_below``) and over all of them (``{v}_all``).

    There is a row a range, not a key, so these windows are small.
    """
    sums = ranged.groupBy(*by, "range").agg(*(F.sum(v).alias(v) for v in values))
    whole = Window.partitionBy(*by)
    upto = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    return sums.withColumns({f"{v}_below": F.coalesce(F.sum(v).over(upto), zero) for v in values} | {f"{v}_all": F.sum(v).over(whole) for v in values})


def running_sums(keys: DataFrame, by: list[str], key: str, values: list[str], most: int | None = None) -> DataFrame:
    """``keys`` with ``{v}_below``, the sum of each value over the lesser keys of the group, and ``{v}_all``, over all of them."""
    ranged = ranges(keys, by, key, most)
    sums = range_sums(ranged, by, values).drop(*values)
    sums = sums.select(*(F.col(c).alias(f"__{c}") for c in [*by, "range"]), *(f"{v}_{x}" for v in values for x in ("below", "all")))
    met = ranged.join(sums, _same(ranged, sums, {c: f"__{c}" for c in [*by, "range"]}))
    inside = Window.partitionBy(*by, "range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    met = met.withColumns({f"{v}_below": F.col(f"{v}_below") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    return met.select(*keys.columns, *(f"{v}_{x}" for v in values for x in ("below", "all")))


def quantiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float], most: int | None = None) -> DataFrame:
    """For each group the exact quantiles of ``value`` under the given names, linear between neighbours, and ``n``; nulls don't count.

    Equal values are one key with a count. Sums of ranges tell which ranges hold the wanted
    places; keys of no other range are ordered. A group without a value has no row.
    """
    held = rows.select(*by, F.col(value).cast("double").alias("v")).filter("v is not null")
    keys = held.groupBy(*by, order_key(F.col("v")).alias("key")).agg(F.min("v").alias("v"), F.count("*").alias("c"))
    ranged = ranges(keys, by, "key", most)
    sums = range_sums(ranged, by, ["c"])
    at = lambda p: (F.col("c_all") - 1) * F.lit(float(p))
    wanted = F.array(*(F.struct(F.lit(n).alias("name"), at(p).alias("at")) for n, p in shares.items()))
    places = sums.select(*by, "range", "c", "c_below", "c_all", F.inline(wanted))
    places = places.withColumn("place", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))))
    places = places.filter("c_below <= place and place < c_below + c")
    chosen = places.select(*by, "range", "c_below").distinct()
    chosen = chosen.select(*(F.col(c).alias(f"__{c}") for c in [*by, "range"]), "c_below")
    met = ranged.join(chosen, _same(ranged, chosen, {c: f"__{c}" for c in [*by, "range"]})).select(*ranged.columns, "c_below")
    inside = Window.partitionBy(*by, "range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    met = met.withColumn("first", F.col("c_below") + F.coalesce(F.sum("c").over(inside), F.lit(0)))
    met = met.select(*(F.col(c).alias(f"__{c}") for c in [*by, "range"]), "v", "first", (F.col("first") + F.col("c")).alias("end"))
    found = places.join(met, _same(places, met, {c: f"__{c}" for c in [*by, "range"]}) & (F.col("first") <= F.col("place")) & (F.col("place") < F.col("end")))
    near = 1 - F.abs(F.col("at") - F.col("place"))
    part = lambda n: F.sum(F.when((F.col("name") == n) & (near > 0), F.col("v") * near)).alias(n)
    return found.groupBy(*by).agg(*(part(n) for n in shares), F.max("c_all").alias("n"))
