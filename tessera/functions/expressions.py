"""Column expressions: text normalisation, missing values, labels, buckets and codes."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value, in conditions and in record metadata.
NULL_TEXTS = ("", "n/a", "na", "none", "not applicable", "not reported", "not specified", "not stated", "null", "unknown", "unspecified")
MISSING_TOKENS = ("", "na", "n/a", "nan", "none", "null", "unknown", "not reported")


def squeezed(text: Column) -> Column:
    """Stripped of white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normal_text(text: Column) -> Column:
    """Stripped, lower case, dashes as hyphens, white space as one space; null for texts that say nothing."""
    plain = F.regexp_replace(F.translate(F.lower(squeezed(text)), "–—", "--"), r"(?U)\s+", " ")
    return F.when(~plain.isin(*NULL_TEXTS), plain)


def is_blank(text: Column) -> Column:
    """Null, or nothing but white space."""
    return F.coalesce(squeezed(text) == "", F.lit(True))


def is_missing_token(text: Column) -> Column:
    """Null, or a token that stands for a missing value in record metadata."""
    return F.coalesce(F.lower(squeezed(text)).isin(*MISSING_TOKENS), F.lit(True))


def condition_key(species: Column, *others: Column) -> Column:
    """Normalised parts joined by `` | ``: null without a species, ``not specified`` for other parts that are missing."""
    parts = [F.coalesce(normal_text(c), F.lit("not specified")) for c in others]
    first = normal_text(species)
    return F.when(first.isNotNull(), F.concat_ws(" | ", first, *parts))


def finite(value: Column) -> Column:
    """The value as a double; null if it isn't a finite number."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def fixed(value: Column, digits: int) -> Column:
    """The number with so many decimals, as Python and C write it: the binary value is rounded, and exact ties to even.

    (Spark's ``format_string`` rounds the shortest decimal text half up: 2.675 is 2.68 there, and 2.67 here.)
    The product with the power of ten is a double and its exact error, by Dekker's splitting.
    Numbers of more than 15 digits are left to ``format_string``. NaN is ``nan``, infinity ``inf``.
    """
    x, scale = value.cast("double"), 10.0**digits
    cut = 134217729.0  # 2^27 + 1
    high = cut * scale - (cut * scale - scale)
    low = scale - high
    size = F.abs(x)
    product, whole = size * scale, F.floor(size * scale)
    upper = cut * size - (cut * size - size)
    lower = size - upper
    error = ((upper * high - product) + upper * low + lower * high) + lower * low
    over = product - whole - 0.5
    up = (over > 0) | ((over == 0) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    number = whole + up.cast("long")
    text = F.concat(F.floor(number / F.lit(10**digits)).cast("string"), F.lit("." if digits else ""), F.lpad((number % F.lit(10**digits)).cast("string"), digits, "0") if digits else F.lit(""))
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
    text = F.when(product < 1e15, F.concat(sign, text)).otherwise(F.format_string(f"%.{digits}f", x))
    return F.when(F.isnan(x), "nan").when(size == float("inf"), F.concat(sign, F.lit("inf"))).when(x.isNotNull(), text)


def bucket_above(value: Column, thresholds: list[float]) -> Column:
    """How many thresholds the value exceeds (a value on a threshold is in the bucket below)."""
    return sum((F.when(value > t, 1).otherwise(0) for t in thresholds), F.lit(0))


def bucket_from(value: Column, thresholds: list[float]) -> Column:
    """How many thresholds the value reaches, in single precision; 255 for a value that isn't finite."""
    single = F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)).cast("float")
    count = sum((F.when(single >= F.lit(t).cast("float"), 1).otherwise(0) for t in thresholds), F.lit(0))
    return F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), 255).otherwise(count)


def presence_code(a: Column, b: Column) -> Column:
    """0 if both are null, 1 if one is, 2 if neither is."""
    return a.isNotNull().cast("int") + b.isNotNull().cast("int")


def deadband_label(difference: Column, near: float = 10.0, far: float = 30.0) -> Column:
    """1 up to ``near``, 0 from ``far`` on, null between."""
    return F.when(difference <= near, 1).when(difference >= far, 0)


def missing_mask(*fields: Column) -> Column:
    """A string with a 1 for each field that is missing, and a 0 for each other."""
    return F.concat(*(F.when(is_missing_token(c), "1").otherwise("0") for c in fields))


def missing_bucket(count: Column) -> Column:
    """The count of nine fields missing as a range."""
    return F.when(count <= 2, "0-2").when(count <= 5, "3-5").otherwise("6-9")


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def json_text(fields: dict[str, Column], numbers: tuple[str, ...] = ()) -> Column:
    """A JSON object with sorted keys, nulls kept, a space after each colon and comma, and ASCII only.

    Fields among ``numbers`` are written as they are, all others as texts.
    """
    text = lambda k: fields[k].cast("string")
    parts = [F.concat(F.lit(json.dumps(k) + ": "), F.coalesce(text(k) if k in numbers else json_quoted(text(k)), F.lit("null"))) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def json_quoted(text: Column) -> Column:
    """A JSON string: escapes for quotes, backslashes, control characters and all that isn't ASCII."""
    unit = lambda x: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(x), 4, "0")))
    short = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}

    def escaped(c: Column) -> Column:
        point = F.ascii(c)
        over = point - 0x10000
        pair = F.concat(unit(F.shiftright(over, 10) + 0xD800), unit(over.bitwiseAND(0x3FF) + 0xDC00))
        out = F.when(c == '"', short['"'])
        for k, v in list(short.items())[1:]:
            out = out.when(c == k, v)
        return out.when(point >= 0x10000, pair).when((point < 0x20) | (point > 0x7E), unit(point)).otherwise(c)

    plain = ~text.rlike(r'[^ !#-\[\]-~]')
    return F.concat(F.lit('"'), F.when(plain, text).otherwise(F.array_join(F.transform(F.split(text, ""), escaped), "")), F.lit('"'))


def null_token(text: Column, token: str = "<null>") -> Column:
    """The stripped text of a stratum's value, or ``token`` if it is null or blank."""
    plain = F.trim(text.cast("string"))
    return F.when(plain != "", plain).otherwise(token)


def value_set(text: Column) -> Column:
    """Aggregate: the distinct stripped texts that aren't blank, in order."""
    plain = F.trim(text)
    return F.sort_array(F.collect_set(F.when(plain != "", plain)))


def presence(text: Column) -> Column:
    """1 for a text that isn't null or blank, else 0."""
    return (~is_blank(text)).cast("int")


def scaled(value: Column, scale: float = 100.0) -> Column:
    """A finite value over ``scale``; fails in its task for one that is missing or isn't finite."""
    number = finite(value)
    return F.when(number.isNull(), F.raise_error(F.lit("a source value is missing or not finite"))).otherwise(number / scale)


def split_metric(name: Column, splits: tuple[str, ...] = ("validation_1", "validation_2", "test")) -> tuple[Column, Column]:
    """Split and metric of a name such as ``test_auroc``; ``unknown`` and the whole name for others."""
    pattern = f"^({'|'.join(splits)})_(.*)$"
    known = name.rlike(pattern)
    return F.when(known, F.regexp_extract(name, pattern, 1)).otherwise("unknown"), F.when(known, F.regexp_extract(name, pattern, 2)).otherwise(name)
