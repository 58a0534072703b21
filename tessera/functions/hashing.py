"""Keys that order or sample rows the same way wherever they lie."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def sha_key(*parts) -> Column:
    """SHA-256 (hex) of the parts' texts joined by ``|``: an order that depends on them alone."""
    return F.sha2(F.concat_ws("|", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts)), 256)


def sha_number(*parts) -> Column:
    """The first 32 bits of ``sha_key`` as a number."""
    return F.conv(F.substring(sha_key(*parts), 1, 8), 16, 10).cast("long")


def kept_by_hash(fraction: float, *parts, steps: int = 1_000_000) -> Column:
    """Whether a row is in a deterministic sample of about ``fraction`` of all."""
    return F.pmod(sha_number(*parts), F.lit(steps)) < round(fraction * steps)


def one_direction(*parts) -> Column:
    """Which of a pair's two directions is used: by the parity of its hash, which the last of the number's hex digits tells."""
    return F.when(F.substring(sha_key(*parts), 8, 1).isin(*"02468ace"), "a_to_b").otherwise("b_to_a")


def _blake(size: int, seed: int = 0):
    """A function of a text column: hex digits of its BLAKE2b digest of ``size`` bytes, XORed with ``seed``.

    Spark has no BLAKE2, so this runs on Arrow batches; one call of the C library a text.
    """

    @F.pandas_udf("string")
    def digits(text: pd.Series) -> pd.Series:
        made = [None if x is None else hashlib.blake2b(x.encode(), digest_size=size).digest() for x in text.tolist()]
        if not seed:
            return pd.Series([None if d is None else d.hex() for d in made])
        return pd.Series([None if d is None else f"{int.from_bytes(d, 'big') ^ seed:0{2 * size}x}" for d in made])

    return digits


def priority64(seed: int):
    """A function of a text column: 16 hex digits of the 8-byte BLAKE2b digest, XORed with the seed; they sort as the numbers do."""
    return _blake(8, seed)


def stable_id(*parts) -> Column:
    """24 hex digits of the 12-byte BLAKE2b digest of the parts' texts joined by ``|``."""
    return _blake(12)(_text(parts))


def _text(parts) -> Column:
    """Parts joined by ``|``, as Python writes them: null is ``None``."""
    return F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("None")) if isinstance(p, Column) else F.lit(str(p)) for p in parts))


def blake_number(seed: int, *parts, steps: int = 1_000_000) -> Column:
    """The parts' 64-bit priority modulo ``steps``."""
    digits = priority64(seed)(_text(parts))
    half = lambda at: F.conv(F.substring(digits, at, 8), 16, 10).cast("long")
    return (half(1) % steps * (2**32 % steps) + half(9)) % steps


def kept_row(split: Column, pair: Column, label: Column, seed: int, fractions: dict[str, float], strategy: str = "random", source_pair: Column | None = None, source_fraction: float | None = None, direction: Column | None = None) -> Column:
    """Whether a row is in its split's sample, by 64-bit BLAKE2 priorities.

    Splits not in ``fractions`` are kept whole. Training rows (``train``) are drawn by ``pair``, with
    ``label`` in the key under the strategy ``label_stratified``. With ``source_fraction`` or ``direction`` they
    are drawn by ``source_pair`` (``pair`` where it is null), so that both directions go together;
    with ``direction`` only the pair's own hash-chosen one stays, and rows of neither direction do.
    """
    if strategy not in ("random", "label_stratified"):
        raise ValueError(f"unknown strategy {strategy!r}")
    steps = 1_000_000
    key = lambda base: [F.lit("train_label"), label, base] if strategy == "label_stratified" else [F.lit("train"), base]
    share = lambda f, *parts: F.lit(True) if f >= 1 else blake_number(seed, *parts) < int(f * steps)
    out = F.lit(True)
    for name, f in fractions.items():
        if name != "train":
            out = F.when(split == name, share(f, F.lit(name), pair)).otherwise(out)
    if source_fraction is None and direction is None:
        train = share(fractions.get("train", 1.0), *key(pair))
    else:
        base = F.coalesce(source_pair, pair) if source_pair is not None else pair
        train = share(1.0 if source_fraction is None else source_fraction, *key(base))
        if direction is not None:
            own = F.when(blake_number(seed, F.lit("direction"), base, steps=2) == 0, "a_to_b").otherwise("b_to_a")
            train &= ~F.coalesce(direction.isin("a_to_b", "b_to_a"), F.lit(False)) | direction.eqNullSafe(own)
    return F.when(split == "train", train).otherwise(out)


def kept_pair(fraction: float, seed: int, pair: Column, label: Column | None = None, direction: Column | None = None) -> Column:
    """Whether a training row is sampled by its pair, so that both directions are kept or left out together.

    With ``label`` each label is drawn by keys of its own; with ``direction`` the pair's
    hash-chosen direction alone is kept.
    """
    parts = [F.lit("train"), pair] if label is None else [F.lit("train_label"), label, pair]
    kept = kept_by_hash(fraction, seed, *parts)
    return kept if direction is None else kept & (direction == one_direction(seed, F.lit("direction"), pair))


def table_digest(*columns: str) -> Column:
    """Aggregate: a digest of a table's rows in these columns in whatever order; repeated rows count."""
    text = F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns))
    part = lambda at: F.sum(F.conv(F.substring(F.sha2(text, 256), at, 8), 16, 10).cast("decimal(38,0)"))
    return F.sha2(F.concat_ws("|", F.count("*"), *(part(1 + 8 * k) for k in range(4))), 256)
