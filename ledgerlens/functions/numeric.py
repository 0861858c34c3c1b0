"""Numeric expressions: exact means and reproducible hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HASH_DIGITS = 13  # hex digits of the digest that are used: 52 bits, exact in a double


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c: str | Column, scale: int = 2) -> Column:
    """Sum of amounts with at most ``scale`` decimals, summed as a decimal.

    A double sum depends on the order rows arrive in, which differs between
    runs and partitionings; a decimal sum does not.
    """
    return F.sum(_col(c).cast(f"decimal(38,{scale})"))


def exact_mean(c: str | Column, scale: int | None = 2) -> Column:
    """Mean as a double (null when there are no values, also under ANSI mode).

    Exact and independent of the rows' order for amounts with at most ``scale``
    decimals (others would be rounded: state the column's own scale).
    ``scale`` None: the plain double mean of whatever the column holds, whose
    last bits depend on the order.
    """
    if scale is None:
        return F.avg(_col(c).cast("double"))
    return F.try_divide(exact_sum(c, scale).cast("double"), F.count(_col(c)).cast("double"))


def unit_hash(key: str | Column, seed: int = 0) -> Column:
    """Reproducible value in [0, 1) from a key of any type.

    The first 52 bits of md5(seed:key): a mixing hash that other engines have
    too, so a lost task recomputes the same split (a random column would
    not), neighbouring keys are scattered, and different seeds give
    independent values (a hold-out and the folds, for instance).
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")).cast("binary"))
    bits = F.conv(F.substring(digest, 1, _HASH_DIGITS), 16, 10).cast("bigint")
    return bits.cast("double") / F.lit(float(1 << 4 * _HASH_DIGITS))


def unit_hash_sql(key: str, seed: int = 0) -> str:
    """The same hash in SQL text (for the DuckDB oracle)."""
    digits = f"substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, {_HASH_DIGITS})"
    return f"(CAST(CAST('0x' || {digits} AS BIGINT) AS DOUBLE) / {float(1 << 4 * _HASH_DIGITS)})"
