"""Cleaning, coding and seeded draws as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNASSIGNED = ("nan", "none", "", "__na__")


def number(value: Column) -> Column:
    """A double in which null and NaN are 0."""
    return F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))


def clean_expression(value: Column) -> Column:
    """NaN, infinities and negative values are 0."""
    v = value.cast("float")
    bad = v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")) | (v < 0)
    return F.when(bad, F.lit(0.0).cast("float")).otherwise(v)


def code_between(value: Column, low: Column, high: Column) -> Column:
    """1 to 255 across low..high; 0 where both are equal."""
    scaled = (value - low) / (high - low) * 254 + 1
    return F.when(high == low, 0).otherwise(F.least(F.greatest(scaled, F.lit(1.0)), F.lit(255.0)).cast("int")).cast("int")


def code_of_expression(value: Column, most: Column) -> Column:
    """1 to 255 for values above 0 in single precision, else 0."""
    one = lambda x: x.cast("float")
    scaled = one(one(one(value / most) * one(F.lit(254.0))) + one(F.lit(1.0)))
    return F.when(value > 0, F.least(F.greatest(scaled, one(F.lit(1.0))), one(F.lit(255.0))).cast("int")).otherwise(0).cast("int")


def unassigned(name: Column) -> Column:
    """Sample names that stand for no sample."""
    return name.isNull() | F.lower(name).isin(*UNASSIGNED)


def hashed(seed: object, key: Column) -> Column:
    """A number from 0 to 2^32 - 1 that depends on seed and key only."""
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def unit(seed: object, key: Column) -> Column:
    """A number above 0 and below 1."""
    return (hashed(seed, key) + 0.5) / 4294967296.0


def chunk_of(key: Column, n_chunks: int, seed: object = 42) -> Column:
    """A uniform chunk that doesn't depend on the order of rows."""
    return F.pmod(hashed(seed, key), F.lit(n_chunks)).cast("int")
