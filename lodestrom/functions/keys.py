"""Identifiers, hashes, buckets and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAX_LONG = 2**63 - 1


def identifier(col: Column) -> Column:
    """Letters and digits only, lower case; null when nothing is left."""
    return F.nullif(F.lower(F.regexp_replace(col.cast("string"), r"[^\p{L}\p{N}]", "")), F.lit(""))


def identity128(col: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes that together stand for a string in compact indexes."""
    return F.xxhash64(F.lit("a"), col), F.xxhash64(F.lit("b"), col, F.length(col))


def surrogate_key(*cols: Column) -> Column:
    """A deterministic, non-negative 63-bit key of the natural key."""
    return F.pmod(F.xxhash64(*cols), F.lit(_MAX_LONG))


def bucket_of(col: Column, buckets: int) -> Column:
    """Hash bucket of a possibly null key; equal keys share a bucket."""
    return F.pmod(F.xxhash64(F.coalesce(col.cast("string"), F.lit("\u0000null"))), F.lit(buckets)).cast("int")
