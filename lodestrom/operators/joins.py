"""Joins that neither broadcast without a measured size nor let one key fill one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrom import scratch

#: A side is broadcast only up to so many bytes, as measured from its rows.
BROADCAST_BYTES = 64 << 20


def width(value: Column, kind: T.DataType) -> Column:
    """Bytes that one value takes in a broadcast relation, whatever its type; never null."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, T.StructType):
        total = F.lit(8)
        for f in kind.fields:
            total = total + width(value.getField(f.name), f.dataType)
        return total
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        if isinstance(inner, T.StructType) and not any(isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)) for f in inner.fields):
            return F.greatest(F.coalesce(F.size(value), F.lit(0)), F.lit(0)) * (16 + 8 * len(inner.fields)) + 24
        return F.coalesce(F.aggregate(value, F.lit(24).cast("long"), lambda s, v: s + width(v, inner)), F.lit(24).cast("long"))
    if isinstance(kind, T.MapType):
        return width(F.map_keys(value), T.ArrayType(kind.keyType)) + width(F.map_values(value), T.ArrayType(kind.valueType))
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """What the rows of ``df`` would take, by one aggregate over them."""
    row = F.lit(16)
    for f in df.schema.fields:
        row = row + width(F.col(f"`{f.name}`"), f.dataType)
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("b")).first()["b"]


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the rows of ``df`` fit a broadcast."""
    return measured_bytes(df) <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its measured rows fit the limit; otherwise untouched, so that it is shuffled.

    ``df`` is read for the measurement: pass a written table or something as cheap to read.
    """
    return F.broadcast(df) if measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit) else df


def hot_keys(df: DataFrame, key: str, share: float = 0.01, floor: int = 100_000) -> list:
    """Keys with more than ``max(floor, share of all rows)`` rows, by a sketch of frequent items: one map-side combined
    aggregate, without a shuffle of the keys. At most ``1/share`` keys can be hot; the sketch tracks a hundred times as many,
    so it misses none and may add some that are nearly hot. Null is no key.
    """
    most = round(1 / share)
    sketch = F.expr(f"approx_top_k(`{key}`, {2 * most}, {min(1_000_000, max(10_000, 100 * most))})")
    found = df.where(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("n"), sketch.alias("top")).first()
    least = max(floor, share * found["n"])
    return [] if found["n"] <= floor else [r["item"] for r in found["top"] or [] if r["count"] > least]


def skew_safe_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float = 0.01, floor: int = 100_000) -> DataFrame:
    """Join a large, skewed ``left`` with a ``right`` that has few rows a key (inner, left, left_semi or left_anti).

    A small ``right`` (measured) is broadcast. Otherwise ``left`` is written once, rows of hot keys meet a broadcast of
    just these keys' right rows - at most ``1/share`` keys - and all others are shuffled. Null keys match nothing; ``left``
    and ``left_anti`` keep them without sending them through the shuffle of the matched part.
    """
    if fits_broadcast(right):
        return left.join(F.broadcast(right), key, how)
    left = scratch.materialise(left, "join-left")
    hot = hot_keys(left, key, share, floor)
    if not hot:
        return left.join(right, key, how)
    is_hot: Column = F.coalesce(F.col(key).isin(hot), F.lit(False))
    side = broadcast_if_small(right.where(is_hot))
    return left.where(is_hot).join(side, key, how).unionByName(left.where(~is_hot).join(right.where(~is_hot), key, how))
