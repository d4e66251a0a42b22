"""Keep-first deduplication, surplus rows and distinct keys over any table.

Hot keys never fill one task: where a whole row is picked, an aggregate combines map-side; where rows are ranked, the rows
of hot keys (at most ``1/share`` of them, see :func:`lodestrom.operators.joins.hot_keys`) are spread by a salt, and their
overall first comes from a map-side combined minimum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrom.operators.joins import hot_keys

SALTS = 32


def _total_order(order: list[Column], total: bool = False) -> Column:
    """The given order (nulls last) and, unless it is total already, the whole row as text, so that ties are settled the
    same way in every run."""
    keyed = [part for c in order for part in (c.isNull(), c)]
    rest = [] if total else [F.to_json(F.struct("*")).alias("row")]
    return F.struct(*(c.alias(f"o{i}") for i, c in enumerate(keyed)), *rest)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. Rows with a null in the key form no group: they are all kept; route them elsewhere
    before, if they must go."""
    whole = F.struct(*(F.col(c) for c in df.columns))
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.col(k).isNull()
    first = df.where(~keyless).groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.min_by(whole, _total_order(order)).alias("_first"))
    return first.select("_first.*").unionByName(df.where(keyless))


def keep_first_window(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The same by ``row_number() = 1`` with null keys as a group; Spark cuts each task to one row a key before the shuffle."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*(o.asc_nulls_last() for o in order), F.to_json(F.struct("*")))))
    return ranked.where("_rn = 1").drop("_rn")


def mark_first(df: DataFrame, key: str, order: list[Column], out: str = "_first", total: bool = False, share: float = 0.01, floor: int = 100_000) -> DataFrame:
    """``df`` with a boolean ``out``: whether a row is the first of its key; null where the key is null.

    ``total`` says that the order settles every tie (it ends in a unique column).
    """
    columns = df.columns
    hot = hot_keys(df.select(key), key, share, floor)
    rows = df.withColumn("_order", _total_order(order, total))
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    # equal rows share a salt, so that only one of them can be first; rows without a key are spread, none of them is ranked
    salt = F.when(is_hot | F.col(key).isNull(), F.pmod(F.xxhash64("_order"), F.lit(SALTS))).otherwise(0)
    ranked = rows.withColumn("_salt", salt).withColumn("_rn", F.row_number().over(Window.partitionBy(key, "_salt").orderBy("_order")))
    first = F.col("_rn") == 1
    if hot:
        least = rows.where(is_hot).groupBy(key).agg(F.min("_order").alias("_least"))
        ranked = ranked.join(F.broadcast(least), key, "left")  # at most 1/share keys
        first = first & F.coalesce(F.col("_order") == F.col("_least"), F.lit(True))
    return ranked.select(*columns, F.when(F.col(key).isNotNull(), first).alias(out))


def surplus_rows(df: DataFrame, key: str, order: list[Column], **hot: float) -> DataFrame:
    """The rows beyond the first of each key. Null keys have no surplus."""
    return mark_first(df, key, order, "_first", **hot).where("not _first").drop("_first")


def surplus_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, groups, and rows beyond the first of each group; null keys form a group of their own, which ``named_surplus``
    leaves out."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    surplus = lambda n: F.greatest(F.coalesce(F.sum(n), F.lit(0)), F.lit(0))
    named = F.when(~F.greatest(F.lit(False), *(F.col(k).isNull() for k in keys)), F.col("n") - 1)
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("groups"), surplus(F.col("n") - 1).alias("surplus"), surplus(named).alias("named_surplus"))
