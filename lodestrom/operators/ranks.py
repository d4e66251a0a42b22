"""Dense ranks over all rows without one window over all rows.

The distinct keys are cut into ranges, each range is ranked in its own task, and the number of keys in the ranges before it
is added. The ranges are written once, so that a repeated task finds the same keys in the same range.

Defined results
---------------
* Null keys get no rank and are left out; equal keys share one. Ranks start at 1. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrom import scratch


def rank_key(df: DataFrame, key: str, out: str = "rank") -> DataFrame:
    """``key`` and its rank ``out`` (bigint) among the distinct keys of ``df``."""
    distinct = df.select(F.col(key).alias("_key")).where("_key is not null").distinct()
    ranged = scratch.materialise(distinct.repartitionByRange("_key").withColumn("_range", F.spark_partition_id()), "key-ranges")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    return ranged.withColumn("_rn", within).join(F.broadcast(offsets), "_range").select(F.col("_key").alias(key), (F.col("_before") + F.col("_rn")).cast("long").alias(out))
