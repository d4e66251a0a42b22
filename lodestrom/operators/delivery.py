"""Messages delivered more than once: a persistent identifier index made of immutable sorted runs.

The index lies under one folder and is opened again by naming it: a numbered manifest there lists the live runs. A run is
a written table with one row per hash prefix; the row holds the 128-bit identities of that prefix's identifiers as two
sorted parallel arrays, with the key of the row that was kept. An incoming batch is deduplicated locally (a partial
aggregation, so an identifier that fills a third of the batch moves as one row a task), its identities are binary-searched
in the runs of the same prefix, and the novel ones are written as a new run.

Runs have tiers: ``merge_every`` runs of one tier are merged into one run of the next, so an identity is rewritten once a
tier, not once a batch. Runs are never changed in place; those merged away are deleted after the new manifest stands.

A prefix is the leading bits of the hash. Their number grows with the index, so that a prefix never holds more than about
``per_prefix`` identities, however large the index is. A run with fewer bits is cut into finer prefixes as it is read: its
arrays are sorted by the hash, so a finer prefix is a slice of them.

Defined results
---------------
* Rows without an identifier (null, blank, or without any letter or digit) are never duplicates.
* Of the rows with one identifier the earliest by ``(order column, row key)`` stays; a null order value comes last. Across
  batches the one in the earlier batch stays.
* Exact repetitions of a row, row key included, count as one row. An empty table gives an empty result.
* Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrom import scratch
from lodestrom.functions.keys import identifier, identity128
from lodestrom.sources.versions import Versions

_ARRAYS = ("hi", "lo", "kept")
RUN_SCHEMA = T.StructType([T.StructField("prefix", T.LongType()), *(T.StructField(n, T.ArrayType(T.LongType())) for n in _ARRAYS)])


def _arrays(row: Any) -> tuple[np.ndarray, ...]:
    return tuple(np.asarray(getattr(row, n), np.int64) for n in _ARRAYS)


def _joined(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The arrays of several runs of one prefix as one sorted run."""
    hi, lo, kept = (np.concatenate([np.asarray(a, np.int64) for a in rows[n]]) if len(rows) else np.empty(0, np.int64) for n in _ARRAYS)
    order = np.lexsort((lo, hi))
    return hi[order], lo[order], kept[order]


def _known(hi: np.ndarray, lo: np.ndarray, run_hi: np.ndarray, run_lo: np.ndarray) -> np.ndarray:
    """Which identities a sorted run holds, by binary search."""
    if not len(run_hi):
        return np.zeros(len(hi), bool)
    at, end = np.searchsorted(run_hi, hi, "left"), np.searchsorted(run_hi, hi, "right")
    found = np.zeros(len(hi), bool)
    single = end - at == 1
    found[single] = run_lo[at[single]] == lo[single]
    for i in np.flatnonzero(end - at > 1):  # equal first halves: search the second ones
        j = at[i] + np.searchsorted(run_lo[at[i] : end[i]], lo[i])
        found[i] = j < end[i] and run_lo[j] == lo[i]
    return found


def _prefix(hi: Column, bits: int) -> Column:
    """The leading bits of a signed hash, in its own order."""
    return F.shiftright(hi, 64 - bits) if bits else F.lit(0).cast("long")


class DeliveryIndex:
    """The index of one stream of identifiers, under ``root`` in the shared folder; an existing one is opened."""

    def __init__(self, spark: SparkSession, root: str | None = None, per_prefix: int = 200_000, merge_every: int = 4, least_bits: int = 2):
        self.spark, self.per_prefix, self.merge_every, self.least_bits = spark, per_prefix, merge_every, least_bits
        self.root = root or scratch.new_path(spark, "delivery-index")
        self.manifest = Versions(spark, f"{self.root}/_manifest")
        self.runs: list[dict[str, Any]] = (self.manifest.latest() or {"runs": []})["runs"]

    def _bits(self, rows: int) -> int:
        bits = self.least_bits
        while rows >> bits > self.per_prefix:
            bits += 1
        return max([bits, *(r["bits"] for r in self.runs)])

    @property
    def identities(self) -> int:
        """How many identities are kept."""
        return sum(r["rows"] for r in self.runs)

    def _publish(self, runs: list[dict[str, Any]]) -> None:
        gone = {r["path"] for r in self.runs} - {r["path"] for r in runs}
        self.manifest.publish({"runs": runs})
        self.runs = runs
        for path in gone:
            scratch.remove(self.spark, f"{self.root}/{path}")

    def _write(self, df: DataFrame, bits: int, tier: int) -> dict[str, Any]:
        """A new run, named by the manifest's next number: a run that was cut off before it was listed is overwritten."""
        path = f"run={self.manifest.next_number()}"
        df.write.mode("overwrite").parquet(f"{self.root}/{path}")
        rows = self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.root}/{path}").agg(F.coalesce(F.sum(F.size("kept")), F.lit(0)).alias("n")).first()["n"]
        return {"path": path, "bits": bits, "tier": tier, "rows": rows}

    def read(self, runs: list[dict[str, Any]], bits: int) -> DataFrame:
        """The given runs, cut to prefixes of ``bits`` bits."""
        if not runs:
            return self.spark.createDataFrame([], RUN_SCHEMA)

        def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for row in f.itertuples(index=False):
                    hi, lo, kept = _arrays(row)
                    prefix = hi >> (64 - bits)
                    ends = [0, *(np.flatnonzero(np.diff(prefix)) + 1), len(hi)]
                    parts = [(int(prefix[a]), hi[a:b], lo[a:b], kept[a:b]) for a, b in zip(ends, ends[1:], strict=False) if b > a]
                    yield pd.DataFrame(parts, columns=["prefix", *_ARRAYS])

        reader = self.spark.read.schema(RUN_SCHEMA)
        fine = [f"{self.root}/{r['path']}" for r in runs if r["bits"] == bits]
        coarse = [f"{self.root}/{r['path']}" for r in runs if r["bits"] != bits]
        frames = ([reader.parquet(*fine)] if fine else []) + ([reader.parquet(*coarse).mapInPandas(cut, RUN_SCHEMA)] if coarse else [])
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def admit(self, batch: DataFrame, rows: int | None = None) -> None:
        """Index a batch with the columns ``hi, lo, row_key, at``; of an identity only the first row is kept."""
        rows = batch.count() if rows is None else rows
        bits = self._bits(self.identities + rows)
        first = batch.groupBy("hi", "lo").agg(F.min(F.struct(F.col("at").isNull().alias("late"), "at", "row_key")).alias("first"))
        first = first.select("hi", "lo", F.col("first.row_key").alias("row_key"), _prefix(F.col("hi"), bits).alias("prefix"))

        def novel(key: tuple, rows: pd.DataFrame, run: pd.DataFrame) -> pd.DataFrame:
            if not len(rows):
                return pd.DataFrame(columns=["prefix", *_ARRAYS])
            hi, lo = rows["hi"].to_numpy(), rows["lo"].to_numpy()
            new = ~np.logical_or.reduce([_known(hi, lo, np.asarray(a, np.int64), np.asarray(b, np.int64)) for a, b in zip(run["hi"], run["lo"], strict=True)] or [np.zeros(len(hi), bool)])
            hi, lo, kept = hi[new], lo[new], rows["row_key"].to_numpy()[new]
            order = np.lexsort((lo, hi))
            return pd.DataFrame({"prefix": [key[0]], "hi": [hi[order]], "lo": [lo[order]], "kept": [kept[order]]})

        found = first.groupBy("prefix").cogroup(self.read(self.runs, bits).groupBy("prefix")).applyInPandas(novel, RUN_SCHEMA)
        self._publish([*self.runs, self._write(found, bits, 0)])
        tier = 0
        while sum(r["tier"] == tier for r in self.runs) >= self.merge_every:
            self.merge(tier)
            tier += 1

    def merge(self, tier: int) -> None:
        """Replace the runs of a tier by one run of the next."""
        old = [r for r in self.runs if r["tier"] == tier]
        bits = self._bits(self.identities)

        def merged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            hi, lo, kept = _joined(rows)
            return pd.DataFrame({"prefix": [key[0]], "hi": [hi], "lo": [lo], "kept": [kept]})

        run = self._write(self.read(old, bits).groupBy("prefix").applyInPandas(merged, RUN_SCHEMA), bits, tier + 1)
        self._publish([r for r in self.runs if r["tier"] != tier] + [run])

    def kept(self) -> DataFrame:
        """Keys of the rows that were kept."""
        if not self.runs:
            return self.spark.createDataFrame([], "row_key long")
        paths = [f"{self.root}/{r['path']}" for r in self.runs]
        return self.spark.read.schema(RUN_SCHEMA).parquet(*paths).select(F.explode("kept").alias("row_key"))


def keyed_rows(df: DataFrame, id_col: str, order_col: str, row_key: str) -> DataFrame:
    """``hi, lo, row_key, at`` of the rows that bear an identifier."""
    hi, lo = identity128(F.col("_id"))
    return df.select(identifier(F.col(id_col)).alias("_id"), F.col(row_key).cast("long").alias("row_key"), F.col(order_col).alias("at")).where(F.col("_id").isNotNull()).select(hi.alias("hi"), lo.alias("lo"), "row_key", "at")


def surplus_deliveries(df: DataFrame, id_col: str = "transaction_id", order_col: str = "ingested_at", row_key: str = "row_id", batches: int = 4, per_prefix: int = 200_000, merge_every: int = 3, root: str | None = None) -> DataFrame:
    """Keys of the rows that must go, as the one column ``row_key``.

    The table is replayed as ``batches`` consecutive batches of arrival (ties in the order column never straddle two
    batches), each admitted to the :class:`DeliveryIndex` under ``root``, which is opened anew for every batch.
    """
    spark: SparkSession = df.sparkSession
    rows = keyed_rows(df, id_col, order_col, row_key)
    marks = df.agg(F.percentile_approx(F.col(order_col), [i / batches for i in range(1, batches)], 1000).alias("m")).first()["m"] or [] if batches > 1 else []
    cuts = sorted({m for m in marks if m is not None})
    number = sum((F.coalesce(F.col("at") > F.lit(c), F.lit(True)).cast("int") for c in cuts), F.lit(0))
    staged = scratch.materialise(rows.withColumn("batch", number.cast("int")), "delivery-rows", ["batch"])
    sizes = {r["batch"]: r["n"] for r in staged.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `batches` rows
    root = root or scratch.new_path(spark, "delivery-index")
    for b in sorted(sizes):
        DeliveryIndex(spark, root, per_prefix, merge_every).admit(staged.where(F.col("batch") == b), sizes[b])
    return staged.select("row_key").distinct().join(DeliveryIndex(spark, root).kept(), "row_key", "left_anti")


def deliver_once(df: DataFrame, id_col: str = "transaction_id", order_col: str = "ingested_at", row_key: str = "row_id", **how: int) -> DataFrame:
    """``df`` without the surplus deliveries."""
    gone = surplus_deliveries(df, id_col, order_col, row_key, **how).withColumnRenamed("row_key", "_gone_key")
    return df.join(gone, F.col(row_key) == F.col("_gone_key"), "left_anti")
