"""Mixed timestamp formats and zones, normalised through a dictionary of distinct texts.

The raw texts are deduplicated with their source, the zone that holds where they name none, and the role they play (date or
time). Each distinct entry is parsed once, by an exhaustive reader, plainly written ones too; its result is appended to a
dictionary table, so that the next load of the source parses only what it has not met. The dictionary is joined back to all
rows, and date and time are composed to one instant with JVM expressions. Keeping dates and times apart makes the dictionary
small: there are few dates and at most 86,400 plain times, whatever the number of rows. A dictionary that does not fit a
broadcast all the same is joined by shuffle (:func:`lodestrom.operators.joins.skew_safe_join`).

Defined results
---------------
* A stamp without a zone is read in ``zone``. Of a local time that occurs twice the first is meant; a skipped one is
  read with the offset before the change (``to_utc_timestamp`` does both).
* A date text that states an instant or a date-time makes the time void. A null or blank time is midnight.
* Null, blank, impossible or unreadable texts resolve to null, as do instants outside the years 1 to 9999.
* Repeated rows are kept; empty tables give empty results; input columns keep their names, the result columns must be
  new ones (``out``), which is checked.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrom import scratch
from lodestrom.functions.amounts import is_blank
from lodestrom.functions.stamps import DAY, read_date, read_time
from lodestrom.operators.joins import skew_safe_join

LOCAL_ZONE = "Africa/Johannesburg"
_PARTS = [("kind", T.StringType()), ("day", T.LongType()), ("micros", T.LongType()), ("offset", T.LongType()), ("zone", T.StringType())]
KEY = ("source", "default_zone", "role", "text")
ENTRY = T.StructType([*(T.StructField(k, T.StringType()) for k in KEY), *(T.StructField(n, t) for n, t in _PARTS)])
#: Instants of the years 1 to 9999, in microseconds.
_FIRST, _LAST = -62_135_596_800_000_000, 253_402_300_799_999_999


class StampDictionary:
    """Parsed texts, kept as an append-only table at ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch.new_path(spark, "stamp-dictionary")
        self.allowed = frozenset(spark._jvm.java.time.ZoneId.getAvailableZoneIds().toArray())

    def table(self) -> DataFrame:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(self.path)

    def learn(self, texts: DataFrame) -> DataFrame:
        """Parse the entries (columns ``KEY``) that are not yet known, append them, and return the whole dictionary."""
        allowed = self.allowed

        def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                read = [(read_date if r == "date" else read_time)(t, allowed) or (None,) * 5 for r, t in zip(f["role"], f["text"], strict=True)]
                columns = list(zip(*read, strict=True)) or [()] * 5
                yield pd.DataFrame({k: f[k] for k in KEY} | {n: pd.Series(c, dtype="Int64" if isinstance(t, T.LongType) else "object", index=f.index) for (n, t), c in zip(_PARTS, columns, strict=True)})

        fresh = texts.where(F.col("text").isNotNull()).distinct().join(self.table().select(*KEY), list(KEY), "left_anti")
        fresh.mapInPandas(parse, ENTRY).write.mode("append").parquet(self.path)
        return self.table()


def _local(micros: Column, zone: Column | None, default: str) -> Column:
    """Local time to an instant; the default zone is a literal, whose rules are looked up once and not for every row."""
    at = F.timestamp_micros(micros)
    usual = F.to_utc_timestamp(at, default)
    return usual if zone is None else F.when(zone.isNull(), usual).otherwise(F.to_utc_timestamp(at, zone))


def _lookup(dictionary: DataFrame, source: str, zone: str, role: str, name: str) -> DataFrame:
    return dictionary.where((F.col("source") == source) & (F.col("default_zone") == zone) & (F.col("role") == role)).select(F.col("text").alias(f"_{name}_text"), F.struct("kind", "day", "micros", "offset", "zone").alias(f"_{name}"))


def normalise_instants(df: DataFrame, date_col: str, time_col: str | None = None, out: str = "instant", zone: str = LOCAL_ZONE, source: str = "", dictionary: StampDictionary | None = None) -> DataFrame:
    """``df`` with the UTC instant ``out`` (timestamp) and the local date ``<out>_date`` of each row.

    For a text that states only a date and has no time column, the instant is that date's midnight. ``source`` names where
    the texts come from; ``df`` is read twice, once for its distinct texts and once for its rows.
    """
    if taken := {out, f"{out}_date", "_d", "_t", "_d_text", "_t_text"} & set(df.columns):
        raise ValueError(f"columns exist already: {sorted(taken)}")
    dictionary = dictionary or StampDictionary(df.sparkSession)
    clock = F.col(time_col) if time_col else F.lit(None).cast("string")
    entry = lambda role, text: F.struct(F.lit(source).alias("source"), F.lit(zone).alias("default_zone"), F.lit(role).alias("role"), text.alias("text"))
    entries = [entry("date", F.col(date_col)), *([entry("time", F.when(~is_blank(clock), clock))] if time_col else [])]
    known = dictionary.learn(df.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))
    dates, times = (_lookup(known, source, zone, role, role[0]) for role in ("date", "time"))
    rows = df.withColumns({"_d_text": F.col(date_col), "_t_text": clock})
    rows = skew_safe_join(rows, dates, "_d_text", "left")
    if time_col:
        rows = skew_safe_join(rows, times, "_t_text", "left")
    else:
        rows = rows.withColumn("_t", F.lit(None).cast(times.schema["_t"].dataType))
    d, t = F.col("_d"), F.col("_t")
    midnight = d["day"] * F.lit(DAY)
    safe = lambda c: F.when(c.between(_FIRST, _LAST), c)
    with_time = F.when(t["offset"].isNotNull(), F.timestamp_micros(safe(midnight + t["micros"] - t["offset"] * 1_000_000))).otherwise(_local(safe(midnight + t["micros"]), t["zone"], zone))
    instant = (
        F.when(d["kind"] == "instant", F.timestamp_micros(safe(d["micros"])))
        .when(d["kind"] == "local", _local(safe(midnight + d["micros"]), d["zone"], zone))
        .when((d["kind"] == "date") & is_blank(F.col("_t_text")), _local(safe(midnight), None, zone))
        .when((d["kind"] == "date") & (t["kind"] == "time"), with_time)
    )
    day = F.when(d["kind"].isin("date", "local") & (F.lit(time_col is None)), F.when(d["zone"].isNull(), F.date_add(F.lit("1970-01-01").cast("date"), d["day"].cast("int"))))
    local_day = F.coalesce(day, F.to_date(F.from_utc_timestamp(F.col(out), zone)))
    # as a generated column the instant is computed once a row, whatever later steps filter or derive by it
    placed = rows.select("*", F.inline(F.array(F.struct(instant.alias(out)))))
    return placed.withColumn(f"{out}_date", local_day).drop("_d_text", "_t_text", "_d", "_t")


#: Texts that are already in the normal form.
PLAIN_DATE, PLAIN_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z", r"^[0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def not_plain(date_col: Column, time_col: Column | None = None) -> Column:
    """Whether a stamp is not written exactly as yyyy-MM-dd (and HH:mm:ss). Never null."""
    plain = F.coalesce(date_col.rlike(PLAIN_DATE), F.lit(False))
    return ~(plain & F.coalesce(time_col.rlike(PLAIN_TIME), F.lit(False))) if time_col is not None else ~plain
