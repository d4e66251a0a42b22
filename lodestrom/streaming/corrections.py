"""Late corrections on a stream: watermarked event-time windows with keyed state, upserts, and diverted late records.

Each record's own arrival is the clock that decides between on time, late and too late, so the result does not depend on how
records are spread over batches. Two queries read the stream:

* *accepted* records - those that arrive within the allowed lateness of their event's period - go through a watermarked
  event-time window with keyed state: per window and record the earliest arrival is kept. When an earlier delivery comes in
  a later batch, the state emits the record again, and the sink upserts it: rows are appended under the number of their
  batch (a repeated batch replaces itself), and of a record's rows the earliest arrival is in force. State is evicted once
  the watermark passes its window;
* *diverted* records - too late, without times, or without an identifier - are appended to a table of their own.

Aggregates are derived from what is in force after both: a redelivery that moves a record to another period takes it out of
the first one, because nothing else says that it ever was there.

The watermark follows ``least(event, arrival)``, so that a clock that runs ahead cannot move it. It lags by the allowed
lateness, one period and the ``disorder`` of the stream: how far the arrivals of a batch may lie behind those of earlier
batches. A record that comes in even later than that would be lost by the state; :func:`CorrectionStream.run` counts such
records and raises an error instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestrom import scratch
from lodestrom.operators import lateness

COLUMNS = ("record", "event", "arrival", "key", "amount")


def windowed_totals(stream: DataFrame, event: str, value: str, key: str, allowed: str = "48 hours", window: str = "1 day") -> DataFrame:
    """Event-time windows with a watermark, emitted as updates; for streams whose clock is the events' own."""
    timed = stream.withColumn(event, F.col(event).cast("timestamp")).withWatermark(event, allowed)
    return timed.groupBy(F.window(event, window), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def _in_time(allowed_hours: int, period: str) -> Column:
    closes = F.date_trunc(period, "event") + F.expr(f"interval 1 {period}")
    return F.coalesce(F.col("arrival") <= closes + F.expr(f"interval {allowed_hours} hours"), F.lit(False)) & F.col("record").isNotNull()


@dataclass
class CorrectionStream:
    """The state of one stream of records under ``root``: its checkpoints and its two logs. Opened again, it goes on."""

    spark: SparkSession
    root: str
    allowed_hours: int = lateness.ALLOWED_HOURS
    period: str = "day"
    disorder_hours: int = 0

    def _log(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _append(self, name: str) -> object:
        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self._log(name)}/batch={number}")

        return write

    def start(self, stream: DataFrame) -> list[StreamingQuery]:
        """Both queries over what is there to read; ``stream`` has the columns ``COLUMNS``."""
        rows = stream.select(*COLUMNS)
        kept = _in_time(self.allowed_hours, self.period)
        lag = self.allowed_hours + {"hour": 1, "day": 24, "week": 168}[self.period] + self.disorder_hours
        timed = rows.where(kept).withColumn("clock", F.least("event", "arrival")).withWatermark("clock", f"{lag} hours")
        first = F.min_by(F.struct("event", "arrival", "key", "amount"), F.struct("arrival", "event", "key", "amount"))
        state = timed.groupBy(F.window("clock", f"1 {self.period}"), "record").agg(first.alias("first")).select("record", "first.*")
        queries = []
        for name, df, mode in (("accepted", state, "update"), ("diverted", rows.where(~kept), "append")):
            writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{self.root}/checkpoint-{name}")
            queries.append(writer.foreachBatch(self._append(name)).trigger(availableNow=True).start())
        return queries

    def run(self, stream: DataFrame) -> None:
        """Read all that is there; raises if the state had to drop a record because the stream's disorder was greater than said."""
        for q in self.start(stream):
            q.awaitTermination()
            lost = sum(int(op["numRowsDroppedByWatermark"]) for p in q.recentProgress for op in p["stateOperators"])
            if lost:
                raise ValueError(f"{lost} records lie further back than {self.disorder_hours} hours: allow more disorder")

    def _read(self, name: str) -> DataFrame:
        schema = "record string, event timestamp, arrival timestamp, key string, amount decimal(18,2)"
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self._log(name))
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(f"{schema}, batch int").parquet(self._log(name)).select(*COLUMNS)

    def records(self) -> DataFrame:
        """Every record at the arrival in force, judged: ``record, arrival, event, c_key, c_amount, period_start, verdict``."""
        both = self._read("accepted").unionByName(self._read("diverted"))
        return lateness.judge_lateness(lateness.first_arrivals(both, "record", "event", "arrival", "key", "amount"), self.allowed_hours, self.period)

    def totals(self) -> DataFrame:
        """``key, period_start, revision, n, total``: the corrected aggregates."""
        return lateness.corrected(lateness.upserts(self.records(), "c_key", "c_amount"))

    def diverted(self) -> DataFrame:
        """What came too late or has no times, for reporting."""
        return lateness.diverted(self.records())


def replay(df: DataFrame, record: str, event: str, arrival: str, key: str, amount: str, batches: int = 4, **how: int) -> CorrectionStream:
    """Stream a table in the order of arrival: it lands as files, batch after batch, and is read a batch of files at a time.

    Ties in the arrival never straddle two batches. Files of one batch may be read in any order; the widest batch is
    therefore the disorder that the stream has.
    """
    spark = df.sparkSession
    rows = df.select(F.col(record).cast("string").alias("record"), F.col(event).alias("event"), F.col(arrival).alias("arrival"), F.col(key).cast("string").alias("key"), F.col(amount).cast("decimal(18,2)").alias("amount"))
    marks = rows.agg(F.percentile_approx("arrival", [i / batches for i in range(1, batches)], 1000).alias("m")).first()["m"] or [] if batches > 1 else []
    cuts = sorted({m for m in marks if m is not None})
    number = sum((F.coalesce(F.col("arrival") > F.lit(c), F.lit(False)).cast("int") for c in cuts), F.lit(0))
    staged = scratch.materialise(rows.withColumn("n", number.cast("int")), "arrivals", ["n"])
    spans = {r["n"]: r["h"] or 0 for r in staged.groupBy("n").agg(F.ceil((F.max("arrival").cast("double") - F.min("arrival").cast("double")) / 3600).alias("h")).collect()}  # at most `batches` rows
    landing, schema = scratch.new_path(spark, "landing"), staged.drop("n").schema
    for n in sorted(spans):
        staged.where(F.col("n") == n).drop("n").write.mode("append").parquet(landing)
    state = CorrectionStream(spark, scratch.new_path(spark, "corrections"), disorder_hours=int(max(spans.values(), default=0)) + 1, **how)
    if spans:
        files = len(spark.read.schema(schema).parquet(landing).inputFiles())
        state.run(spark.readStream.schema(schema).option("maxFilesPerTrigger", -(-files // batches)).parquet(landing))
    return state
