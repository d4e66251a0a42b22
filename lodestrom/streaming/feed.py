"""Structured Streaming: admission, running balances and last-n state by idempotent upserts of a versioned store.

The checkpoint remembers which files were read; the store's pointer remembers the last batch applied, separately for each
table, so a restart between the two writes repeats neither. Both states are independent of the order of the files. The ids
that were seen are never rewritten: each batch appends its new ones as a part of its own, under its number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestrom.functions.amounts import amount
from lodestrom.functions.keys import identifier
from lodestrom.functions.parse import parse_timestamp
from lodestrom.operators import states
from lodestrom.sources.files import parse_transactions
from lodestrom.sources.store import Store

BALANCES, RECENT, SEEN = "current_balances", "recent_transactions", "seen_transactions"


def line_stream(spark: SparkSession, folder: str, pattern: str = "stream_*.jsonl", files_per_batch: int = 100) -> DataFrame:
    """Admitted events of JSON-lines files as they land: a stateless projection."""
    lines = spark.readStream.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).text(folder)
    return typed_events(parse_transactions(lines))


def typed_events(parsed: DataFrame) -> DataFrame:
    rows = parsed.select(
        identifier(F.col("account_id")).alias("account_id"),
        identifier(F.col("transaction_id")).alias("transaction_id"),
        parse_timestamp(F.col("transaction_date"), F.col("transaction_time")).alias("transaction_timestamp"),
        amount(F.col("amount")).alias("amount"),
        "transaction_type",
        "channel",
        "currency",
    )
    return states.admit(rows, "currency").drop("currency")


def seen_ids(store: Store) -> DataFrame:
    """``transaction_id, account_id, batch`` of every event that was booked."""
    schema = "transaction_id string, account_id string, batch long"
    p, fs = store._path(f"{store.root}/{SEEN}")
    return store.spark.read.schema(schema).parquet(f"{store.root}/{SEEN}") if fs.exists(p) else store.spark.createDataFrame([], schema)


def apply_batch(store: Store, batch: DataFrame, batch_id: int, kept: int = 50, written_at: str | None = None) -> None:
    """Apply one micro-batch to the balance, last-n and seen-id tables; events of unknown accounts are discarded.

    The tables are written in the order balances, recent, seen; each skips a batch it has already applied. A batch that is
    repeated after a crash finds the ids of the other batches only, so it gives the same new ones as before.
    """
    spark = store.spark
    events = batch.select(*states.EVENT_COLUMNS)
    balances = store.read(BALANCES)
    known = states.once_per_transaction(events).join(balances.select("account_id"), "account_id", "left_semi")
    seen = seen_ids(store).where(F.col("batch") != batch_id)
    fresh = known.join(seen, ["account_id", "transaction_id"], "left_anti").persist()
    try:
        store.overwrite(states.apply_balances(balances, fresh, written_at), BALANCES, batch_id=batch_id)
        old = store.read(RECENT, known.schema)
        both = states.once_per_transaction(old.unionByName(known))
        store.overwrite(states.last_n(both, kept), RECENT, batch_id=batch_id)
        part, fs = store._path(f"{store.root}/{SEEN}/batch={batch_id}")
        if not fs.exists(store._hadoop.Path(part, "_SUCCESS")):
            fresh.select("transaction_id", "account_id").write.mode("overwrite").parquet(str(part))
    finally:
        fresh.unpersist()


def start(stream: DataFrame, store: Store, checkpoint: str, kept: int = 50, once: bool = True, written_at: str | None = None) -> StreamingQuery:
    """Run the stream into the store; with ``once`` it stops when nothing is left to read."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, i: apply_batch(store, df, i, kept, written_at))
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()
