"""Keyed states: running balances and the last n records of each key. Pure functions of (state, batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrom.config import HOME_CURRENCY
from lodestrom.functions.currency import clean_currency

CREDITS = ("CREDIT", "REVERSAL")
TYPES = ("DEBIT", "CREDIT", "FEE", "REVERSAL")
EVENT_COLUMNS = ("account_id", "transaction_id", "transaction_timestamp", "amount", "transaction_type", "channel")


def admit(events: DataFrame, currency: str | None = None) -> DataFrame:
    """Events with all required fields, a known type and (if there is such a column) the home currency."""
    kept = events.where("transaction_id is not null and account_id is not null and transaction_timestamp is not null and amount is not null").where(F.col("transaction_type").isin(*TYPES))
    return kept.where(clean_currency(F.col(currency)) == HOME_CURRENCY) if currency else kept


def apply_balances(state: DataFrame, events: DataFrame, written_at: str | None = None) -> DataFrame:
    """The state after ``events``, each of which counts once.

    State and events are entries of one ledger: an account's row is the sum of its opening balance and of the signed
    amounts, and the latest of all times, in one map-side combined aggregation. Times never move backwards, so the order of
    batches does not matter. Accounts without an opening entry are not added: seed the state with all accounts. A null
    opening balance stays null. ``updated_at`` is the time of writing where something was booked.
    """
    nothing = F.lit(None).cast("timestamp")
    opening = state.select("account_id", F.col("current_balance").cast("decimal(18,2)").alias("change"), F.col("last_transaction_timestamp").alias("at"), F.col("updated_at").alias("since"), F.lit(True).alias("opens"))
    sign = F.when(F.col("transaction_type").isin(*CREDITS), 1).otherwise(-1)
    booked = events.select("account_id", (F.col("amount") * sign).cast("decimal(18,2)").alias("change"), F.col("transaction_timestamp").alias("at"), nothing.alias("since"), F.lit(False).alias("opens"))
    ledger = opening.unionByName(booked).groupBy("account_id").agg(
        F.sum("change").alias("balance"), F.max("at").alias("at"), F.max("since").alias("since"), F.count_if("opens").alias("openings"), F.count_if(~F.col("opens")).alias("bookings"), F.count_if(F.col("opens") & F.col("change").isNull()).alias("unknown")
    )
    now = F.lit(written_at).cast("timestamp") if written_at else F.current_timestamp()
    return ledger.where("openings > 0").select(
        "account_id",
        F.when(F.col("unknown") == 0, F.col("balance")).cast("decimal(18,2)").alias("current_balance"),
        F.col("at").alias("last_transaction_timestamp"),
        F.when(F.col("bookings") > 0, now).otherwise(F.col("since")).alias("updated_at"),
    )


def seed_balances(accounts: DataFrame) -> DataFrame:
    """A state for every account, with its batch balance and no activity yet."""
    epoch = F.lit("1970-01-01").cast("timestamp")
    return accounts.select("account_id", F.col("current_balance").cast("decimal(18,2)").alias("current_balance"), epoch.alias("last_transaction_timestamp"), epoch.alias("updated_at"))


def once_per_transaction(events: DataFrame) -> DataFrame:
    """One row per (account, transaction): the latest, ties by the whole row."""
    rest = [c for c in events.columns if c not in ("account_id", "transaction_id")]
    order = F.struct(F.coalesce("transaction_timestamp", F.lit("1970-01-01").cast("timestamp")), F.to_json(F.struct(*rest)))
    picked = events.groupBy("account_id", "transaction_id").agg(F.max_by(F.struct(*rest), order).alias("p"))
    return picked.select("account_id", "transaction_id", "p.*").select(events.columns)


def last_n(events: DataFrame, n: int = 50) -> DataFrame:
    """The n latest records of each account. The limit is pushed below the shuffle, so a hot account sends n rows a task."""
    order = Window.partitionBy("account_id").orderBy(F.col("transaction_timestamp").desc(), "transaction_id")
    return events.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).drop("_rn")
