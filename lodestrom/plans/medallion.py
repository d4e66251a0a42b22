"""Bronze to silver to gold as pure functions of DataFrames.

One scan of each source feeds everything: rows are deduplicated, matched to their account and given *one* outcome in the
column ``outcome`` (``valid``, ``duplicate``, ``missing_required`` or ``orphan``, first match in that order), so that loaded and
quarantined rows add up to what came in. Issue counts come from observations of the frames that are written anyway.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrom import scratch
from lodestrom.config import REQUIRED_TRANSACTION_FIELDS, Settings
from lodestrom.functions import currency, geo
from lodestrom.functions.amounts import amount as readable_amount
from lodestrom.functions.keys import identifier, surrogate_key
from lodestrom.functions.parse import age_band, is_blank, is_date_variant, is_quoted_amount, parse_date, parse_timestamp
from lodestrom.operators.dedupe import mark_first
from lodestrom.operators.joins import skew_safe_join
from lodestrom.sources.files import with_missing

SILVER_TRANSACTION = ("transaction_id", "account_id", "transaction_date", "transaction_timestamp", "transaction_type", "merchant_category", "merchant_subcategory", "amount", "currency", "channel", "province", "dq_flag", "ingestion_timestamp")
FACT = ("transaction_sk", "transaction_id", "account_sk", "customer_sk", "transaction_date", "transaction_timestamp", "transaction_type", "merchant_category", "merchant_subcategory", "amount", "currency", "channel", "province", "dq_flag", "ingestion_timestamp")
DIM_ACCOUNT = ("account_sk", "account_id", "customer_id", "account_type", "account_status", "open_date", "product_tier", "digital_channel", "credit_limit", "current_balance", "last_activity_date")
DIM_CUSTOMER = ("customer_sk", "customer_id", "gender", "province", "income_band", "segment", "risk_score", "kyc_status", "age_band")


@dataclass(frozen=True)
class Split:
    """The rows that load and those that do not, the latter with a ``reason``."""

    valid: DataFrame
    rejected: DataFrame


def null_if_blank(col: Column) -> Column:
    return F.when(~is_blank(col), col)


def arrival_order(bronze: DataFrame) -> tuple[list[Column], bool]:
    """How the rows of a table arrived, as far as it says, and whether that order is total."""
    return [F.col(c) for c in ("loaded_at", "row_id") if c in bronze.columns], "row_id" in bronze.columns


def silver_customers(bronze: DataFrame) -> Split:
    """One typed row per customer id; surplus rows and rows without an id are rejected with a reason."""
    order, total = arrival_order(bronze)
    ranked = mark_first(bronze.withColumn("customer_id", identifier(F.col("customer_id"))), "customer_id", order, total=total)
    reason = F.when(F.col("customer_id").isNull(), "NULL_REQUIRED").when(~F.col("_first"), "DUPLICATE_DEDUPED")
    kept = ranked.where(reason.isNull()).select(
        "customer_id", "gender", "province", "income_band", "segment", F.col("risk_score").try_cast("double").cast("int").alias("risk_score"), "kyc_status",
        parse_date(F.col("dob")).alias("dob"), is_date_variant(F.col("dob")).alias("date_variant"), "product_flags",
    )
    return Split(kept, ranked.withColumn("reason", reason).where("reason is not null").drop("_first"))


def silver_accounts(bronze: DataFrame, customers: DataFrame) -> Split:
    """One typed row per account id that belongs to a known customer; all others are rejected with a reason."""
    order, total = arrival_order(bronze)
    keyed = bronze.withColumns({"account_id": identifier(F.col("account_id")), "customer_ref": identifier(F.col("customer_ref"))})
    ranked = mark_first(keyed, "account_id", order, total=total)
    owners = customers.select(F.col("customer_id").alias("customer_ref"), F.lit(True).alias("_owned"))
    met = skew_safe_join(ranked, owners, "customer_ref", "left")
    reason = F.when(F.col("account_id").isNull(), "NULL_REQUIRED").when(~F.col("_first"), "DUPLICATE_DEDUPED").when(F.col("_owned").isNull(), "UNKNOWN_CUSTOMER")
    judged = met.withColumn("reason", reason)
    kept = judged.where("reason is null").select(
        "account_id", "customer_ref", "account_type", "account_status", parse_date(F.col("open_date")).alias("open_date"), "product_tier", "mobile_number", "digital_channel",
        readable_amount(F.col("credit_limit")).alias("credit_limit"), readable_amount(F.col("current_balance")).alias("current_balance"), parse_date(F.col("last_activity_date")).alias("last_activity_date"),
        (is_date_variant(F.col("open_date")) | is_date_variant(F.col("last_activity_date"))).alias("date_variant"),
    )
    return Split(kept, judged.where("reason is not null").drop("_first", "_owned"))


def typed_transactions(bronze: DataFrame) -> DataFrame:
    """Typed values beside the quality marks of their texts. Blank required texts become null."""
    rows = with_missing(bronze, {"merchant_subcategory": "string", "raw_json": "string", "amount_was_quoted": "boolean", "ingestion_timestamp": "timestamp"})
    if "ingested_at" in rows.columns:
        rows = rows.withColumn("ingestion_timestamp", F.col("ingested_at"))
    value = readable_amount(F.col("amount"))
    quoted = F.coalesce("amount_was_quoted", is_quoted_amount(F.col("raw_json")))
    return rows.select(
        *(c for c in ("row_id", "_first", "_known") if c in rows.columns),
        identifier(F.col("transaction_id")).alias("transaction_id"),
        identifier(F.col("account_id")).alias("account_id"),
        parse_date(F.col("transaction_date")).alias("transaction_date"),
        parse_timestamp(F.col("transaction_date"), F.col("transaction_time")).alias("transaction_timestamp"),
        null_if_blank(F.col("transaction_type")).alias("transaction_type"),
        "merchant_category",
        "merchant_subcategory",
        value.alias("amount"),
        null_if_blank(currency.clean_currency(F.col("currency"))).alias("currency"),
        null_if_blank(F.col("channel")).alias("channel"),
        F.col("location.province").alias("province"),
        (quoted & value.isNotNull()).alias("amount_quoted"),
        (~is_blank(F.col("amount")) & value.isNull()).alias("amount_unreadable"),
        is_date_variant(F.col("transaction_date")).alias("date_variant"),
        currency.is_variant(F.col("currency")).alias("currency_variant"),
        "ingestion_timestamp",
        "raw_json",
    )


def dq_flag() -> Column:
    """The first mark that applies, or null."""
    return F.when(F.col("amount_quoted"), "TYPE_MISMATCH").when(F.col("date_variant"), "DATE_FORMAT").when(F.col("currency_variant"), "CURRENCY_VARIANT")


def _known_accounts(accounts: DataFrame, key: str) -> DataFrame:
    return accounts.select(F.col("account_id").alias(key), F.lit(True).alias("_known")).where(F.col(key).isNotNull())


def mark_known(bronze: DataFrame, accounts: DataFrame) -> DataFrame:
    """``bronze`` with ``_known``: true where the account is known, else null. For rows that are judged in many parts, so that
    the accounts are met once."""
    return skew_safe_join(bronze.withColumn("_account", identifier(F.col("account_id"))), _known_accounts(accounts, "_account"), "_account", "left").drop("_account")


def judged_transactions(bronze: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Every row with its ``outcome``; ids are kept at their first time, rows without an id are never duplicates. Without
    ``accounts`` the rows must come from :func:`mark_known`.

    Hot ids are spread over salts, see :func:`lodestrom.operators.dedupe.mark_first`; the rest is typed after that, once.
    """
    total = "row_id" in bronze.columns
    order = [parse_timestamp(F.col("transaction_date"), F.col("transaction_time")), *([F.col("row_id")] if total else [])]
    keyed = bronze.withColumn("transaction_id", identifier(F.col("transaction_id")))
    ranked = typed_transactions(mark_first(keyed, "transaction_id", order, total=total))
    met = ranked if accounts is None else skew_safe_join(ranked, _known_accounts(accounts, "account_id"), "account_id", "left")
    missing = F.lit(False)
    for c in REQUIRED_TRANSACTION_FIELDS:
        missing = missing | F.col(c).isNull()
    outcome = F.when(~F.col("_first"), "duplicate").when(missing, "missing_required").when(F.col("_known").isNull(), "orphan").otherwise("valid")
    return met.withColumns({"outcome": outcome, "dq_flag": dq_flag()}).drop("_first", "_known")


def silver_transactions(judged: DataFrame) -> Split:
    names = {"duplicate": "DUPLICATE_DEDUPED", "missing_required": "NULL_REQUIRED", "orphan": "ORPHANED_ACCOUNT"}
    reason = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[F.col("outcome")]
    keep = [c for c in ("row_id",) if c in judged.columns]
    return Split(judged.where("outcome = 'valid'").select(*keep, *SILVER_TRANSACTION), judged.where("outcome <> 'valid'").withColumn("reason", reason))


def with_provenance(bronze: DataFrame, settings: Settings) -> DataFrame:
    """``bronze`` with the currency and coordinate provenance columns."""
    lat, lon = geo.latitude(F.col("location.coordinates")), geo.longitude(F.col("location.coordinates"))
    placed = bronze.withColumns(currency.readiness_columns(F.col("currency")) | {"geo_coordinate_raw": F.col("location.coordinates"), "geo_latitude": lat, "geo_longitude": lon})
    found = geo.flags(F.col("geo_coordinate_raw"), F.col("location.province"), F.col("geo_latitude"), F.col("geo_longitude"), settings.check_province_boxes)
    return placed.withColumn("geo_anomaly_flags", geo.flag_text(found))


def with_provenance_of(judged: DataFrame, bronze: DataFrame, settings: Settings) -> DataFrame:
    """The valid ones of the judged rows with the provenance of their bronze rows (matched by ``row_id``, which both need)."""
    added = with_provenance(bronze.select("row_id", "currency", "location"), settings).drop("currency", "location")
    return judged.where("outcome = 'valid'").join(added, "row_id")


def dim_customers(silver: DataFrame, settings: Settings) -> DataFrame:
    as_of = F.lit(settings.as_of).cast("date")
    return silver.withColumns({"customer_sk": surrogate_key(F.col("customer_id")), "age_band": age_band(F.col("dob"), as_of)}).select(*DIM_CUSTOMER)


def dim_accounts(silver: DataFrame) -> DataFrame:
    return silver.withColumns({"account_sk": surrogate_key(F.col("account_id")), "customer_id": F.col("customer_ref")}).select(*DIM_ACCOUNT)


def fact_transactions(silver: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """The fact table; a customer's own province goes before the one its transaction states."""
    owners = customers.select("customer_id", "customer_sk", F.col("province").alias("_home"))
    held = accounts.select("account_id", "account_sk", "customer_id").join(owners, "customer_id").drop("customer_id")
    met = skew_safe_join(silver, held, "account_id", "inner")
    return met.withColumns({"transaction_sk": surrogate_key(F.col("transaction_id")), "province": F.coalesce("_home", "province")}).select(*FACT)


def judge(customers: DataFrame, accounts: DataFrame, transactions: DataFrame) -> tuple[Split, Split, DataFrame]:
    """Silver customers and accounts, and the judged transactions, each written once: later steps read what was written,
    so that no step is computed twice and the sizes that decide on broadcasts are counted from files."""
    c = silver_customers(customers)
    c = Split(scratch.materialise(c.valid, "silver-customers"), c.rejected)
    a = silver_accounts(accounts, c.valid)
    a = Split(scratch.materialise(a.valid, "silver-accounts"), a.rejected)
    return c, a, scratch.materialise(judged_transactions(transactions, a.valid), "judged-transactions")


def tables(c: Split, a: Split, judged: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """All silver and gold tables and the quarantines by name, of what :func:`judge` gives."""
    t = silver_transactions(judged)
    dims_c, dims_a = dim_customers(c.valid, settings), dim_accounts(a.valid)
    return {
        "silver/customers": c.valid, "silver/accounts": a.valid, "silver/transactions": t.valid,
        "quarantine/customers": c.rejected, "quarantine/accounts": a.rejected, "quarantine/transactions": t.rejected,
        "gold/dim_customers": dims_c, "gold/dim_accounts": dims_a, "gold/fact_transactions": fact_transactions(t.valid, dims_a, dims_c),
    }


def build(customers: DataFrame, accounts: DataFrame, transactions: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """All silver and gold tables and the quarantines by name."""
    return tables(*judge(customers, accounts, transactions), settings)
