"""Issues, percentages, reconciliation and reports."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrom.config import Settings
from lodestrom.functions.keys import identifier
from lodestrom.functions.parse import is_date_variant
from lodestrom.plans.profile import percent

ISSUES = ("DUPLICATE_DEDUPED", "ORPHANED_ACCOUNT", "TYPE_MISMATCH", "DATE_FORMAT", "CURRENCY_VARIANT", "NULL_REQUIRED")
# Advisory rules: what they look at, and that they change nothing.
ADVISORY = (
    ("UNKNOWN_DOMAIN_VALUE", "value outside its closed domain"),
    ("CURRENCY_CONVERSION", "amount in another currency than the home currency"),
    ("COORDINATE_ANOMALY", "coordinates that are unreadable or out of place"),
    ("FUTURE_DATE", "date after the day of the run"),
    ("EXTREME_AMOUNT", "amount above the threshold"),
    ("AGE_OUT_OF_RANGE", "customer under 18 or over 110"),
    ("LIMIT_WITHOUT_CREDIT", "credit limit on an account that has no credit"),
    ("PROVINCE_MISMATCH", "transaction in another province than the customer's"),
)


def _transaction_issues(judged: DataFrame) -> DataFrame:
    valid = F.col("outcome") == "valid"
    kept = F.col("outcome") != "duplicate"
    marks: dict[str, tuple[Column, Column]] = {
        "DUPLICATE_DEDUPED": (F.col("outcome") == "duplicate", kept),
        "ORPHANED_ACCOUNT": (F.col("outcome") == "orphan", F.lit(False)),
        "TYPE_MISMATCH": (F.col("amount_quoted") | F.col("amount_unreadable"), valid & (F.col("dq_flag") == "TYPE_MISMATCH")),
        "DATE_FORMAT": (F.col("date_variant"), valid & (F.col("dq_flag") == "DATE_FORMAT")),
        "CURRENCY_VARIANT": (F.col("currency_variant"), valid & (F.col("dq_flag") == "CURRENCY_VARIANT")),
    }
    wide = judged.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(F.coalesce(p, F.lit(False))).alias(f"{k}_{side}") for k, pair in marks.items() for side, p in zip(("in", "out"), pair, strict=True)))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(k).alias("issue"), F.col(f"{k}_in").alias("affected"), F.col("rows").alias("denominator"), F.col(f"{k}_out").alias("output")) for k in marks))).alias("e")).select("e.*")


def issue_counts(judged: DataFrame, rejected_accounts: DataFrame) -> DataFrame:
    """``issue, affected, denominator, output, pct`` of the rows given alone: rows with the issue, rows it is measured against, rows
    of them that load. :func:`source_issues` counts over all three sources."""
    nulls = rejected_accounts.agg(F.lit("NULL_REQUIRED").alias("issue"), F.count_if(F.col("reason") == "NULL_REQUIRED").alias("affected"), F.count(F.lit(1)).alias("denominator"), F.lit(0).cast("long").alias("output"))
    return _with_percent(_transaction_issues(judged).unionByName(nulls))


def _with_percent(counts: DataFrame) -> DataFrame:
    return counts.withColumn("pct", percent(F.col("affected"), F.col("denominator")))


def source_issues(judged: DataFrame, customers: DataFrame, accounts: DataFrame, loaded_customers: DataFrame, loaded_accounts: DataFrame) -> DataFrame:
    """The same over whole sources: ``customers`` and ``accounts`` as they came in, and their rows that load.

    DATE_FORMAT counts the rows of all three sources with a date in another notation and is measured against all of them;
    NULL_REQUIRED is measured against all accounts; the other issues against the transactions.
    """
    n, none = F.count(F.lit(1)), F.lit(0).cast("long")
    dated = ((customers, loaded_customers, ("dob",)), (accounts, loaded_accounts, ("open_date", "last_activity_date")))
    parts = []
    for rows, loaded, columns in dated:
        variant = F.greatest(F.lit(False), *(is_date_variant(F.col(c)) for c in columns))
        parts.append(rows.agg(F.lit("DATE_FORMAT").alias("issue"), F.count_if(variant).alias("affected"), n.alias("denominator"), none.alias("output")))
        parts.append(loaded.agg(F.lit("DATE_FORMAT").alias("issue"), none.alias("affected"), none.alias("denominator"), F.count_if("date_variant").alias("output")))
    parts.append(accounts.agg(F.lit("NULL_REQUIRED").alias("issue"), F.count_if(identifier(F.col("account_id")).isNull()).alias("affected"), n.alias("denominator"), none.alias("output")))
    every = _transaction_issues(judged)
    for part in parts:
        every = every.unionByName(part)
    return _with_percent(every.groupBy("issue").agg(*(F.sum(c).alias(c) for c in ("affected", "denominator", "output"))))


def report(issues: list[dict[str, Any]], settings: Settings, counts: dict[str, int]) -> dict[str, Any]:
    """The data-quality report; issues that did not occur are left out."""
    listed = [{"issue_type": i["issue"], "records_affected": i["affected"], "percentage_of_total": i["pct"], "handling_action": settings.actions[i["issue"]], "records_in_output": i["output"]} for i in issues if i["affected"]]
    return {"record_counts": counts, "dq_issues": listed, "summary": {"total_issue_types": len(listed), "total_flagged_records": sum(i["records_affected"] for i in listed)}, "advisory_rules": [{"rule": r, "meaning": m} for r, m in ADVISORY]}


def to_json(document: dict[str, Any]) -> str:
    """The document as text; dates and decimals as strings."""
    return json.dumps(document, indent=2, sort_keys=True, default=str)


def reconcile(judged: DataFrame) -> DataFrame:
    """``outcome, n``: with the rejected ones this adds up to all rows, each counted once."""
    return judged.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
