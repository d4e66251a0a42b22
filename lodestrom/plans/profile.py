"""The audit profile: one aggregate per table, cross-table checks, and top values, all in long form ``metric, n``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrom.config import Settings
from lodestrom.functions import currency, geo
from lodestrom.functions.amounts import amount as amount_of
from lodestrom.functions.keys import identifier
from lodestrom.functions.parse import is_blank, parse_date, parse_timestamp
from lodestrom.operators.frequency import domain_columns, invalid
from lodestrom.operators.joins import skew_safe_join

Metrics = dict[str, Column]


def long_form(df: DataFrame, metrics: Metrics) -> DataFrame:
    """Many named aggregates in one pass, one row each."""
    wide = df.agg(*(v.cast("bigint").alias(k) for k, v in metrics.items()))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), F.col(k).alias("n")) for k in metrics))).alias("e")).select("e.*")


def holds(p: Column) -> Column:
    """How many rows satisfy a predicate; null does not."""
    return F.count_if(F.coalesce(p, F.lit(False)))


def _blanks(*columns: str) -> Metrics:
    return {f"blank_{c.split('.')[-1]}": holds(is_blank(F.col(c))) for c in columns}


def _outside(table: str, settings: Settings) -> Metrics:
    return {f"invalid_{c}": holds(invalid(v, allowed)) for c, (v, allowed) in domain_columns(table, settings).items()}


def _unparsed(name: str, text: Column, parsed: Column) -> Metrics:
    return {f"{name}_unreadable": holds(~is_blank(text) & parsed.isNull())}


def _number(name: str) -> Column:
    return amount_of(F.col(name))


def transaction_metrics(settings: Settings) -> Metrics:
    amount, as_of = _number("amount"), F.lit(settings.as_of).cast("date")
    day = parse_date(F.col("transaction_date"))
    stamp = parse_timestamp(F.col("transaction_date"), F.col("transaction_time"))
    text = F.col("location.coordinates")
    found = geo.flags(text, F.col("location.province"), geo.latitude(text), geo.longitude(text), settings.check_province_boxes)
    cur = F.col("currency")
    return (
        {"rows": F.count(F.lit(1)), "distinct_transaction_ids": F.count_distinct(F.when(~is_blank(F.col("transaction_id")), F.trim("transaction_id")))}
        | _blanks("transaction_id", "account_id", "transaction_date", "transaction_time", "amount", "location.province", "merchant_subcategory", "location.coordinates")
        | _unparsed("amount", F.col("amount"), amount)
        | {"negative_amount": holds(amount < 0), "zero_amount": holds(amount == 0), "extreme_amount": holds(amount > F.lit(settings.extreme_amount))}
        | _unparsed("transaction_date", F.col("transaction_date"), day)
        | _unparsed("transaction_time", F.col("transaction_time"), stamp)
        | {"future_transaction_date": holds(day > as_of), "retry_flagged": holds(F.col("metadata.retry_flag"))}
        | _outside("transactions", settings)
        | {"currency_present": holds(~is_blank(cur)), "currency_variant": holds(currency.is_variant(cur))}
        | {k: holds(v.isNotNull() if k.endswith("candidate") else v) for k, v in currency.readiness_columns(cur).items() if k not in ("currency_raw", "currency_clean")}
        | {f"geo_{k.lower()}": holds(v) for k, v in found.items()}
    )


def account_metrics(settings: Settings) -> Metrics:
    opened, last, as_of = parse_date(F.col("open_date")), parse_date(F.col("last_activity_date")), F.lit(settings.as_of).cast("date")
    balance, limit, kind = _number("current_balance"), _number("credit_limit"), F.upper(F.trim("account_type"))
    return (
        {"rows": F.count(F.lit(1)), "distinct_account_ids": F.count_distinct(F.when(~is_blank(F.col("account_id")), F.trim("account_id")))}
        | _blanks("account_id", "customer_ref", "mobile_number")
        | _outside("accounts", settings)
        | _unparsed("open_date", F.col("open_date"), opened)
        | _unparsed("last_activity_date", F.col("last_activity_date"), last)
        | {"future_open_date": holds(opened > as_of), "activity_before_opening": holds(last < opened)}
        | _unparsed("current_balance", F.col("current_balance"), balance)
        | _unparsed("credit_limit", F.col("credit_limit"), limit)
        | {"negative_balance": holds(balance < 0), "extreme_balance": holds(F.abs(balance) > F.lit(settings.extreme_balance)), "negative_limit": holds(limit < 0)}
        | {"limit_without_credit": holds((kind != "CREDIT") & ~is_blank(F.col("credit_limit"))), "credit_without_limit": holds((kind == "CREDIT") & F.coalesce(limit <= 0, F.lit(True)))}
    )


def customer_metrics(settings: Settings) -> Metrics:
    dob, as_of = parse_date(F.col("dob")), F.lit(settings.as_of).cast("date")
    years = F.floor(F.months_between(as_of, dob) / 12)
    risk = F.col("risk_score").try_cast("int")
    return (
        {"rows": F.count(F.lit(1)), "distinct_customer_ids": F.count_distinct(F.when(~is_blank(F.col("customer_id")), F.trim("customer_id")))}
        | _blanks("customer_id", "id_number", "first_name", "last_name", "product_flags")
        | _outside("customers", settings)
        | _unparsed("dob", F.col("dob"), dob)
        | {"future_dob": holds(dob > as_of), "under_18": holds(years < 18), "over_110": holds(years > 110)}
        | _unparsed("risk_score", F.col("risk_score"), risk)
        | {"risk_score_out_of_range": holds(~risk.between(1, 10))}
    )


def with_share(counts: DataFrame, total: str = "rows") -> DataFrame:
    """``metric, n, pct`` of counted metrics, measured against the one named ``total``, which is left out; 0.0 of nothing."""
    of = F.max(F.when(F.col("metric") == total, F.col("n"))).over(Window.partitionBy(F.lit(0)))  # one row a metric
    shared = counts.withColumn("pct", percent(F.col("n"), of))
    return shared.where(F.col("metric") != total)


def percent(n: Column, of: Column) -> Column:
    """``n`` in percent of ``of``, to two places; 0.0 of nothing."""
    return F.coalesce(F.round(F.try_divide(n * F.lit(100.0), of), 2), F.lit(0.0))


def quantiles(df: DataFrame, value: Column, accuracy: int, points: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """``point, value`` by a mergeable sketch; exact while the rows stay below the accuracy."""
    sketch = df.agg(F.percentile_approx(value, list(points), accuracy).alias("q"))
    return sketch.select(F.explode(F.arrays_zip(F.array(*map(F.lit, points)).alias("point"), F.col("q").alias("value"))).alias("e")).select("e.*")


def unknown_references(child: DataFrame, parent: DataFrame, ref: str, key: str) -> DataFrame:
    """Rows whose reference no parent bears; identifiers compare by letters and digits."""
    keys = parent.select(identifier(F.col(key)).alias("_ref")).where("_ref is not null").distinct()
    return skew_safe_join(child.withColumn("_ref", identifier(F.col(ref))).where("_ref is not null"), keys, "_ref", "left_anti").drop("_ref")


def province_mismatches(transactions: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions whose stated province differs from their customer's (compared in upper case; identifiers by letters and
    digits). Of several homes of one account the first by name is meant, so that the result can be repeated."""
    owners = customers.select(identifier(F.col("customer_id")).alias("_ref"), F.upper(F.trim("province")).alias("home")).where("_ref is not null").groupBy("_ref").agg(F.min("home").alias("home"))
    held = accounts.select(identifier(F.col("account_id")).alias("_account"), identifier(F.col("customer_ref")).alias("_ref")).where("_account is not null and _ref is not null").distinct()
    one = held.join(owners, "_ref").groupBy("_account").agg(F.min("home").alias("home"))
    stated = transactions.withColumns({"stated": F.upper(F.trim("location.province")), "_account": identifier(F.col("account_id"))}).where("stated <> ''")
    return skew_safe_join(stated, one, "_account", "inner").where("stated <> home").drop("_account")


def dense_patterns(transactions: DataFrame, keys: list[str], least: int) -> DataFrame:
    """How many groups repeat at least ``least`` times, and the largest group. A key named ``*_id`` is compared as an identifier."""
    groups = transactions.groupBy(*((identifier(F.col(k)) if k.endswith("_id") else F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.count_if(F.col("n") >= least).alias("groups_at_threshold"), F.coalesce(F.max("n"), F.lit(0)).alias("largest_group"))
