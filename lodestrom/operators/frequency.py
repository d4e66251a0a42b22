"""Unpivot, value frequencies, top-k, domain metrics and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrom.config import COLUMN_PATHS, Settings
from lodestrom.functions.currency import clean_currency
from lodestrom.functions.parse import is_blank


def unpivot(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """``field, value`` of the chosen expressions, one row each, in one scan."""
    return df.select(F.explode(F.array(*(F.struct(F.lit(k).alias("field"), v.cast("string").alias("value")) for k, v in fields.items()))).alias("e")).select("e.*")


def frequencies(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    return unpivot(df, fields).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, fields: dict[str, Column], k: int = 5, nulls: bool = True) -> DataFrame:
    """The k most frequent values of each field, with or without nulls; ties by value. Counting comes first, so the window
    sees distinct values only."""
    counted = frequencies(df, fields)
    order = Window.partitionBy("field").orderBy(F.col("n").desc(), F.col("value").asc_nulls_first())
    return (counted if nulls else counted.where("value is not null")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def known(value: Column, allowed: tuple[str, ...]) -> Column:
    return F.upper(F.trim(value)).isin(*allowed)


def invalid(value: Column, allowed: tuple[str, ...]) -> Column:
    """Not blank and outside the domain. Never null."""
    return ~is_blank(value) & ~F.coalesce(known(value, allowed), F.lit(False))


def domain_columns(table: str, settings: Settings) -> dict[str, tuple[Column, tuple[str, ...]]]:
    """The value expression and allowed values of each of a table's domains."""
    found = {}
    for name, allowed in settings.domains.items():
        owner, column = name.split(".", 1)
        if owner == table:
            value = F.col(COLUMN_PATHS.get(name, column))
            found[column] = (clean_currency(value) if column == "currency" else value, allowed)
    return found


def domain_metrics(df: DataFrame, table: str, settings: Settings, exact: bool = False) -> DataFrame:
    """One row per domain field: rows, present, unknown, distinct values and distinct unknown values, in one scan."""
    parts, names = [], []
    for column, (value, allowed) in domain_columns(table, settings).items():
        clean = F.when(~is_blank(value), F.upper(F.trim(value)))
        strange = F.when(invalid(value, allowed), F.upper(F.trim(value)))
        distinct = F.count_distinct if exact else (lambda c: F.approx_count_distinct(c, 0.05))
        parts += [F.count(clean).alias(f"{column}_present"), F.count(strange).alias(f"{column}_unknown"), distinct(clean).alias(f"{column}_distinct"), distinct(strange).alias(f"{column}_unknown_distinct")]
        names.append(column)
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *parts)
    one = lambda c: F.struct(F.lit(f"{table}.{c}").alias("field"), "rows", *(F.col(f"{c}_{p}").alias(p) for p in ("present", "unknown", "distinct", "unknown_distinct")))
    return wide.select(F.explode(F.array(*map(one, names))).alias("e")).select("e.*")


def drift(metrics: DataFrame, settings: Settings) -> DataFrame:
    """``metrics`` with ``high_cardinality`` and whether a review of unknown values is suggested."""
    # fixed rule: so many unknown values, or at least three that make up so large a share of all values
    threshold = F.lit(settings.high_cardinality)
    for name, own in settings.domain_thresholds.items():  # a domain's own threshold
        threshold = F.when(F.col("field") == name, own).otherwise(threshold)
    many = (F.col("unknown_distinct") >= threshold) | ((F.col("unknown_distinct") >= 3) & (F.try_divide("unknown_distinct", "distinct") >= settings.high_cardinality_ratio))
    marked = metrics.withColumn("high_cardinality", F.coalesce(many, F.lit(False)))
    return marked.withColumn("review", (F.col("unknown") > 0) & ~F.col("high_cardinality"))


def top_unknown(df: DataFrame, table: str, settings: Settings) -> DataFrame:
    """The most frequent values outside their domain, per field."""
    strange = {c: F.when(invalid(v, a), F.upper(F.trim(v))) for c, (v, a) in domain_columns(table, settings).items()}
    return top_values(df, strange, settings.top_k, nulls=False)


def suggestions(df: DataFrame, table: str, settings: Settings) -> DataFrame:
    """``field, value, n, suggestion``: unknown values to review, for the fields that do not drift with high cardinality."""
    marked = drift(domain_metrics(df, table, settings, exact=True), settings).where("review").select("field")
    found = top_unknown(df, table, settings).withColumn("field", F.concat(F.lit(f"{table}."), "field"))
    text = F.concat_ws(" ", F.lit("review"), F.concat(F.lit("'"), "value", F.lit("'")), F.lit("as a value of"), "field", F.concat(F.lit("("), F.col("n").cast("string"), F.lit(" rows)")))
    return found.join(F.broadcast(marked), "field").select("field", "value", "n", text.alias("suggestion"))  # one row a field
