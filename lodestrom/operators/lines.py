"""Rows that fail to parse: separated with the reason, while the valid rows load.

Each landing line gets the minimum-cost error parse of :mod:`lodestrom.functions.repair`. Lines whose parse is free - valid
in structure, with readable values - load; otherwise the cheapest edits state the reason.

Most lines are plain, and for these the free parse is a JVM expression: a CSV line without any quote or line break, whose
fields are what its commas separate, and a JSON line that a regular expression of flat or once nested objects accepts,
without escapes, repeated keys or numbers in other than plain notation. Both tests are sound: a line that passes them is
read the same way by the parser. Lines that fail them, or whose values are faulty, are spread over all tasks and parsed.

Defined results
---------------
* CSV faults, first match: ``bad_quoting``, ``column_count``, ``missing_value``, ``bad_number``. An empty or null line has
  one empty field: ``column_count``.
* JSON faults: ``bad_json`` (also null or empty lines), ``missing_value``, ``bad_number`` (also true, objects and arrays).
  Of a repeated key the last value counts. A value of another type than its column's loads as null, an amount apart.
* Lines of other files are neither loaded nor rejected: ``format_of`` decides by the end of the file's name, ignoring case.
* Repeated lines each come out. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrom import scratch
from lodestrom.functions.amounts import amount, is_blank, is_readable
from lodestrom.functions.repair import csv_parse, json_amount, json_parse

ACCOUNT_COLUMNS = ("account_id", "customer_ref", "account_type", "account_status", "open_date", "product_tier", "mobile_number", "digital_channel", "credit_limit", "current_balance", "last_activity_date")
TRANSACTION_COLUMNS = ("transaction_id", "account_id", "transaction_date", "transaction_time", "transaction_type", "merchant_category", "merchant_subcategory", "amount", "currency", "channel")
NESTED_COLUMNS = {"province": "location", "city": "location", "coordinates": "location", "device_id": "metadata", "session_id": "metadata"}
#: All columns that lines can load, as text; ``retry_flag`` is a boolean.
LOADED = tuple(dict.fromkeys((*ACCOUNT_COLUMNS, *TRANSACTION_COLUMNS, *NESTED_COLUMNS)))
LIMIT, BALANCE = ACCOUNT_COLUMNS.index("credit_limit"), ACCOUNT_COLUMNS.index("current_balance")
PARSED = "line_id long, fmt string, fault string, edits string, cost int, least boolean, " + ", ".join(f"{c} string" for c in LOADED) + ", retry_flag boolean"

# A JSON object that is surely valid: scalars, or objects of scalars, without escapes and with plain numbers.
_STR = r'"[^"\\\x00-\x1f]*+"'
_ATOM = rf"(?:{_STR}|-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?|true|false|null)"
_WS = r"[ \t\n\r]*+"


def _object(value: str) -> str:
    pair = rf"{_STR}{_WS}:{_WS}{value}{_WS}"
    return rf"\{{{_WS}(?:{pair}(?:,{_WS}{pair})*+)?\}}"


PLAIN_JSON = rf"^{_WS}{_object(f'(?:{_ATOM}|{_object(_ATOM)})')}{_WS}\z"


def format_of(file_name: Column) -> Column:
    name = F.lower(file_name)
    return F.when(name.endswith(".csv"), "csv").when(name.endswith(".jsonl") | name.endswith(".json"), "json")


def _text(value: Any) -> str | None:
    return str(value) if isinstance(value, str) else None


def _csv(line: str | None) -> dict[str, Any]:
    p = csv_parse(line or "", len(ACCOUNT_COLUMNS), {LIMIT: False, BALANCE: True})
    fault = "bad_quoting" if not p.valid else "column_count" if len(p.value) != len(ACCOUNT_COLUMNS) else None
    values = {} if fault else dict(zip(ACCOUNT_COLUMNS, p.value, strict=True))
    return {"fault": fault, "edits": "; ".join(p.edits), "cost": p.cost, "least": p.least} | values


def _json(line: str | None) -> dict[str, Any]:
    p = json_parse(line or "", exact=True)
    said = {"fault": None if p.valid else "bad_json", "edits": "; ".join(p.edits), "cost": p.cost, "least": p.least}
    if not p.valid:
        return said
    o = p.value
    inner = {c: o[parent].get(c) if isinstance(o.get(parent), dict) else None for c, parent in NESTED_COLUMNS.items()}
    meta = o.get("metadata")
    flag = meta.get("retry_flag") if isinstance(meta, dict) else None
    return said | {c: _text(o.get(c)) for c in TRANSACTION_COLUMNS} | {c: _text(v) for c, v in inner.items()} | {"amount": json_amount(o.get("amount")), "retry_flag": flag if isinstance(flag, bool) else None}


def _plain_csv(rows: DataFrame) -> DataFrame:
    fields = F.split("text", ",", -1)
    return rows.select("line_id", "fmt", "text", (F.size(fields) == len(ACCOUNT_COLUMNS)).alias("whole"), *(F.get(fields, i).alias(c) for i, c in enumerate(ACCOUNT_COLUMNS)))


def _member(text: Column, key: str) -> Column:
    """The value of a key of a plain object: a string without its quotes, or a scalar as written; null for null or none."""
    found = F.regexp_extract(text, rf'"{key}"{_WS}:{_WS}({_ATOM})', 1)
    return F.when((found != "") & (found != "null"), F.when(found.startswith('"'), F.substring(found, F.lit(2), F.length(found) - 2)).otherwise(found))


def parse_lines(lines: DataFrame, line_id: str = "line_id", file_name: str = "file_name", text: str = "line_text") -> DataFrame:
    """One row per CSV or JSON line: its structural fault, cost and edits, or its values as text."""

    def parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in PARSED.split(", ")]
        for f in frames:
            rows = [{"line_id": i, "fmt": k} | (_csv if k == "csv" else _json)(t) for i, k, t in zip(f["line_id"], f["fmt"], f["text"], strict=True)]
            yield pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names, dtype=object)

    kept = lines.select(F.col(line_id).cast("long").alias("line_id"), format_of(F.col(file_name)).alias("fmt"), F.col(text).alias("text")).where("fmt is not null")
    # keys that are loaded must stand once in a plain line, at their own level
    keys = [*TRANSACTION_COLUMNS, *NESTED_COLUMNS, "retry_flag"]
    named = F.regexp_extract_all("text", F.lit(rf'"({"|".join([*keys, "location", "metadata"])})"{_WS}:'), F.lit(1))
    inner = F.concat_ws("", F.regexp_extract_all("text", F.lit(r"(?<=.)(\{[^{}]*\})"), F.lit(1)))
    once = (F.size(named) == F.size(F.array_distinct(named))) & ~inner.rlike(rf'"(?:{"|".join(TRANSACTION_COLUMNS)})"{_WS}:')
    nested = {c: rf'"{parent}"{_WS}:{_WS}\{{[^{{}}]*"{c}"' for c, parent in NESTED_COLUMNS.items()}
    well = F.lit(True)
    for c, where in (nested | {"retry_flag": rf'"metadata"{_WS}:{_WS}\{{[^{{}}]*"retry_flag"'}).items():
        well = well & (~F.array_contains(named, c) | F.col("text").rlike(where))
    plain = F.coalesce(F.when(F.col("fmt") == "csv", ~F.col("text").rlike('["\r\n]')).otherwise(F.col("text").rlike(PLAIN_JSON) & once & well), F.lit(False))
    marked = scratch.materialise(kept.withColumn("plain", plain), "lines")
    of_csv = _plain_csv(marked.where("plain and fmt = 'csv'"))
    csv_good = of_csv["whole"] & value_fault(F.col("current_balance"), F.col("credit_limit")).isNull()
    of_json = marked.where("plain and fmt = 'json'").select("line_id", "fmt", "text", *(_member(F.col("text"), c).alias(c) for c in (*TRANSACTION_COLUMNS, *NESTED_COLUMNS, "retry_flag")))
    json_good = value_fault(F.col("amount")).isNull()
    other = [c for c in (*TRANSACTION_COLUMNS, *NESTED_COLUMNS) if c != "amount"]
    of_json = of_json.withColumns({c: F.when(~F.col(c).isin("true", "false") | F.col("text").rlike(rf'"{c}"{_WS}:{_WS}"'), F.col(c)) for c in other})
    of_json = of_json.withColumn("retry_flag", F.nullif(F.regexp_extract("text", rf'"retry_flag"{_WS}:{_WS}(true|false)', 1), F.lit("")).try_cast("boolean"))
    none = [F.lit(None).cast("string").alias("fault"), F.lit("").alias("edits"), F.lit(0).alias("cost"), F.lit(True).alias("least")]
    column = lambda df, c: (F.col(c) if c in df.columns else F.lit(None)).cast("boolean" if c == "retry_flag" else "string").alias(c)
    free = [df.where(good).select("line_id", "fmt", *none, *(column(df, c) for c in (*LOADED, "retry_flag"))) for df, good in ((of_csv, csv_good), (of_json, json_good))]
    rest = marked.where(~F.col("plain")).select("line_id", "fmt", "text")
    for df, good in ((of_csv, csv_good), (of_json, json_good)):
        rest = rest.unionByName(df.where(~good).select("line_id", "fmt", "text"))
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much work: not to be coalesced
    return free[0].unionByName(free[1]).unionByName(rest.repartition(tasks, "line_id").mapInPandas(parsed, PARSED))


def value_fault(main: Column, limit: Column | None = None) -> Column:
    """``missing_value`` or ``bad_number`` of a main amount and an optional limit (which may be blank), else null."""
    bad = ~is_readable(main)
    if limit is not None:
        bad = bad | (~is_blank(limit) & ~is_readable(limit))
    return F.when(is_blank(main), "missing_value").when(bad, "bad_number")


def _typed(c: str) -> Column:
    return amount(F.col(c)) if c in ("amount", "credit_limit", "current_balance") else F.col(c)


def split_lines(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(loaded, rejected)`` of the parsed lines; loaded rows are typed, rejected ones carry ``fault`` and ``reason``."""
    main = F.when(F.col("fmt") == "csv", F.col("current_balance")).otherwise(F.col("amount"))
    judged = parsed.withColumn("fault", F.coalesce("fault", value_fault(main, F.col("credit_limit"))))
    loaded = judged.where("fault is null").select("line_id", "fmt", *(_typed(c).alias(c) for c in LOADED), "retry_flag")
    return loaded, judged.where("fault is not null").select("line_id", "fmt", "fault", F.col("edits").alias("reason"), "cost", "least")


def value_faults(df: DataFrame, row_key: str, main: str, limit: str | None = None) -> DataFrame:
    """``row_id, fault`` of the loaded rows whose amounts cannot be read."""
    fault = value_fault(F.col(main), F.col(limit) if limit else None)
    return df.select(F.col(row_key).alias("row_id"), fault.alias("fault")).where("fault is not null")


def readable_rows(df: DataFrame, row_key: str, main: str, limit: str | None = None) -> DataFrame:
    """The rows of a table whose amounts can be read, typed, with the columns of :data:`LOADED` that the table has."""
    fine = df.where(value_fault(F.col(main), F.col(limit) if limit else None).isNull())
    for parent in dict.fromkeys(NESTED_COLUMNS.values()):
        if parent in df.columns:
            fine = fine.withColumns({f.name: F.col(f"{parent}.{f.name}") for f in df.schema[parent].dataType.fields if f.name in (*LOADED, "retry_flag")})
    return fine.select(F.col(row_key).cast("long").alias("row_id"), *(_typed(c).alias(c) for c in LOADED if c in fine.columns), *(["retry_flag"] if "retry_flag" in fine.columns else []))
