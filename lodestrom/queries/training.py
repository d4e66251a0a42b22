"""The general training-data problems 1 to 7 over the project's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrom import scratch
from lodestrom.functions.amounts import amount
from lodestrom.functions.coordinates import letters_only, with_points
from lodestrom.functions.keys import identifier
from lodestrom.operators import delivery, instants, lateness, lines, proximity, references, rolling
from lodestrom.queries import statements
from lodestrom.operators.joins import broadcast_if_small, skew_safe_join
from lodestrom.streaming import corrections

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "transactions").where("location.coordinates is not null")
    rows = rows.select("row_id", letters_only(F.col("location.province")).alias("stated"), F.col("location.coordinates").alias("written"))
    points = scratch.materialise(with_points(rows, F.col("written")).drop("written"), "points")
    places = table(spark, sf_dir, "places")
    sites = places.where("place_kind = 'site'").select("place_id", F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"), "radius_m")
    near = proximity.points_near(points, sites).select("row_id", "place_id")
    areas = places.where("place_kind in ('zone', 'province')").select("place_id", F.col("boundary").alias("ring"))
    labels = places.where("place_kind = 'province'").select("place_id", letters_only(F.col("place_label")).alias("label")).dropDuplicates(["place_id"])
    inside = proximity.points_in_regions(points, areas)
    inside = inside.join(broadcast_if_small(labels), "place_id", "left")
    told = inside.where(F.col("label").isNull() | F.coalesce(F.col("stated") != F.col("label"), F.lit(True)))
    return near.unionByName(told.select("row_id", "place_id")).select(F.col("row_id").cast("bigint").alias("row_id"), "place_id")


def p2_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``entity`` (account in plain form), ``day``, ``total``, ``n`` of the rows that count once."""
    rows = table(spark, sf_dir, "transactions")
    gone = scratch.materialise(delivery.surplus_deliveries(rows).withColumnRenamed("row_key", "row_id"), "surplus")
    counted = rows.select("row_id", identifier(F.col("account_id")).alias("key"), "transaction_date", "transaction_time", amount(F.col("amount")).alias("amount")).where("key is not null and amount is not null and transaction_date is not null")
    dated = instants.normalise_instants(counted, "transaction_date", "transaction_time", source="transactions").where("instant is not null")
    once = skew_safe_join(dated.select("row_id", "key", "instant_date", "amount"), gone, "row_id", "left_anti")
    daily = rolling.daily_totals(once, "key", "instant_date", "amount")
    owners = table(spark, sf_dir, "accounts").select(identifier(F.col("account_id")).alias("entity"), "account_id").where("entity is not null").groupBy("entity").agg(F.min("account_id").alias("account_id"))
    # daily rows of one account are at most as many as the days of the calendar: no skew is left here
    return daily.join(owners, "entity").select(F.col("account_id").alias("entity"), "day", "total", "n")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    trailing = rolling.trailing_totals(p2_amounts(spark, sf_dir), (7, 30))
    found = rolling.surges_and_lulls(trailing)
    return found.select(F.col("entity").alias("account_id"), F.date_format("day", "yyyy-MM-dd").alias("on_day"), "pattern")


def p2_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and averages over 7 and 30 days of every account and every day of its calendar, idle days too."""
    trailing = rolling.trailing_totals(p2_amounts(spark, sf_dir), (7, 30))
    return trailing.select(F.col("entity").alias("account_id"), F.date_format("day", "yyyy-MM-dd").alias("on_day"), "total_7", "mean_7", "total_30", "mean_30")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts, customers = table(spark, sf_dir, "accounts"), table(spark, sf_dir, "customers")
    parts = {
        "transactions": references.find_orphans(table(spark, sf_dir, "transactions"), accounts, "account_id", "ingested_at", "row_id", "account_id"),
        "accounts": references.find_orphans(accounts, customers, "customer_ref", "loaded_at", "row_id", "customer_id"),
    }
    found = [f.select(F.lit(t).alias("src_table"), F.date_format("at", "yyyy-MM").alias("ref_month"), F.col("row_id").cast("bigint").alias("row_id"), "orphan_type") for t, f in parts.items()]
    return found[0].unionByName(found[1])


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.orphan_report(p3_found(spark, sf_dir))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = lines.split_lines(lines.parse_lines(table(spark, sf_dir, "raw_lines")))
    parts = {
        "raw_lines": rejected.select(F.col("line_id").alias("row_id"), "fault"),
        "transactions": lines.value_faults(table(spark, sf_dir, "transactions"), "row_id", "amount"),
        "accounts": lines.value_faults(table(spark, sf_dir, "accounts"), "row_id", "current_balance", "credit_limit"),
    }
    found = [f.select(F.lit(t).alias("src_table"), F.col("row_id").cast("bigint").alias("row_id"), "fault") for t, f in parts.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


def p4_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing lines that do not load, with the fault, the cheapest edits that would mend it, and their number."""
    rejected = lines.split_lines(lines.parse_lines(table(spark, sf_dir, "raw_lines")))[1]
    return rejected.select("line_id", "fmt", "fault", "reason", "cost", "least")


def p4_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What loads of all three sources, typed, with all their columns."""
    loaded = lines.split_lines(lines.parse_lines(table(spark, sf_dir, "raw_lines")))[0]
    parts = {
        "raw_lines": loaded.drop("fmt").withColumnRenamed("line_id", "row_id"),
        "transactions": lines.readable_rows(table(spark, sf_dir, "transactions"), "row_id", "amount"),
        "accounts": lines.readable_rows(table(spark, sf_dir, "accounts"), "row_id", "current_balance", "credit_limit"),
    }
    whole = [df.withColumn("src_table", F.lit(t)) for t, df in parts.items()]
    return whole[0].unionByName(whole[1], allowMissingColumns=True).unionByName(whole[2], allowMissingColumns=True)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.surplus_deliveries(table(spark, sf_dir, "transactions")).select(F.col("row_key").alias("row_id"))


def _streamed(spark: SparkSession, sf_dir: str) -> corrections.CorrectionStream:
    return corrections.replay(table(spark, sf_dir, "recent_transactions"), "transaction_id", "transaction_timestamp", "updated_at", "account_id", "amount")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = _streamed(spark, sf_dir).records().where("verdict in ('late', 'too_late') and record is not null").select(F.lit("recent_transactions").alias("src_table"), F.col("record").alias("record_id"), "verdict")
    stale = lateness.stale_states(table(spark, sf_dir, "current_balances"), table(spark, sf_dir, "recent_transactions"), "account_id", "last_transaction_timestamp", "updated_at", "transaction_timestamp", "updated_at")
    return late.unionByName(stale.select(F.lit("current_balances").alias("src_table"), F.col("key").alias("record_id"), F.lit("stale").alias("verdict")))


def p6_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corrected daily totals per account after all upserts."""
    state = _streamed(spark, sf_dir).totals()
    return state.select(F.col("key").alias("account_id"), F.date_format("period_start", "yyyy-MM-dd").alias("event_day"), F.col("revision").cast("bigint").alias("revision"), "n", F.col("total").cast("decimal(28,2)").alias("total"))


def p6_diverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came too late, per event day and account."""
    gone = _streamed(spark, sf_dir).diverted()
    return gone.groupBy(F.date_format("event", "yyyy-MM-dd").alias("event_day"), F.col("c_key").alias("account_id")).agg(F.count(F.lit(1)).alias("n"), F.sum("c_amount").cast("decimal(28,2)").alias("total"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stamp of both tables is normalised; those written in the normal form already are left out of the result."""
    dictionary = instants.StampDictionary(spark)
    rows = table(spark, sf_dir, "transactions").select("row_id", "transaction_date", "transaction_time")
    stamped = instants.normalise_instants(rows, "transaction_date", "transaction_time", source="transactions", dictionary=dictionary).where("instant is not null")
    stamped = stamped.where(instants.not_plain(F.col("transaction_date"), F.col("transaction_time")))
    parts = [stamped.select(F.lit("transactions").alias("src_table"), "row_id", F.lit("transaction_ts").alias("col_name"), F.date_format("instant", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("norm_text"))]
    accounts = table(spark, sf_dir, "accounts").select("row_id", F.explode(F.array(*(F.struct(F.lit(c).alias("col_name"), F.col(c).alias("raw")) for c in ("open_date", "last_activity_date")))).alias("v")).select("row_id", "v.*")
    dated = instants.normalise_instants(accounts, "raw", source="accounts", dictionary=dictionary).where("instant_date is not null").where(instants.not_plain(F.col("raw")))
    parts.append(dated.select(F.lit("accounts").alias("src_table"), "row_id", "col_name", F.date_format("instant_date", "yyyy-MM-dd").alias("norm_text")))
    return parts[0].unionByName(parts[1]).withColumn("row_id", F.col("row_id").cast("bigint"))


def p7_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many distinct texts the dictionary holds after the earlier and after the later half of the rows: the second load
    parses only what is new."""
    rows = table(spark, sf_dir, "transactions").select("row_id", "transaction_date", "transaction_time")
    middle = rows.agg(F.floor((F.min("row_id") + F.max("row_id")) / 2).alias("m")).first()["m"]
    path, found = scratch.new_path(spark, "stamp-dictionary"), []
    for half in (F.col("row_id") <= middle, F.col("row_id") > middle):
        dictionary = instants.StampDictionary(spark, path)  # opened anew for each load
        instants.normalise_instants(rows.where(half), "transaction_date", "transaction_time", source="transactions", dictionary=dictionary)
        found.append({r["role"]: r["count"] for r in dictionary.table().groupBy("role").count().collect()})  # one row a role
    return spark.createDataFrame([(role, found[0].get(role, 0), n) for role, n in found[1].items()], "role string, first_load long, both_loads long")


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p2_found, p2_totals, p3_found, p3_report, p4_found, p4_rejected, p4_loaded, p5_found, p6_found, p6_daily, p6_diverted, p7_found, p7_dictionary)}

_ID = "nullif(lower(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]', '', 'g')), '')".format

_P3 = f"""
WITH r AS (
  SELECT 'transactions' AS src_table, row_id, {_ID('account_id')} AS k, ingested_at AS t FROM transactions
  UNION ALL SELECT 'accounts', row_id, {_ID('customer_ref')}, loaded_at FROM accounts),
p AS (
  SELECT 'transactions' AS src_table, {_ID('account_id')} AS k, loaded_at, removed_at FROM accounts
  UNION ALL SELECT 'accounts', {_ID('customer_id')}, loaded_at, removed_at FROM customers),
j AS (
  SELECT r.src_table, r.row_id, r.t, count(p.k) AS n, min(p.loaded_at) AS first_loaded,
    coalesce(bool_or(p.loaded_at <= r.t AND (p.removed_at IS NULL OR p.removed_at > r.t)), false) AS live
  FROM r LEFT JOIN p ON r.src_table = p.src_table AND r.k = p.k WHERE r.k IS NOT NULL GROUP BY ALL)
SELECT src_table, strftime(t AT TIME ZONE 'UTC', '%Y-%m') AS ref_month, row_id,
  CASE WHEN n = 0 THEN 'missing' WHEN first_loaded > t THEN 'late' ELSE 'deleted' END AS orphan_type
FROM j WHERE NOT live"""

_FIRST = """
SELECT transaction_id, arg_min(transaction_timestamp, updated_at) AS event, min(updated_at) AS arrival,
  arg_min(account_id, updated_at) AS account_id, arg_min(amount, updated_at) AS amount
FROM recent_transactions WHERE transaction_id IS NOT NULL GROUP BY 1"""

_TEXTS = " UNION ALL ".join(f"SELECT '{r}' AS role, row_id, {c} AS t FROM transactions WHERE {p}" for r, c, p in (("date", "transaction_date", "transaction_date IS NOT NULL"), ("time", "transaction_time", "NOT regexp_full_match(coalesce(transaction_time, ''), '\\s*')")))

_READABLE = "[ \\t]*[+-]?[0-9]{1,16}(\\.[0-9]{1,2})?[ \\t]*"


def _fault(main: str, limit: str | None = None) -> str:
    blank = "regexp_full_match(coalesce({}, ''), '\\s*')".format
    bad = f"NOT regexp_full_match({main}, '{_READABLE}')" + (f" OR (NOT {blank(limit)} AND NOT regexp_full_match({limit}, '{_READABLE}'))" if limit else "")
    return f"CASE WHEN {blank(main)} THEN 'missing_value' WHEN {bad} THEN 'bad_number' END"


def _number(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '{_READABLE}') THEN CAST(trim(translate({c}, chr(9), ' ')) AS DECIMAL(18,2)) END"


_FIELD = '("(?:[^"]|"")*"|[^",\\r\\n]*)'
_UNQUOTED = "CASE WHEN x[1] = chr(34) THEN replace(x[2 : len(x) - 1], chr(34) || chr(34), chr(34)) ELSE x END"
# CSV lines by a regular expression of whole records; JSON lines by DuckDB's reader, less what it allows beyond RFC 8259
_P4_LINES = f"""
c AS (SELECT line_id, coalesce(line_text, '') AS t, list_transform(regexp_extract_all(coalesce(line_text, '') || ',', '{_FIELD},', 1), lambda x: {_UNQUOTED}) AS f FROM raw_lines WHERE file_name = 'accounts.csv'),
cj AS (SELECT *, CASE WHEN NOT regexp_full_match(t, '{_FIELD}(?:,{_FIELD})*') THEN 'bad_quoting' WHEN len(f) <> 11 THEN 'column_count' ELSE {_fault('f[10]', 'f[9]')} END AS fault FROM c),
j AS (SELECT line_id, CASE WHEN json_valid(line_text) AND json_type(line_text) = 'OBJECT' AND NOT regexp_matches(line_text, ',\\s*[}}\\]]|[:,\\[]\\s*-?(?i:nan|inf)') THEN line_text END AS o FROM raw_lines WHERE file_name = 'transactions.jsonl'),
jj AS (SELECT *, CASE WHEN o IS NULL THEN 'bad_json' WHEN json_type(o, '$.amount') IN ('OBJECT', 'ARRAY', 'BOOLEAN') THEN 'bad_number' ELSE {_fault("(o ->> '$.amount')")} END AS fault FROM j)"""

_ACCOUNT = ("account_id", "customer_ref", "account_type", "account_status", "open_date", "product_tier", "mobile_number", "digital_channel", "credit_limit", "current_balance", "last_activity_date")
_TRANSACTION = ("transaction_id", "account_id", "transaction_date", "transaction_time", "transaction_type", "merchant_category", "merchant_subcategory", "amount", "currency", "channel")


def _columns(source: dict[str, str]) -> str:
    """The columns of p4_loaded; ``source`` says how those that a source has are read."""
    money = ("amount", "credit_limit", "current_balance")
    every = dict.fromkeys((*_ACCOUNT, *_TRANSACTION, *lines.NESTED_COLUMNS, "retry_flag"))
    return ", ".join(f"{(_number(source[c]) if c in money else source[c]) if c in source else 'CAST(NULL AS ' + ('DECIMAL(18,2)' if c in money else 'BOOLEAN' if c == 'retry_flag' else 'VARCHAR') + ')'} AS {c}" for c in every)


_IN_JSON = {c: f"(o ->> '$.{c}')" for c in _TRANSACTION} | {c: f"(o ->> '$.{p}.{c}')" for c, p in lines.NESTED_COLUMNS.items()} | {"retry_flag": "CAST((o ->> '$.metadata.retry_flag') AS BOOLEAN)"}
_IN_TABLE = {c: c for c in _TRANSACTION} | {c: f"{p}.{c}" for c, p in lines.NESTED_COLUMNS.items()} | {"retry_flag": "metadata.retry_flag"}

ORACLES: dict[str, str] = {
    "p1_found": statements.P1,
    "p2_found": statements.P2,
    "p2_totals": statements.P2_TOTALS,
    "p7_found": statements.P7,
    "p4_found": f"""WITH {_P4_LINES}
SELECT 'raw_lines' AS src_table, line_id AS row_id, fault FROM cj WHERE fault IS NOT NULL UNION ALL SELECT 'raw_lines', line_id, fault FROM jj WHERE fault IS NOT NULL
UNION ALL SELECT 'transactions', row_id, {_fault('amount')} AS fault FROM transactions WHERE fault IS NOT NULL
UNION ALL SELECT 'accounts', row_id, {_fault('current_balance', 'credit_limit')} AS fault FROM accounts WHERE fault IS NOT NULL""",
    "p4_loaded": f"""WITH {_P4_LINES}
SELECT 'raw_lines' AS src_table, line_id AS row_id, {_columns({c: f'f[{i}]' for i, c in enumerate(_ACCOUNT, 1)})} FROM cj WHERE fault IS NULL
UNION ALL SELECT 'raw_lines', line_id, {_columns(_IN_JSON)} FROM jj WHERE fault IS NULL
UNION ALL SELECT 'transactions', row_id, {_columns(_IN_TABLE)} FROM transactions WHERE {_fault('amount')} IS NULL
UNION ALL SELECT 'accounts', row_id, {_columns({c: c for c in _ACCOUNT})} FROM accounts WHERE {_fault('current_balance', 'credit_limit')} IS NULL""",
    "p7_dictionary": f"WITH t AS ({_TEXTS}), m AS (SELECT floor((min(row_id) + max(row_id)) / 2) AS m FROM transactions) SELECT role, count(DISTINCT t) FILTER (WHERE row_id <= m) AS first_load, count(DISTINCT t) AS both_loads FROM t, m GROUP BY 1",
    "p3_found": _P3,
    "p3_report": f"SELECT src_table, ref_month, orphan_type, count(*) AS n FROM ({_P3}) GROUP BY 1, 2, 3",
    "p5_found": f"SELECT row_id FROM (SELECT row_id, {_ID('transaction_id')} AS k, row_number() OVER (PARTITION BY {_ID('transaction_id')} ORDER BY ingested_at, row_id) AS rn FROM transactions) WHERE k IS NOT NULL AND rn > 1",
    "p6_found": f"""
WITH f AS ({_FIRST}),
e AS (SELECT *, date_trunc('day', event AT TIME ZONE 'UTC') + INTERVAL 1 DAY AS closes, arrival AT TIME ZONE 'UTC' AS a FROM f)
SELECT 'recent_transactions' AS src_table, transaction_id AS record_id, CASE WHEN a <= closes + INTERVAL 48 HOUR THEN 'late' ELSE 'too_late' END AS verdict
FROM e WHERE a >= closes
UNION ALL
SELECT 'current_balances', account_id, 'stale' FROM (
  SELECT b.account_id, b.last_transaction_timestamp AS said, max(r.transaction_timestamp) AS latest
  FROM current_balances b JOIN recent_transactions r ON r.account_id = b.account_id AND r.updated_at <= b.updated_at GROUP BY 1, 2, b.updated_at)
WHERE said IS DISTINCT FROM latest""",
    "p6_diverted": f"""
WITH f AS ({_FIRST}),
e AS (SELECT *, date_trunc('day', event AT TIME ZONE 'UTC') AS d, arrival AT TIME ZONE 'UTC' AS a FROM f)
SELECT strftime(d, '%Y-%m-%d') AS event_day, account_id, count(*) AS n, CAST(sum(amount) AS DECIMAL(28,2)) AS total FROM e WHERE a > d + INTERVAL 3 DAY GROUP BY 1, 2""",
    "p6_daily": f"""
WITH f AS ({_FIRST}),
e AS (SELECT *, date_trunc('day', event AT TIME ZONE 'UTC') AS d, arrival AT TIME ZONE 'UTC' AS a FROM f)
SELECT account_id, strftime(d, '%Y-%m-%d') AS event_day, count(DISTINCT date_trunc('day', greatest(a, d))) AS revision, count(*) AS n, CAST(sum(amount) AS DECIMAL(28,2)) AS total
FROM e WHERE a <= d + INTERVAL 3 DAY GROUP BY 1, 2""",
}
