"""Queries over the banking feed: parsing, quality, dimensional build, profile, states, buckets, streaming, validation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrom import scratch
from lodestrom.config import COUNTRY_BOX, DOMAINS, PROVINCE_BOXES, Settings, load_settings
from lodestrom.functions import currency, geo
from lodestrom.functions.amounts import amount as readable_amount
from lodestrom.functions.keys import identifier
from lodestrom.operators.ranks import rank_key
from lodestrom.functions.parse import age_band, is_blank, is_date_variant, is_quoted_amount, parse_date, parse_timestamp
from lodestrom.operators import dedupe, frequency, references, states
from lodestrom.plans import buckets, medallion, profile, quality, runner, validate
from lodestrom.sources import files
from lodestrom.sources.store import Store
from lodestrom.streaming import feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Operators of the survey's inventory that a query covers.
COVERS: dict[str, str] = {}
SETTINGS = Settings()


def query(covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__], COVERS[f.__name__] = f, covers
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- SQL fragments
def _id(c: str) -> str:
    return f"nullif(lower(regexp_replace({c}, '[^\\p{{L}}\\p{{N}}]', '', 'g')), '')"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


def _date(c: str) -> str:
    s = f"trim({c})"
    number = "[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?"
    epoch = f"CASE WHEN regexp_full_match({s}, '[0-9]{{13}}') THEN floor(CAST({s} AS BIGINT) / 1000) WHEN regexp_full_match({s}, '{number}') THEN trunc(TRY_CAST({s} AS DOUBLE)) END"
    return (
        f"CASE WHEN regexp_full_match({s}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN CAST(try_strptime({s}, '%Y-%m-%d') AS DATE)"
        f" WHEN regexp_full_match({s}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') THEN CAST(try_strptime({s}, '%d/%m/%Y') AS DATE)"
        f" WHEN ({epoch}) BETWEEN -62135596800 AND 253402300799 THEN CAST(make_timestamp(CAST(({epoch}) AS BIGINT) * 1000000) AS DATE) END"
    )


def _stamp(d: str, t: str) -> str:
    clock = f"coalesce(trim({t}), '00:00:00')"
    return f"CASE WHEN regexp_full_match({clock}, '([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]') THEN try_strptime(strftime({_date(d)}, '%Y-%m-%d') || ' ' || {clock}, '%Y-%m-%d %H:%M:%S') END"


def _variant(c: str) -> str:
    return f"coalesce({c} IS NOT NULL AND NOT regexp_full_match(trim({c}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}'), false)"


def _amount(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[ \\t]*[+-]?[0-9]{{1,16}}(\\.[0-9]{{1,2}})?[ \\t]*') THEN CAST(trim(translate({c}, chr(9), ' ')) AS DECIMAL(18,2)) END"


def _clean(c: str) -> str:
    return f"CASE WHEN upper(trim({c})) IN ('ZAR', 'R', 'RANDS', '710') THEN 'ZAR' ELSE upper(trim({c})) END"


def _alias(c: str) -> str:
    return f"coalesce(upper(trim({c})) IN ('R', 'RANDS', '710'), false)"


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _long(source: str, metrics: dict[str, str]) -> str:
    """Metrics given as predicates (counted) or as ``=expression``."""
    parts = [f"SELECT '{k}' AS metric, CAST({v[1:] if v[0] == '=' else f'count(*) FILTER (WHERE {v})'} AS BIGINT) AS n FROM s" for k, v in metrics.items()]
    return f"WITH s AS MATERIALIZED ({source}) " + " UNION ALL ".join(parts)


# --- parsing and normalisation
DATES_SQL = f"SELECT row_id, {_date('open_date')} AS opened, {_date('last_activity_date')} AS active, {_variant('open_date')} AS opened_variant, {_variant('last_activity_date')} AS active_variant FROM accounts"


@query("PAR1 FLT7 PRJ7", DATES_SQL)
def dates_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "accounts")
    return a.select("row_id", parse_date(F.col("open_date")).alias("opened"), parse_date(F.col("last_activity_date")).alias("active"), is_date_variant(F.col("open_date")).alias("opened_variant"), is_date_variant(F.col("last_activity_date")).alias("active_variant"))


@query("PAR2", f"SELECT row_id, {_stamp('transaction_date', 'transaction_time')} AS at FROM transactions")
def timestamps_composed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "transactions").select("row_id", parse_timestamp(F.col("transaction_date"), F.col("transaction_time")).cast("timestamp_ntz").alias("at"))


@query(
    "PAR3 FLT8 CUR1 CUR2 CUR3 CUR4 CUR5 CUR6 PRJ4",
    f"""SELECT row_id, currency AS currency_raw, {_clean('currency')} AS currency_clean, {_alias('currency')} AS variant,
    CASE WHEN regexp_full_match(upper(trim(currency)), '[A-Z]{{3}}') THEN upper(trim(currency)) END AS currency_iso_candidate,
    CASE WHEN regexp_full_match(upper(trim(currency)), '[0-9]{{3}}') THEN upper(trim(currency)) END AS currency_numeric_candidate,
    coalesce(NOT {_blank('currency')} AND {_clean('currency')} <> 'ZAR', false) AS currency_conversion_required,
    coalesce(NOT {_blank('currency')} AND {_clean('currency')} <> 'ZAR' AND regexp_full_match(upper(trim(currency)), '[A-Z]{{3}}|[0-9]{{3}}'), false) AS currency_conversion_ready,
    coalesce(NOT {_blank('currency')} AND {_clean('currency')} <> 'ZAR' AND NOT regexp_full_match(upper(trim(currency)), '[A-Z]{{3}}|[0-9]{{3}}'), false) AS currency_unknown FROM transactions""",
)
def currency_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "transactions")
    return t.select("row_id", *(v.alias(k) for k, v in currency.readiness_columns(F.col("currency")).items()), currency.is_variant(F.col("currency")).alias("variant"))


_GEO = """SELECT row_id, location.coordinates AS c, upper(trim(location.province)) AS p,
  CASE WHEN len(string_split(location.coordinates, ',')) = 2 THEN TRY_CAST(string_split(location.coordinates, ',')[1] AS DOUBLE) END AS lat,
  CASE WHEN len(string_split(location.coordinates, ',')) = 2 THEN TRY_CAST(string_split(location.coordinates, ',')[2] AS DOUBLE) END AS lon FROM transactions"""
_KNOWN = "(lat IS NOT NULL AND lon IS NOT NULL)"
_WORLD = "(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180)"
_ZERO = "(lat = 0 AND lon = 0)"
_HOME = f"(lat BETWEEN {COUNTRY_BOX[0]} AND {COUNTRY_BOX[1]} AND lon BETWEEN {COUNTRY_BOX[2]} AND {COUNTRY_BOX[3]})"
_ELSE = "(" + " OR ".join(f"(p = '{p}' AND NOT (lat BETWEEN {b[0]} AND {b[1]} AND lon BETWEEN {b[2]} AND {b[3]}))" for p, b in PROVINCE_BOXES.items()) + ")"
_FLAGS = {
    "PARSE_FAILED": f"NOT {_blank('c')} AND (lat IS NULL OR lon IS NULL)",
    "INVALID_WORLD_BOUNDS": f"{_KNOWN} AND NOT {_WORLD}",
    "ZERO_ZERO": _ZERO,
    "POSSIBLE_LAT_LON_SWAP": f"lat BETWEEN {COUNTRY_BOX[2]} AND {COUNTRY_BOX[3]} AND lon BETWEEN {COUNTRY_BOX[0]} AND {COUNTRY_BOX[1]}",
    "SA_SIGN_MISMATCH": f"{_KNOWN} AND NOT {_ZERO} AND {_WORLD} AND (lat >= 0 OR lon <= 0)",
    "OUTSIDE_SA_BOUNDS": f"{_KNOWN} AND NOT {_ZERO} AND {_WORLD} AND NOT {_HOME}",
    "PROVINCE_COORDINATE_MISMATCH": f"{_HOME} AND {_ELSE}",
}


@query("PAR5 GEO1 GEO2 GEO3 GEO4 GEO5 GEO6 GEO7 GEO8 FLT15", f"WITH g AS ({_GEO}) SELECT row_id, nullif(concat_ws('|', {', '.join(f'CASE WHEN {v} THEN {chr(39)}{k}{chr(39)} END' for k, v in _FLAGS.items())}), '') AS flags FROM g")
def geo_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("location.coordinates")
    t = table(spark, sf_dir, "transactions").select("row_id", text.alias("c"), F.col("location.province").alias("p"), geo.latitude(text).alias("lat"), geo.longitude(text).alias("lon"))
    return t.select("row_id", geo.flag_text(geo.flags(F.col("c"), F.col("p"), F.col("lat"), F.col("lon"))).alias("flags"))


@query("GEO9 CUR7 AGG18", "SELECT metric, n, coalesce(round(n * 100.0 :: DOUBLE / (SELECT count(*) FROM transactions), 2), 0) AS pct FROM (" + _long(
    f"SELECT *, {_clean('t.currency')} AS cc, {_alias('t.currency')} AS alias, upper(trim(t.currency)) AS cu FROM ({_GEO}) g JOIN transactions t USING (row_id)",
    {k: v for k, v in _FLAGS.items()} | {"CURRENCY_VARIANT": "alias", "CONVERSION_REQUIRED": "cc <> 'ZAR' AND cc <> ''", "CONVERSION_READY": "cc <> 'ZAR' AND regexp_full_match(cu, '[A-Z]{3}|[0-9]{3}')", "CURRENCY_UNKNOWN": "cc <> 'ZAR' AND cc <> '' AND NOT regexp_full_match(cu, '[A-Z]{3}|[0-9]{3}')"},
) + ")")
def readiness_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("location.coordinates")
    t = table(spark, sf_dir, "transactions").withColumns({"lat": geo.latitude(text), "lon": geo.longitude(text)})
    found = geo.flags(text, F.col("location.province"), F.col("lat"), F.col("lon"))
    ready = currency.readiness_columns(F.col("currency"))
    named = {"CURRENCY_VARIANT": currency.is_variant(F.col("currency")), "CONVERSION_REQUIRED": ready["currency_conversion_required"], "CONVERSION_READY": ready["currency_conversion_ready"], "CURRENCY_UNKNOWN": ready["currency_unknown"]}
    return profile.with_share(profile.long_form(t, {"rows": F.count(F.lit(1))} | {k: profile.holds(v) for k, v in (found | named).items()}))


@query("FLT9 PAR6", f"SELECT row_id, {_amount('amount')} AS value, amount IS NOT NULL AND {_amount('amount')} IS NULL AS cast_failed FROM transactions")
def amount_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = readable_amount(F.col("amount"))
    return table(spark, sf_dir, "transactions").select("row_id", value.alias("value"), (F.col("amount").isNotNull() & value.isNull()).alias("cast_failed"))


@query("SRC2 PAR6 PRJ2 PRJ13", r"""SELECT line_id, regexp_matches(line_text, '"amount"\s*:\s*"') AS quoted,
  CASE WHEN json_valid(line_text) THEN line_text ->> '$.transaction_id' END AS transaction_id, CASE WHEN json_valid(line_text) THEN line_text ->> '$.location.province' END AS province
  FROM raw_lines WHERE file_name = 'transactions.jsonl' AND json_valid(line_text) AND NOT regexp_matches(line_text, ',\s*[}\]]')""")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestrom.operators.lines import parse_lines

    raw = table(spark, sf_dir, "raw_lines").where("file_name = 'transactions.jsonl'").withColumnRenamed("line_text", "value")
    valid = parse_lines(raw, text="value").where("fault is null").select("line_id")
    event = raw.join(valid, "line_id", "left_semi").withColumn("e", F.from_json("value", files.TRANSACTION))
    return event.select("line_id", is_quoted_amount(F.col("value")).alias("quoted"), F.col("e.transaction_id").alias("transaction_id"), F.col("e.location.province").alias("province"))


@query("PAR4 FLT11", f"""WITH s AS (SELECT row_id, {_date('dob')} AS dob FROM customers)
SELECT row_id, CASE WHEN a >= 65 THEN '65+' WHEN a >= 56 THEN '56-65' WHEN a >= 46 THEN '46-55' WHEN a >= 36 THEN '36-45' WHEN a >= 26 THEN '26-35' WHEN a >= 18 THEN '18-25' END AS band
FROM (SELECT row_id, floor(date_sub('month', dob, DATE '{SETTINGS.as_of}') / 12) AS a FROM s)""")
def age_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customers").select("row_id", age_band(parse_date(F.col("dob")), F.lit(SETTINGS.as_of).cast("date")).alias("band"))


@query("PRJ8", f"SELECT count(DISTINCT {_id('account_id')}) AS keys, count(DISTINCT {_id('account_id')}) AS surrogates, 0 AS negative FROM accounts")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestrom.functions.keys import surrogate_key

    k = table(spark, sf_dir, "accounts").select(identifier(F.col("account_id")).alias("k")).where("k is not null").withColumn("sk", surrogate_key(F.col("k")))
    return k.agg(F.count_distinct("k").alias("keys"), F.count_distinct("sk").alias("surrogates"), F.count_if(F.col("sk") < 0).cast("int").alias("negative"))


# --- duplicates and references
@query("AGG6 WIN1 PRJ6", f"SELECT DISTINCT k AS transaction_id, first_at, CAST(n AS BIGINT) AS n FROM (SELECT {_id('transaction_id')} AS k, min(ingested_at) OVER (PARTITION BY {_id('transaction_id')}) AS first_at, count(*) OVER (PARTITION BY {_id('transaction_id')}) AS n FROM transactions) WHERE k IS NOT NULL")
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "transactions").withColumn("k", identifier(F.col("transaction_id"))).where("k is not null")
    first = dedupe.keep_first(t.select("k", "ingested_at", "row_id"), ["k"], [F.col("ingested_at"), F.col("row_id")])
    return first.join(t.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k").select(F.col("k").alias("transaction_id"), F.col("ingested_at").alias("first_at"), "n")


@query("WIN1", f"SELECT row_id FROM (SELECT row_id, row_number() OVER (PARTITION BY {_id('customer_id')} ORDER BY loaded_at NULLS LAST, row_id) AS rn FROM customers) WHERE rn = 1")
def keep_first_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customers").select(identifier(F.col("customer_id")).alias("k"), "loaded_at", "row_id")
    return dedupe.keep_first_window(c, ["k"], [F.col("loaded_at"), F.col("row_id")]).select("row_id")


@query("WIN2 J3", f"SELECT row_id FROM (SELECT row_id, row_number() OVER (PARTITION BY {_id('transaction_id')} ORDER BY ingested_at NULLS LAST, row_id) AS rn FROM transactions WHERE {_id('transaction_id')} IS NOT NULL) WHERE rn > 1")
def duplicate_surplus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "transactions").select(identifier(F.col("transaction_id")).alias("k"), "ingested_at", "row_id").where("k is not null")
    return dedupe.surplus_rows(t, "k", [F.col("ingested_at"), F.col("row_id")], total=True).select("row_id")


@query("AGG4 AGG5 AGG7 AGG8", f"SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS groups, CAST(sum(n - 1) AS BIGINT) AS surplus, (SELECT greatest(count(k) - count(DISTINCT k), 0) FROM (SELECT {_id('transaction_id')} AS k FROM transactions)) AS named_surplus FROM (SELECT {_id('transaction_id')} AS k, count(*) AS n FROM transactions GROUP BY 1)")
def duplicate_surplus_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surplus rows per identifier, with rows without one as a group of their own and, in ``named_surplus``, without them."""
    return dedupe.surplus_count(table(spark, sf_dir, "transactions").select(identifier(F.col("transaction_id")).alias("k")), ["k"])


_KNOWN_ACCOUNTS = f"(SELECT DISTINCT {_id('account_id')} AS k FROM accounts)"


@query("J2 FLT4 FLT5", f"SELECT t.row_id, a.k IS NULL AS orphan FROM transactions t LEFT JOIN {_KNOWN_ACCOUNTS} a ON {_id('t.account_id')} = a.k")
def orphan_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestrom.operators.joins import skew_safe_join

    known = table(spark, sf_dir, "accounts").select(identifier(F.col("account_id")).alias("k"), F.lit(True).alias("there")).where("k is not null").distinct()
    t = table(spark, sf_dir, "transactions").select("row_id", identifier(F.col("account_id")).alias("k"))
    return skew_safe_join(t, known, "k", "left").select("row_id", F.col("there").isNull().alias("orphan"))


@query("J6 J7 AGG17", f"""SELECT 'accounts' AS kind, row_id FROM accounts WHERE {_id('customer_ref')} NOT IN (SELECT {_id('customer_id')} FROM customers WHERE {_id('customer_id')} IS NOT NULL)
UNION ALL SELECT 'transactions', row_id FROM transactions WHERE {_id('account_id')} NOT IN (SELECT {_id('account_id')} FROM accounts WHERE {_id('account_id')} IS NOT NULL)""")
def orphan_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, a, t = (table(spark, sf_dir, n) for n in ("customers", "accounts", "transactions"))
    first = profile.unknown_references(a, c, "customer_ref", "customer_id").select(F.lit("accounts").alias("kind"), "row_id")
    return first.unionByName(profile.unknown_references(t, a, "account_id", "account_id").select(F.lit("transactions").alias("kind"), "row_id"))


@query("J6 (by Bloom filter)", "SELECT row_id FROM accounts WHERE " + _id("customer_ref") + f" IS NOT NULL AND {_id('customer_ref')} NOT IN (SELECT {_id('customer_id')} FROM customers WHERE customer_id IS NOT NULL)")
def orphans_by_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, a = table(spark, sf_dir, "customers"), table(spark, sf_dir, "accounts")
    found = references.find_orphans(a, c.withColumn("loaded_at", F.lit("1970-01-01").cast("timestamp")).withColumn("removed_at", F.lit(None).cast("timestamp")), "customer_ref", "loaded_at", "row_id", "customer_id")
    return found.select("row_id")


_HOMES = f"(SELECT {_id('a.account_id')} AS k, min(upper(trim(c.province))) AS home FROM accounts a JOIN customers c ON {_id('a.customer_ref')} = {_id('c.customer_id')} WHERE {_id('a.account_id')} IS NOT NULL GROUP BY 1)"


@query("J8 J9", f"SELECT t.row_id, h.home, upper(trim(t.location.province)) AS stated FROM transactions t JOIN {_HOMES} h ON {_id('t.account_id')} = h.k WHERE upper(trim(t.location.province)) <> '' AND upper(trim(t.location.province)) <> h.home")
def province_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.province_mismatches(table(spark, sf_dir, "transactions"), table(spark, sf_dir, "accounts"), table(spark, sf_dir, "customers")).select("row_id", "home", "stated")


# --- the pipeline
_SILVER = f"""
c0 AS (SELECT *, {_id('customer_id')} AS k FROM customers),
c1 AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY loaded_at NULLS LAST, row_id) AS nth FROM c0),
sc AS (SELECT k AS customer_id, gender, province, income_band, segment, kyc_status, CAST(trunc(TRY_CAST(risk_score AS DOUBLE)) AS INT) AS risk_score, {_date('dob')} AS dob FROM c1 WHERE k IS NOT NULL AND nth = 1),
a0 AS (SELECT *, {_id('account_id')} AS k, {_id('customer_ref')} AS r FROM accounts),
a1 AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY loaded_at NULLS LAST, row_id) AS nth FROM a0),
aj AS (SELECT a1.*, CASE WHEN k IS NULL THEN 'NULL_REQUIRED' WHEN nth > 1 THEN 'DUPLICATE_DEDUPED' WHEN sc.customer_id IS NULL THEN 'UNKNOWN_CUSTOMER' END AS reason FROM a1 LEFT JOIN sc ON a1.r = sc.customer_id),
sa AS (SELECT k AS account_id, r AS customer_ref, account_type, account_status, product_tier, digital_channel, {_date('open_date')} AS open_date, {_date('last_activity_date')} AS last_activity_date, {_amount('credit_limit')} AS credit_limit, {_amount('current_balance')} AS current_balance FROM aj WHERE reason IS NULL),
t0 AS (SELECT row_id, {_id('transaction_id')} AS transaction_id, {_id('account_id')} AS account_id, {_date('transaction_date')} AS transaction_date, {_stamp('transaction_date', 'transaction_time')} AS stamp,
  nullif(trim(transaction_type), '') AS transaction_type, nullif({_clean('currency')}, '') AS currency, nullif(trim(channel), '') AS channel, {_amount('amount')} AS amount, NOT {_blank('amount')} AND {_amount('amount')} IS NULL AS unreadable,
  location.province AS province, {_variant('transaction_date')} AS date_variant, {_alias('currency')} AS currency_variant FROM transactions),
t1 AS (SELECT *, CASE WHEN transaction_id IS NOT NULL THEN row_number() OVER (PARTITION BY transaction_id ORDER BY stamp NULLS LAST, row_id) END AS nth FROM t0),
tj AS (SELECT *, CASE WHEN nth > 1 THEN 'duplicate' WHEN transaction_id IS NULL OR account_id IS NULL OR transaction_date IS NULL OR stamp IS NULL OR amount IS NULL OR transaction_type IS NULL OR currency IS NULL OR channel IS NULL THEN 'missing_required'
  WHEN account_id NOT IN (SELECT account_id FROM sa) THEN 'orphan' ELSE 'valid' END AS outcome,
  CASE WHEN date_variant THEN 'DATE_FORMAT' WHEN currency_variant THEN 'CURRENCY_VARIANT' END AS dq_flag FROM t1),
ft AS (SELECT tj.row_id, tj.transaction_id, sa.account_id, sa.customer_ref AS customer_id, tj.transaction_date, tj.transaction_type, tj.amount, tj.currency, tj.channel, coalesce(sc.province, tj.province) AS province, dq_flag
  FROM tj JOIN sa USING (account_id) JOIN sc ON sa.customer_ref = sc.customer_id WHERE outcome = 'valid')"""



def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(spark, sf_dir, "customers"), table(spark, sf_dir, "accounts"), table(spark, sf_dir, "transactions")


@query("J1 FLT6 PRJ7 SNK5", f"WITH {_SILVER} SELECT reason, count(*) AS n FROM (SELECT coalesce(reason, 'LOADED') AS reason FROM aj) GROUP BY 1")
def accounts_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, a, _ = _tables(spark, sf_dir)
    split = medallion.silver_accounts(a, medallion.silver_customers(c).valid)
    rows = split.valid.select(F.lit("LOADED").alias("reason")).unionByName(split.rejected.select("reason"))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("PRJ5 PRJ8 J1", f"WITH {_SILVER} SELECT account_id, customer_ref AS customer_id, account_type, account_status, open_date, product_tier, digital_channel, credit_limit, current_balance, last_activity_date FROM sa")
def dim_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, a, _ = _tables(spark, sf_dir)
    return medallion.dim_accounts(medallion.silver_accounts(a, medallion.silver_customers(c).valid).valid).drop("account_sk")


@query("PRJ5 PAR4", f"WITH {_SILVER}, g AS (SELECT *, floor(date_sub('month', dob, DATE '{SETTINGS.as_of}') / 12) AS a FROM sc) SELECT customer_id, gender, province, income_band, segment, risk_score, kyc_status, CASE WHEN a >= 65 THEN '65+' WHEN a >= 56 THEN '56-65' WHEN a >= 46 THEN '46-55' WHEN a >= 36 THEN '36-45' WHEN a >= 26 THEN '26-35' WHEN a >= 18 THEN '18-25' END AS age_band FROM g")
def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.dim_customers(medallion.silver_customers(table(spark, sf_dir, "customers")).valid, SETTINGS).drop("customer_sk")


def _judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, medallion.Split]:
    _, accounts, judged = medallion.judge(*_tables(spark, sf_dir))
    return judged, accounts


@query("FLT3 FLT5 FLT14 PRJ3 SNK5 DQ3", f"WITH {_SILVER} SELECT row_id, outcome, dq_flag FROM tj")
def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one outcome of every row."""
    return _judged(spark, sf_dir)[0].select("row_id", "outcome", "dq_flag")


@query("DQ3 AGG5 SNK5", f"WITH {_SILVER} SELECT outcome, count(*) AS n FROM tj GROUP BY 1")
def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reconcile(_judged(spark, sf_dir)[0])


_MARK = "SELECT '{0}' AS issue, count(*) FILTER (WHERE {1}) AS affected, count(*) AS denominator, count(*) FILTER (WHERE {2}) AS output FROM tj"
_DATED = {"customers": _variant("dob"), "accounts": f"{_variant('open_date')} OR {_variant('last_activity_date')}", "transactions": _variant("transaction_date")}
_ISSUES = " UNION ALL ".join([
    _MARK.format("DUPLICATE_DEDUPED", "outcome = 'duplicate'", "outcome <> 'duplicate'"), _MARK.format("ORPHANED_ACCOUNT", "outcome = 'orphan'", "false"),
    _MARK.format("TYPE_MISMATCH", "unreadable", "false"), _MARK.format("CURRENCY_VARIANT", "currency_variant", "outcome = 'valid' AND dq_flag = 'CURRENCY_VARIANT'"),
    *(f"SELECT 'DATE_FORMAT', count(*) FILTER (WHERE {p}), count(*), CAST(0 AS BIGINT) FROM {t}" for t, p in _DATED.items()),
    f"SELECT 'DATE_FORMAT', 0, 0, count(*) FILTER (WHERE k IS NOT NULL AND nth = 1 AND {_DATED['customers']}) FROM c1",
    f"SELECT 'DATE_FORMAT', 0, 0, count(*) FILTER (WHERE reason IS NULL AND ({_DATED['accounts']})) FROM aj",
    "SELECT 'DATE_FORMAT', 0, 0, count(*) FILTER (WHERE outcome = 'valid' AND dq_flag = 'DATE_FORMAT') FROM tj",
    f"SELECT 'NULL_REQUIRED', count(*) FILTER (WHERE {_id('account_id')} IS NULL), count(*), CAST(0 AS BIGINT) FROM accounts",
])


@query("DQ1 DQ3 AGG1 AGG2 AGG18", f"WITH {_SILVER}, i AS ({_ISSUES}), t AS (SELECT issue, CAST(sum(affected) AS BIGINT) AS affected, CAST(sum(denominator) AS BIGINT) AS denominator, CAST(sum(output) AS BIGINT) AS output FROM i GROUP BY 1) SELECT *, round(affected * CAST(100 AS DOUBLE) / denominator, 2) AS pct FROM t")
def dq_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, accounts, transactions = _tables(spark, sf_dir)
    c, a, judged = medallion.judge(customers, accounts, transactions)
    return quality.source_issues(judged, customers, accounts, c.valid, a.valid)


@query("J4 J5 PRJ5 PRJ12", f"WITH {_SILVER} SELECT transaction_id, account_id, customer_id, transaction_date, transaction_type, amount, currency, channel, province, dq_flag FROM ft")
def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table, its surrogate keys resolved to the natural ones."""
    gold = medallion.build(*_tables(spark, sf_dir), SETTINGS)
    keys = gold["gold/dim_accounts"].select("account_sk", "account_id", "customer_id")
    return gold["gold/fact_transactions"].join(keys, "account_sk").select("transaction_id", "account_id", "customer_id", "transaction_date", "transaction_type", "amount", "currency", "channel", "province", "dq_flag")


def _gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return medallion.build(*_tables(spark, sf_dir), SETTINGS)


def _validation(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        g = _gold(spark, sf_dir)
        return validate.check(name, g["gold/fact_transactions"], g["gold/dim_accounts"], g["gold/dim_customers"])

    run.__name__ = f"gold_{name}"
    return run


query("AGG23 SET4 SRC9 Q0", f"WITH {_SILVER} SELECT 'dim_accounts' AS table_name, count(*) AS n FROM sa UNION ALL SELECT 'dim_customers', count(*) FROM sc UNION ALL SELECT 'fact_transactions', count(*) FROM ft")(_validation("row_counts"))
query("AGG21 WIN8 SRT1 Q1", f"WITH {_SILVER} SELECT transaction_type, count(*) AS n, sum(amount) AS total, CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS DOUBLE) AS pct FROM ft GROUP BY 1")(_validation("volume_by_type"))
query("J12 Q2", f"WITH {_SILVER} SELECT count(*) AS n FROM sa LEFT JOIN sc ON sa.customer_ref = sc.customer_id WHERE sc.customer_id IS NULL")(_validation("unlinked_accounts"))
query("J13 AGG22 SRT1 Q3", f"WITH {_SILVER} SELECT sc.province, count(DISTINCT account_id) AS n FROM sa JOIN sc ON sa.customer_ref = sc.customer_id GROUP BY 1")(_validation("accounts_per_province"))
query("AGG23 SET4 Q4", f"WITH {_SILVER} SELECT CASE WHEN dq_flag IS NULL THEN 'clean' ELSE 'flagged' END AS kind, count(*) AS n FROM ft GROUP BY 1")(_validation("flagged_vs_clean"))


@query("AGG21 WIN8 SRT1", "SELECT l_returnflag AS kind, l_linestatus AS status, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) :: DOUBLE AS pct FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2")
def volume_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem_view")
    return spark.sql("SELECT l_returnflag AS kind, l_linestatus AS status, count(*) AS n, sum(l_quantity) AS quantity, round(count(*) * 100.0D / sum(count(*)) OVER (), 2) AS pct FROM lineitem_view GROUP BY 1, 2 ORDER BY 1, 2")


# --- profile
def _domain_predicates(t: str) -> dict[str, str]:
    found = {}
    for name, allowed in DOMAINS.items():
        owner, c = name.split(".")
        if owner == t:
            value = "location.province" if name == "transactions.province" else _clean("currency") if c == "currency" else c
            found[f"invalid_{c}"] = f"NOT {_blank(f'({value})')} AND NOT coalesce(upper(trim({value})) IN ({_listed(allowed)}), false)"
    return found


def _blank_metrics(*columns: str) -> dict[str, str]:
    return {f"blank_{c.split('.')[-1]}": _blank(c) for c in columns}


_AS_OF = f"DATE '{SETTINGS.as_of}'"


@query("PRF4 AGG7 FLT1 FLT2 FLT11 FLT12", _long(
    f"SELECT *, {_date('dob')} AS d, floor(date_sub('month', {_date('dob')}, {_AS_OF}) / 12) AS y, CASE WHEN regexp_full_match(trim(risk_score), '[+-]?[0-9]+') THEN TRY_CAST(trim(risk_score) AS INT) END AS r FROM customers",
    {"rows": "=count(*)", "distinct_customer_ids": f"=count(DISTINCT CASE WHEN NOT {_blank('customer_id')} THEN trim(customer_id) END)"}
    | _blank_metrics("customer_id", "id_number", "first_name", "last_name", "product_flags") | _domain_predicates("customers")
    | {"dob_unreadable": f"NOT {_blank('dob')} AND d IS NULL", "future_dob": f"d > {_AS_OF}", "under_18": "y < 18", "over_110": "y > 110", "risk_score_unreadable": f"NOT {_blank('risk_score')} AND r IS NULL", "risk_score_out_of_range": "r < 1 OR r > 10"},
))
def profile_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.long_form(table(spark, sf_dir, "customers"), profile.customer_metrics(SETTINGS))


@query("PRF3 AGG3 FLT11 FLT12 FLT13", _long(
    f"SELECT *, {_date('open_date')} AS o, {_date('last_activity_date')} AS l, {_amount('current_balance')} AS b, {_amount('credit_limit')} AS lim, upper(trim(account_type)) AS kind FROM accounts",
    {"rows": "=count(*)", "distinct_account_ids": f"=count(DISTINCT CASE WHEN NOT {_blank('account_id')} THEN trim(account_id) END)"}
    | _blank_metrics("account_id", "customer_ref", "mobile_number") | _domain_predicates("accounts")
    | {"open_date_unreadable": f"NOT {_blank('open_date')} AND o IS NULL", "last_activity_date_unreadable": f"NOT {_blank('last_activity_date')} AND l IS NULL", "future_open_date": f"o > {_AS_OF}", "activity_before_opening": "l < o",
       "current_balance_unreadable": f"NOT {_blank('current_balance')} AND b IS NULL", "credit_limit_unreadable": f"NOT {_blank('credit_limit')} AND lim IS NULL", "negative_balance": "b < 0", "extreme_balance": "abs(b) > 250000", "negative_limit": "lim < 0",
       "limit_without_credit": f"kind <> 'CREDIT' AND NOT {_blank('credit_limit')}", "credit_without_limit": "kind = 'CREDIT' AND coalesce(lim <= 0, true)"},
))
def profile_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.long_form(table(spark, sf_dir, "accounts"), profile.account_metrics(SETTINGS))


_BIG = f"SELECT t.*, g.c, g.p, g.lat, g.lon, {_amount('amount')} AS a, {_date('transaction_date')} AS d, {_stamp('transaction_date', 'transaction_time')} AS stamp, {_clean('currency')} AS cc, upper(trim(currency)) AS cu FROM transactions t JOIN ({_GEO}) g USING (row_id)"


@query("PRF1 PRF2 AGG3 FLT11 FLT12", _long(
    _BIG,
    {"rows": "=count(*)", "distinct_transaction_ids": f"=count(DISTINCT CASE WHEN NOT {_blank('transaction_id')} THEN trim(transaction_id) END)"}
    | _blank_metrics("transaction_id", "account_id", "transaction_date", "transaction_time", "amount", "location.province", "merchant_subcategory", "location.coordinates")
    | {"amount_unreadable": f"NOT {_blank('amount')} AND a IS NULL", "negative_amount": "a < 0", "zero_amount": "a = 0", "extreme_amount": "a > 50000", "transaction_date_unreadable": f"NOT {_blank('transaction_date')} AND d IS NULL",
       "transaction_time_unreadable": f"NOT {_blank('transaction_time')} AND stamp IS NULL", "future_transaction_date": f"d > {_AS_OF}", "retry_flagged": "metadata.retry_flag"}
    | _domain_predicates("transactions")
    | {"currency_present": f"NOT {_blank('currency')}", "currency_variant": _alias("currency"), "currency_iso_candidate": "regexp_full_match(cu, '[A-Z]{3}')", "currency_numeric_candidate": "regexp_full_match(cu, '[0-9]{3}')",
       "currency_conversion_required": f"NOT {_blank('currency')} AND cc <> 'ZAR'", "currency_conversion_ready": f"NOT {_blank('currency')} AND cc <> 'ZAR' AND regexp_full_match(cu, '[A-Z]{{3}}|[0-9]{{3}}')", "currency_unknown": f"NOT {_blank('currency')} AND cc <> 'ZAR' AND NOT regexp_full_match(cu, '[A-Z]{{3}}|[0-9]{{3}}')"}
    | {f"geo_{k.lower()}": v for k, v in _FLAGS.items()},
))
def profile_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.long_form(table(spark, sf_dir, "transactions"), profile.transaction_metrics(SETTINGS))


@query("FLT11 FLT13", f"""WITH s AS (SELECT row_id, {_date('open_date')} AS o, {_date('last_activity_date')} AS l, upper(trim(account_type)) AS kind, credit_limit, {_amount('credit_limit')} AS lim FROM accounts)
SELECT row_id, coalesce(l < o, false) AS before_opening, coalesce(o > {_AS_OF}, false) AS future, coalesce(kind <> 'CREDIT' AND NOT {_blank('credit_limit')}, false) AS limit_without_credit, coalesce(kind = 'CREDIT' AND (lim IS NULL OR lim <= 0), false) AS credit_without_limit FROM s""")
def account_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, last, lim, kind = parse_date(F.col("open_date")), parse_date(F.col("last_activity_date")), readable_amount(F.col("credit_limit")), F.upper(F.trim("account_type"))
    no = F.lit(False)
    return table(spark, sf_dir, "accounts").select(
        "row_id", F.coalesce(last < o, no).alias("before_opening"), F.coalesce(o > F.lit(SETTINGS.as_of).cast("date"), no).alias("future"),
        F.coalesce((kind != "CREDIT") & ~is_blank(F.col("credit_limit")), no).alias("limit_without_credit"), F.coalesce((kind == "CREDIT") & (lim.isNull() | (lim <= 0)), no).alias("credit_without_limit"),
    )


@query("FLT12", f"""WITH s AS (SELECT {_amount('amount')} AS a FROM transactions) SELECT count(*) FILTER (WHERE a < 0) AS negative, count(*) FILTER (WHERE a = 0) AS zero, count(*) FILTER (WHERE a > 50000) AS extreme FROM s""")
def numeric_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = readable_amount(F.col("amount"))
    return table(spark, sf_dir, "transactions").agg(profile.holds(a < 0).alias("negative"), profile.holds(a == 0).alias("zero"), profile.holds(a > SETTINGS.extreme_amount).alias("extreme"))


@query("AGG13", "SELECT unnest([0.5, 0.95, 0.99]) :: DOUBLE AS point, unnest([quantile_disc(o_totalprice, 0.5), quantile_disc(o_totalprice, 0.95), quantile_disc(o_totalprice, 0.99)]) AS value FROM orders")
def quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.quantiles(table(spark, sf_dir, "orders"), F.col("o_totalprice"), SETTINGS.percentile_accuracy)


def _quantiles(name: str, value: str, source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS field, CAST({p} AS DOUBLE) AS point, CAST(quantile_disc(v, {p}) AS DOUBLE) AS value FROM (SELECT {value} AS v FROM {source})" for p in (0.5, 0.95, 0.99))


@query("AGG13 PRF2 PRF3 PRF4", " UNION ALL ".join([_quantiles("amount", _amount("amount"), "transactions"), _quantiles("current_balance", _amount("current_balance"), "accounts"), _quantiles("risk_score", "TRY_CAST(trim(risk_score) AS INT)", "customers")]))
def profile_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quantiles of the feed's own numbers, by a mergeable sketch."""
    c, a, t = _tables(spark, sf_dir)
    parts = {"amount": (t, readable_amount(F.col("amount"))), "current_balance": (a, readable_amount(F.col("current_balance"))), "risk_score": (c, F.trim("risk_score").try_cast("int"))}
    found = [profile.quantiles(df, v, SETTINGS.percentile_accuracy).select(F.lit(k).alias("field"), F.col("point").cast("double").alias("point"), F.col("value").cast("double").alias("value")) for k, (df, v) in parts.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


_TOP = "SELECT field, value, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value NULLS FIRST) AS rank FROM (SELECT field, value, count(*) AS n FROM ({0}) GROUP BY 1, 2)) WHERE rank <= 5"


@query("PRJ11 AGG15 WIN3 SRT2", _TOP.format("SELECT unnest(['transaction_type', 'channel', 'currency', 'province']) AS field, unnest([transaction_type, channel, currency, location.province]) AS value FROM transactions"))
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.top_values(table(spark, sf_dir, "transactions"), {"transaction_type": F.col("transaction_type"), "channel": F.col("channel"), "currency": F.col("currency"), "province": F.col("location.province")}, SETTINGS.top_k)


_KINDS = {"customers": ("gender", "province", "segment", "kyc_status"), "accounts": ("account_type", "account_status", "product_tier", "digital_channel")}


@query("AGG15 PRF3 PRF4 SRT2", " UNION ALL ".join("SELECT * FROM (" + _TOP.format(" UNION ALL ".join(f"SELECT '{t}.{c}' AS field, {c} AS value FROM {t}" for c in cs)) + ")" for t, cs in _KINDS.items()))
def top_values_of_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent values of the closed columns of customers and accounts."""
    found = [frequency.top_values(table(spark, sf_dir, t), {f"{t}.{c}": F.col(c) for c in cs}, SETTINGS.top_k) for t, cs in _KINDS.items()]
    return found[0].unionByName(found[1])


_T_DOMAINS = {c: (v, DOMAINS[f"transactions.{c}"]) for c, v in (("transaction_type", "transaction_type"), ("channel", "channel"), ("currency", _clean("currency")), ("province", "location.province"))}


def _strange(value: str, allowed: tuple[str, ...]) -> str:
    return f"CASE WHEN NOT {_blank(f'({value})')} AND NOT coalesce(upper(trim({value})) IN ({_listed(allowed)}), false) THEN upper(trim({value})) END"


@query("WIN4", "SELECT * FROM (" + _TOP.format("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS field, {_strange(v, a)} AS value FROM transactions" for c, (v, a) in _T_DOMAINS.items()) + ") WHERE value IS NOT NULL") + ")")
def top_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.top_unknown(table(spark, sf_dir, "transactions"), "transactions", SETTINGS)


_DRIFT = " UNION ALL ".join(
    f"SELECT 'transactions.{c}' AS field, count(*) AS rows, count(CASE WHEN NOT {_blank(f'({v})')} THEN 1 END) AS present, count({_strange(v, a)}) AS unknown, count(DISTINCT CASE WHEN NOT {_blank(f'({v})')} THEN upper(trim({v})) END) AS distinct_, count(DISTINCT {_strange(v, a)}) AS unknown_distinct FROM transactions"
    for c, (v, a) in _T_DOMAINS.items()
)


@query("AGG20 DRF1 DRF2", f"SELECT field, rows, present, unknown, distinct_, unknown_distinct, h AS high_cardinality, unknown > 0 AND NOT h AS review FROM (SELECT *, coalesce(unknown_distinct >= 50 OR (unknown_distinct >= 3 AND unknown_distinct / distinct_ >= 0.25), false) AS h FROM ({_DRIFT}))")
def domain_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = frequency.domain_metrics(table(spark, sf_dir, "transactions"), "transactions", SETTINGS, exact=True)
    return frequency.drift(metrics, SETTINGS).withColumnRenamed("distinct", "distinct_")


def _domain_counts(name: str) -> str:
    owner, c = name.split(".")
    v = "location.province" if name == "transactions.province" else _clean("currency") if c == "currency" else c
    clean, strange = f"CASE WHEN NOT {_blank(f'({v})')} THEN upper(trim({v})) END", _strange(v, DOMAINS[name])
    return f"SELECT '{name}' AS field, count(*) AS rows, count({clean}) AS present, count({strange}) AS unknown, count(DISTINCT {clean}) AS exact, count(DISTINCT {strange}) AS exact_unknown, true AS within_bounds FROM {owner}"


@query("AGG9 AGG10 AGG11 AGG12 DRF4", " UNION ALL ".join(map(_domain_counts, DOMAINS)))
def domain_drift_light(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate distinct values of all domains, against the exact ones: within three standard errors (and one value)."""
    found = []
    for name in ("customers", "accounts", "transactions"):
        df = table(spark, sf_dir, name)
        rough, exact = (frequency.domain_metrics(df, name, SETTINGS, exact=e) for e in (False, True))
        near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1.0), F.col(b) * 3 * 0.05)
        both = rough.join(F.broadcast(exact.select("field", F.col("distinct").alias("exact"), F.col("unknown_distinct").alias("exact_unknown"))), "field")  # one row a field
        found.append(both.select("field", "rows", "present", "unknown", "exact", "exact_unknown", (near("distinct", "exact") & near("unknown_distinct", "exact_unknown")).alias("within_bounds")))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("DRF1 DRF2 DRF3 DRF5", f"""WITH top AS ({ORACLES['top_unknown']}), m AS ({_DRIFT}), ok AS (SELECT field FROM m WHERE unknown > 0 AND NOT coalesce(unknown_distinct >= CASE field WHEN 'transactions.province' THEN 2 ELSE 50 END OR (unknown_distinct >= 3 AND unknown_distinct / distinct_ >= 0.95), false))
SELECT 'transactions.' || top.field AS field, value, n, 'review ' || chr(39) || value || chr(39) || ' as a value of transactions.' || top.field || ' (' || n || ' rows)' AS suggestion FROM top JOIN ok ON ok.field = 'transactions.' || top.field""")
def rule_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values to review where a lenient ratio and a strict threshold of one domain are configured."""
    return frequency.suggestions(table(spark, sf_dir, "transactions"), "transactions", Settings(high_cardinality_ratio=0.95, domain_thresholds={"transactions.province": 2}))


@query("AGG16", "SELECT count(*) FILTER (WHERE n >= 50) AS groups_at_threshold, max(n) AS largest_group FROM (SELECT " + _id("account_id") + " AS k, transaction_type, channel, count(*) AS n FROM transactions GROUP BY 1, 2, 3)")
def dense_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.dense_patterns(table(spark, sf_dir, "transactions"), ["account_id", "transaction_type", "channel"], SETTINGS.repeat_pattern)


@query("PRF5 J6 J7 J8 J9", f"""SELECT 'accounts_with_unknown_customer' AS metric, count(*) AS n FROM ({ORACLES['orphan_anti']}) WHERE kind = 'accounts'
UNION ALL SELECT 'transactions_with_unknown_account', count(*) FROM ({ORACLES['orphan_anti']}) WHERE kind = 'transactions'
UNION ALL SELECT 'transactions_in_another_province', count(*) FROM ({ORACLES['province_mismatch']})""")
def profile_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, a, t = _tables(spark, sf_dir)
    parts = {
        "accounts_with_unknown_customer": profile.unknown_references(a, c, "customer_ref", "customer_id"),
        "transactions_with_unknown_account": profile.unknown_references(t, a, "account_id", "account_id"),
        "transactions_in_another_province": profile.province_mismatches(t, a, c),
    }
    found = [f.agg(F.lit(k).alias("metric"), F.count(F.lit(1)).alias("n")) for k, f in parts.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


_AUDIT = " UNION ALL ".join(f"SELECT '{t}' AS table_name, metric, n FROM ({ORACLES[f'profile_{t}']})" for t in ("customers", "accounts", "transactions"))


@query("PRF6 PRF7 SNK7", _AUDIT)
def audit_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full audit of a store's bronze tables, written as a document and read back: its metrics."""
    store = Store(spark, scratch.new_path(spark, "audited"))
    for name, df in zip(("customers", "accounts", "transactions"), _tables(spark, sf_dir), strict=True):
        store.overwrite(df, f"bronze/{name}")
    store.write_text(f"{store.root}/audit.json", quality.to_json(runner.audit(store, Settings(profile_mode="full"))))
    metrics = spark.read.option("multiLine", True).json(f"{store.root}/audit.json").select("metrics.*")
    each = [F.struct(F.lit(t).alias("table_name"), F.lit(f.name).alias("metric"), F.col(f"{t}.{f.name}").alias("n")) for t in metrics.columns for f in metrics.schema[t].dataType.fields]
    return metrics.select(F.explode(F.array(*each)).alias("e")).select("e.*")


_TAKEN = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SETTINGS.actions.items())


@query("DQ2 DQ4 SNK6 ADP12 AGG18", f"SELECT issue AS issue_type, affected AS records_affected, pct AS percentage_of_total, output AS records_in_output, CASE issue {_TAKEN} END AS handling_action FROM ({ORACLES['dq_issues']}) WHERE affected > 0")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The issues of the quality report, with their handling actions, as the written document states them."""
    issues = [r.asDict() for r in dq_issues(spark, sf_dir).collect()]  # one row an issue
    store = Store(spark, scratch.new_path(spark, "reported"))
    store.write_text(f"{store.root}/dq_report.json", quality.to_json(quality.report(issues, SETTINGS, {})))
    listed = spark.read.option("multiLine", True).json(f"{store.root}/dq_report.json").select(F.explode("dq_issues").alias("i"))
    return listed.select("i.issue_type", "i.records_affected", "i.percentage_of_total", "i.records_in_output", "i.handling_action")


# --- states, streaming, buckets, storage
_ONCE = "SELECT DISTINCT ON (account_id, transaction_id) account_id, transaction_id, transaction_timestamp, amount, transaction_type FROM recent_transactions WHERE transaction_id IS NOT NULL AND account_id IS NOT NULL AND transaction_timestamp IS NOT NULL AND amount IS NOT NULL AND transaction_type IN ('DEBIT', 'CREDIT', 'FEE', 'REVERSAL') ORDER BY account_id, transaction_id, transaction_timestamp DESC"
_BALANCE = f"""WITH e AS ({_ONCE}), d AS (SELECT account_id, sum(CASE WHEN transaction_type IN ('CREDIT', 'REVERSAL') THEN amount ELSE -amount END) AS delta, max(transaction_timestamp) AS latest FROM e GROUP BY 1)
SELECT b.account_id, CAST(b.current_balance + coalesce(d.delta, 0) AS DECIMAL(18,2)) AS current_balance, greatest(TIMESTAMPTZ '1970-01-01 00:00:00+00', d.latest) AS last_transaction_timestamp FROM current_balances b LEFT JOIN d USING (account_id)"""


@query("AGG14 J11 FLT10 STR3", _BALANCE)
def running_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = states.once_per_transaction(states.admit(table(spark, sf_dir, "recent_transactions")).select(*states.EVENT_COLUMNS))
    state = states.seed_balances(table(spark, sf_dir, "current_balances"))
    return states.apply_balances(state, events).drop("updated_at")


@query("WIN5 WIN6 SRT2", f"WITH e AS ({_ONCE}) SELECT account_id, transaction_id, transaction_timestamp FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY transaction_timestamp DESC, transaction_id) AS rn FROM e) WHERE rn <= 50")
def recent_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = states.once_per_transaction(states.admit(table(spark, sf_dir, "recent_transactions")).select(*states.EVENT_COLUMNS))
    return states.last_n(events, SETTINGS.recent_kept).select("account_id", "transaction_id", "transaction_timestamp")


@query("STR1 STR3 STR6 STR7 SNK10 SRC4", _BALANCE)
def stream_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same balances by a stream over the table's files."""
    source = table(spark, sf_dir, "recent_transactions")
    store = Store(spark, scratch.new_path(spark, "stream-store"))
    store.overwrite(states.seed_balances(table(spark, sf_dir, "current_balances")), feed.BALANCES)
    path = f"{sf_dir}/recent_transactions.parquet"
    stream = spark.readStream.schema(source.schema).parquet(path if _is_folder(spark, path) else f"{sf_dir}/recent_transactions*.parquet")
    q = feed.start(states.admit(stream).select(*states.EVENT_COLUMNS), store, scratch.new_path(spark, "stream-checkpoint"))
    q.awaitTermination()
    return store.read(feed.BALANCES).drop("updated_at")


_SENT = "SELECT *, transaction_timestamp AT TIME ZONE 'UTC' AS t FROM recent_transactions WHERE transaction_id IS NOT NULL AND account_id IN (SELECT account_id FROM current_balances) AND transaction_timestamp IS NOT NULL AND amount IS NOT NULL AND transaction_type IN ('DEBIT', 'CREDIT', 'FEE', 'REVERSAL')"
_LANDED = f"SELECT DISTINCT ON (a, i) * FROM (SELECT {_id('account_id')} AS a, {_id('transaction_id')} AS i, date_trunc('second', t) AS s, amount, transaction_type, channel FROM ({_SENT})) ORDER BY a, i, s DESC"


def _landed_stream(spark: SparkSession, sf_dir: str) -> Store:
    """Lines of all recent transactions land as files out of order; the stream takes them a few files at a time."""
    r = table(spark, sf_dir, "recent_transactions")
    line = F.to_json(F.struct("transaction_id", "account_id", F.date_format("transaction_timestamp", "yyyy-MM-dd").alias("transaction_date"), F.date_format("transaction_timestamp", "HH:mm:ss").alias("transaction_time"), "transaction_type", F.col("amount").cast("string").alias("amount"), F.lit("R").alias("currency"), "channel"))
    folder = scratch.new_path(spark, "landing")
    for part in (1, 0):  # the later half of the arrivals lands first
        half = r.where(F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == part).orderBy(F.col("updated_at").desc())
        half.select(line.alias("value")).write.mode("append").text(folder)
    store = Store(spark, scratch.new_path(spark, "landed-store"))
    store.overwrite(states.seed_balances(table(spark, sf_dir, "current_balances").withColumn("account_id", identifier(F.col("account_id")))), feed.BALANCES)
    stream = feed.line_stream(spark, folder, pattern="part-*", files_per_batch=max(1, files.fingerprints(spark, folder).count() // 3))
    feed.start(stream, store, scratch.new_path(spark, "landed-checkpoint"), written_at="2026-04-01 00:00:00").awaitTermination()
    return store


@query("SRC5 STR1 STR2 STR5 J10 SRT4", f"""WITH e AS ({_LANDED}), d AS (SELECT a, sum(CASE WHEN transaction_type IN ('CREDIT', 'REVERSAL') THEN amount ELSE -amount END) AS delta, max(s) AS latest FROM e GROUP BY 1)
SELECT {_id("b.account_id")} AS account_id, CAST(b.current_balance + coalesce(d.delta, 0) AS DECIMAL(18,2)) AS current_balance, greatest(TIMESTAMP '1970-01-01', d.latest) AS last_at, CASE WHEN d.a IS NULL THEN TIMESTAMP '1970-01-01' ELSE TIMESTAMP '2026-04-01' END AS written_at FROM current_balances b LEFT JOIN d ON d.a = {_id("b.account_id")}""")
def stream_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances and their times of writing, from JSON lines that land in files in the wrong order."""
    state = _landed_stream(spark, sf_dir).read(feed.BALANCES)
    return state.select("account_id", "current_balance", F.col("last_transaction_timestamp").cast("timestamp_ntz").alias("last_at"), F.col("updated_at").cast("timestamp_ntz").alias("written_at"))


@query("STR4 SET2", f"WITH e AS ({_LANDED}) SELECT a AS account_id, i AS transaction_id, s AS at, amount FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, i) AS rn FROM e) WHERE rn <= 50")
def stream_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 50 transactions of each account, as the same stream leaves them in the store."""
    return _landed_stream(spark, sf_dir).read(feed.RECENT).select("account_id", "transaction_id", F.col("transaction_timestamp").cast("timestamp_ntz").alias("at"), "amount")


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


@query("PRJ10 ADP3 ADP8 SRC6 SNK2", f"SELECT {_id('transaction_id')} AS transaction_id, min(ingested_at) AS first_at FROM transactions WHERE {_id('transaction_id')} IS NOT NULL GROUP BY 1")
def bucketed_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-first by buckets of the id: the same rows as all at once. As many buckets as the source's bytes need."""
    t = table(spark, sf_dir, "transactions").select(identifier(F.col("transaction_id")).alias("transaction_id"), "ingested_at", "row_id").where("transaction_id is not null")
    plan = buckets.preflight_files(spark, [f"{sf_dir}/transactions.parquet"], Settings(bucket_bytes=2 << 20), kind="parquet")
    store = Store(spark, scratch.new_path(spark, "buckets"))
    buckets.ingest(t, "transaction_id", plan, store, "bronze")
    done = buckets.run(store, "bronze", "silver", plan, lambda b: dedupe.keep_first(b, ["transaction_id"], [F.col("ingested_at"), F.col("row_id")]), workers=buckets.at_once(spark, plan))
    return done.select("transaction_id", F.col("ingested_at").alias("first_at"))


@query("ADP1 ADP2 ADP4 ADP5 ADP6 ADP7 ADP9 ADP10 ADP11 SRT3 SRT5 SNK6 SNK9 2.16-phases", f"WITH {_SILVER} SELECT transaction_type, count(*) AS n, sum(amount) AS total, true AS resumed_lost_bucket_only FROM ft GROUP BY 1")
def resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole bucketed run after which one bucket's output is lost: a second run redoes that bucket and no other."""
    store = Store(spark, scratch.new_path(spark, "resumed"))
    settings = Settings(bucket_bytes=1 << 20, profile_mode="off")
    size = buckets.preflight_files(spark, [f"{sf_dir}/transactions.parquet"], settings, kind="parquet")
    plan = buckets.preflight(size.input_bytes, size.fingerprint, settings, buckets=max(2, size.buckets))
    runner.run_auto(*_tables(spark, sf_dir), store, settings, plan)
    versions = [store.pointer(f"judged/bucket={b}")["version"] for b in range(plan.buckets)]
    scratch.remove(spark, store.location("judged/bucket=1"))
    runner.run_auto(*_tables(spark, sf_dir), store, settings, plan)
    again = [store.pointer(f"judged/bucket={b}")["version"] for b in range(plan.buckets)]
    only = [b for b in range(plan.buckets) if again[b] != versions[b]] == [1]
    return store.read("gold/fact_transactions").groupBy("transaction_type").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total")).withColumn("resumed_lost_bucket_only", F.lit(only))


@query("PRJ9 WIN7", f"SELECT k AS account_id, row_number() OVER (ORDER BY k) AS rank FROM (SELECT DISTINCT {_id('account_id')} AS k FROM accounts) WHERE k IS NOT NULL")
def rank_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate keys by rank, by ranges of keys and offsets instead of one window over all rows."""
    return rank_key(table(spark, sf_dir, "accounts").select(identifier(F.col("account_id")).alias("account_id")), "account_id", "rank")


@query("PRJ3 PRJ4 PRJ2", f"""WITH {_SILVER}, g AS ({_GEO}) SELECT row_id, tj.transaction_id, tj.outcome, upper(trim(t.currency)) AS written, {_clean('t.currency')} AS currency_clean,
  coalesce(NOT {_blank('t.currency')} AND {_clean('t.currency')} <> 'ZAR', false) AS currency_conversion_required, g.c AS geo_coordinate_raw, g.lat AS geo_latitude, g.lon AS geo_longitude,
  nullif(concat_ws('|', {', '.join(f'CASE WHEN {v} THEN {chr(39)}{k}{chr(39)} END' for k, v in _FLAGS.items())}), '') AS geo_anomaly_flags
  FROM tj JOIN transactions t USING (row_id) JOIN g USING (row_id) WHERE outcome = 'valid'""")
def silver_with_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver transactions with their ten columns of provenance."""
    return medallion.with_provenance_of(_judged(spark, sf_dir)[0], table(spark, sf_dir, "transactions"), SETTINGS).select(
        "row_id", "transaction_id", "outcome", F.upper(F.trim("currency_raw")).alias("written"), "currency_clean", "currency_conversion_required", "geo_coordinate_raw", "geo_latitude", "geo_longitude", "geo_anomaly_flags"
    )


@query("AGG19", f"SELECT count(DISTINCT {_id('transaction_id')}) AS truth, true AS within_three_percent FROM transactions")
def distinct_over_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ids over buckets by merged sketches, against the exact number."""
    t = table(spark, sf_dir, "transactions").select(identifier(F.col("transaction_id")).alias("k")).where("k is not null")
    guess = buckets.distinct_over_buckets(t, "k", 8)
    return t.agg(F.count_distinct("k").alias("truth")).crossJoin(F.broadcast(guess)).select("truth", (F.abs(F.col("distinct_keys") - F.col("truth")) <= F.col("truth") * 0.03).alias("within_three_percent"))  # one row each


@query("SRC3 SRC8 SNK1 SNK3 SNK8 SET1 PRJ1", "SELECT 'accounts' AS kind, count(*) AS rows, count(DISTINCT row_id) AS observed, CAST(NULL AS VARCHAR) AS note FROM accounts UNION ALL SELECT 'customers', count(*), count(DISTINCT row_id), NULL FROM customers")
def store_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables written as versions, twice, read back with the row counts observed, and united with a missing column."""
    store = Store(spark, scratch.new_path(spark, "store"))
    parts = []
    for name in ("accounts", "customers"):
        store.overwrite(table(spark, sf_dir, name).where("false"), name, files=2)
        seen = store.overwrite(table(spark, sf_dir, name), name, files=2)["rows"]
        parts.append(store.read(name).agg(F.lit(name).alias("kind"), F.count(F.lit(1)).alias("rows")).withColumn("observed", F.lit(seen).cast("long")))
    return parts[0].unionByName(files.with_missing(parts[1], {"note": "string"}), allowMissingColumns=True)


@query("SRC1", "SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in files.CUSTOMER_COLUMNS) + " FROM customers")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers written as CSV and read back as text (a CSV file does not tell null from empty)."""
    path = scratch.new_path(spark, "csv")
    table(spark, sf_dir, "customers").select(*files.CUSTOMER_COLUMNS).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.read_csv(spark, path).na.fill("").select(*files.CUSTOMER_COLUMNS)


@query("SRC10 SRC11", "SELECT true AS estimate_within_a_tenth, true AS sizes_add_up, true AS all_dated")
def file_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a landing file estimated from a sample of its lines, against the true number; and its fingerprints."""
    path = scratch.new_path(spark, "lines")
    raw = table(spark, sf_dir, "raw_lines").where("file_name = 'transactions.jsonl'").select("line_text")
    raw.write.text(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    guess, truth = files.estimate_rows(spark, path), raw.count()
    prints = files.fingerprints(spark, path)
    return prints.agg(F.lit(abs(guess - truth) <= 0.1 * truth).alias("estimate_within_a_tenth"), (F.sum("file_size") <= size).alias("sizes_add_up"), (F.count("file_modification_time") == F.count(F.lit(1))).alias("all_dated"))


@query("SRC7 SET3", "SELECT row_id, CAST(NULL AS VARCHAR) AS account_id, customer_id FROM customers UNION ALL SELECT row_id, account_id, NULL FROM accounts")
def multi_path_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of different columns read as one table."""
    paths = [scratch.new_path(spark, "part") for _ in range(2)]
    table(spark, sf_dir, "customers").select("row_id", "customer_id").write.parquet(paths[0])
    table(spark, sf_dir, "accounts").select("row_id", "account_id").write.parquet(paths[1])
    return files.read_union(spark, paths).select("row_id", "account_id", "customer_id")


@query("SNK4 SRC12", "SELECT 'bronze/accounts' AS table_name, 3 AS files UNION ALL SELECT 'gold/fact', 2 UNION ALL SELECT 'silver/customers', 1")
def configured_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many files tables are written to by configuration: a table's own number, its layer's, the default."""
    settings = load_settings(env={}, output_files={"default": 1, "bronze": 4, "bronze/accounts": 3, "gold": 2})
    store = Store(spark, scratch.new_path(spark, "files"))
    found = []
    for name, source in (("bronze/accounts", "accounts"), ("gold/fact", "transactions"), ("silver/customers", "customers")):
        store.overwrite(table(spark, sf_dir, source).repartition(8), name, settings.files_for(name))
        found.append((name, files.fingerprints(spark, store.location(name), "parquet").count()))
    return spark.createDataFrame(found, "table_name string, files int")


# --- beyond the reference: windows in event time, rollup, as-of
@query("extension: event-time windows", "SELECT CAST(time_bucket(INTERVAL 1 DAY, ts) AS TIMESTAMP) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return e.select(F.col("w.start").cast("timestamp_ntz").alias("day"), "event_type", "n", "total")


@query("extension: rollup", "SELECT l_returnflag AS kind, l_linestatus AS status, count(*) AS n FROM lineitem GROUP BY ROLLUP (1, 2)")
def rollup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").rollup(F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("extension: trailing totals over TPC-H-like events", """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,2))) AS total, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
s AS (SELECT user_id, min(day) AS a, max(day) AS b FROM d GROUP BY 1), g AS (SELECT user_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM s)
SELECT g.user_id AS entity, g.day, CAST(sum(coalesce(total, 0)) OVER w AS DECIMAL(38,2)) AS total_7, CAST(sum(coalesce(n, 0)) OVER w AS BIGINT) AS active_7 FROM g LEFT JOIN d USING (user_id, day) WINDOW w AS (PARTITION BY g.user_id ORDER BY g.day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def events_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestrom.operators import rolling

    daily = rolling.daily_totals(table(spark, sf_dir, "events"), "user_id", "ts", "value")
    return rolling.trailing_totals(daily, (7,)).select("entity", "day", "total_7", "active_7")

