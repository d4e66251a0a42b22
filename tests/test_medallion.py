"""The pipeline on hand-written rows: parsing tables, one outcome per row, streams, store, buckets, reports."""

from __future__ import annotations

import json
import os
import shutil
from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrom.config import Settings, infer_stage, load_settings
from lodestrom.functions import currency, geo
from lodestrom.functions.keys import bucket_of, surrogate_key
from lodestrom.functions.parse import age_band, is_date_variant, parse_date, parse_timestamp
from lodestrom.operators import dedupe, frequency, lateness, ranks, states
from lodestrom.plans import buckets, medallion, profile, quality, validate
from lodestrom.sources import files
from lodestrom.sources.store import Store
from lodestrom.streaming import corrections, feed


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def one(spark, values, *columns):
    return {r[0]: tuple(r)[1:] for r in spark.createDataFrame([(v,) for v in values], "v string").select("v", *columns).collect()}


DATES = {
    "31/12/2024": date(2024, 12, 31), "1735603200": date(2024, 12, 31), "1735603200000": date(2024, 12, 31), " 2024-01-05 ": date(2024, 1, 5), "2024-02-30": None, "abc": None, "": None, None: None,
    "2024-1-5": None, "1/2/2024": None, "2024-01-05 10:00:00": None, "20241231": date(1970, 8, 23), "12.345": date(1970, 1, 1), "1e9": date(2001, 9, 9), "-86400": date(1969, 12, 31), "9" * 400: None,
}


def test_dates(spark):
    got = one(spark, DATES, parse_date(F.col("v")), parse_date(F.col("v"), strict=True), is_date_variant(F.col("v")), is_date_variant(F.col("v"), strict=True))
    assert {k: v[0] for k, v in got.items()} == DATES
    assert got["20241231"][1] is None and got["12.345"][1] is None and got["1735603200"][1] == date(2024, 12, 31)
    assert [got[k][2] for k in ("2024-02-30", "", None, "abc", "31/12/2024")] == [False, True, False, True, True] and not got["abc"][3] and got["31/12/2024"][3]


def test_timestamps(spark):
    cases = {"10:00:00": "2024-12-31T10:00:00", None: "2024-12-31T00:00:00", "24:00:00": None, "10:00": None, "x": None}
    got = one(spark, cases, parse_timestamp(F.lit("31/12/2024"), F.col("v")).cast("timestamp_ntz"))
    assert {k: v[0] and v[0].isoformat() for k, v in got.items()} == cases
    assert one(spark, ["10:00:00"], parse_timestamp(F.lit("bad"), F.col("v")))["10:00:00"] == (None,)


CURRENCIES = {
    "ZAR": ("ZAR", False, False, False, False), " zar ": ("ZAR", False, False, False, False), "R": ("ZAR", True, False, False, False), "rands": ("ZAR", True, False, False, False), "710": ("ZAR", True, False, False, False),
    "usd": ("USD", False, True, True, False), "978": ("978", False, True, True, False), "Bitcoin": ("BITCOIN", False, True, False, True), "": ("", False, False, False, False), None: (None, False, False, False, False),
}


def test_currencies(spark):
    c = F.col("v")
    ready = currency.readiness_columns(c)
    got = one(spark, CURRENCIES, currency.clean_currency(c), currency.is_variant(c), ready["currency_conversion_required"], ready["currency_conversion_ready"], ready["currency_unknown"])
    assert got == CURRENCIES
    assert one(spark, ["zar", "ZAR"], currency.is_variant(c, reference=False)) == {"zar": (True,), "ZAR": (False,)}


COORDINATES = {
    "-26.2041,28.0473": None, "-33.9,18.4": None, "": None, None: None, "28.0473,-26.2041": "POSSIBLE_LAT_LON_SWAP|SA_SIGN_MISMATCH|OUTSIDE_SA_BOUNDS", "26.2,28.0": "SA_SIGN_MISMATCH|OUTSIDE_SA_BOUNDS",
    "0,0": "ZERO_ZERO", "95,10": "INVALID_WORLD_BOUNDS", "-40,20": "OUTSIDE_SA_BOUNDS", "abc,1": "PARSE_FAILED", "-26.2": "PARSE_FAILED", "1,2,3": "PARSE_FAILED",
}


def test_coordinate_flags(spark):
    c = F.col("v")
    flag = lambda p: geo.flag_text(geo.flags(c, F.lit(p), geo.latitude(c), geo.longitude(c)))
    assert {k: v[0] for k, v in one(spark, COORDINATES, flag("none")).items()} == COORDINATES
    assert one(spark, ["-33.9,18.4"], flag("gauteng"), flag(" Western Cape "))["-33.9,18.4"] == ("PROVINCE_COORDINATE_MISMATCH", None)


def test_age_bands_and_keys(spark):
    day = F.lit("2024-02-29").cast("date")
    cases = {"2006-02-28": "18-25", "2006-03-01": None, "1959-02-28": "65+", "1960-01-01": "56-65", None: None}
    assert {k: v[0] for k, v in one(spark, cases, age_band(F.col("v").cast("date"), day)).items()} == cases
    assert one(spark, [None], age_band(F.col("v").cast("date"), day, reference=True))[None] == ("18-25",)
    assert all(k[0] >= 0 and 0 <= k[1] < 7 for k in one(spark, ["a", "b", None], surrogate_key(F.col("v")), bucket_of(F.col("v"), 7)).values())


# --- batch scenario: each row has exactly one outcome
def line(i, account="acc1", amount="10.00", when=("2024-01-05", "10:00:00"), **more):
    d = {"transaction_id": i, "account_id": account, "transaction_date": when[0], "transaction_time": when[1], "transaction_type": "DEBIT", "amount": amount, "currency": "ZAR", "channel": "APP", "location": {"province": "Gauteng"}} | more
    return json.dumps({k: v for k, v in d.items() if v is not ...})


LINES = [
    line("clean"), line("dup"), line("dup", when=("2024-01-05", "11:00:00")), line("same"), line("same"), line(None), line(None), line("orphan", "nobody"), line("both", "nobody", amount=None),
    line("quoted", amount="12.50"), line("number", amount=12.5), line("uncastable", amount="abc"), "{broken", line("nosub", merchant_subcategory=...), line("rand", currency=710), line("blank", channel="  "), line("dmy", when=("05/01/2024", None)),
]


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("gold")
    (tmp_path / "t.jsonl").write_text("\n".join(LINES))
    customers = spark.createDataFrame([("cust1", "Gauteng", "1980-01-01", "5", "M"), ("cust1", "Limpopo", "1980-01-01", "5", "M"), (None, "x", None, None, None)], "customer_id string, province string, dob string, risk_score string, gender string")
    customers = files.with_missing(customers, {c: "string" for c in files.CUSTOMER_COLUMNS})
    accounts = spark.createDataFrame([("acc1", "cust1", "100.00"), ("acc1", "cust1", "100.00"), (None, "cust1", "1"), ("acc2", "unknown", "1")], "account_id string, customer_ref string, current_balance string")
    accounts = files.with_missing(accounts, {c: "string" for c in files.ACCOUNT_COLUMNS})
    transactions = files.read_transactions(spark, str(tmp_path / "t.jsonl"), F.lit("2024-01-06").cast("timestamp"))
    _, split, judged = medallion.judge(customers, accounts, transactions)
    return medallion.build(customers, accounts, transactions, Settings()), judged, split


def test_every_row_has_one_outcome(gold):
    tables, judged, split = gold
    assert {r.outcome: r.n for r in quality.reconcile(judged).collect()} == {"valid": 8, "duplicate": 2, "missing_required": 6, "orphan": 1}
    assert sum(tables[t].count() for t in ("silver/transactions", "quarantine/transactions")) == len(LINES)
    assert rows(tables["quarantine/accounts"], "reason") == [("DUPLICATE_DEDUPED",), ("NULL_REQUIRED",), ("UNKNOWN_CUSTOMER",)]
    assert rows(tables["quarantine/customers"], "reason") == [("DUPLICATE_DEDUPED",), ("NULL_REQUIRED",)]
    flags = {r.transaction_id: r.dq_flag for r in tables["silver/transactions"].collect()}
    assert flags == {"clean": "TYPE_MISMATCH", "dup": "TYPE_MISMATCH", "same": "TYPE_MISMATCH", "quoted": "TYPE_MISMATCH", "number": None, "nosub": "TYPE_MISMATCH", "rand": "TYPE_MISMATCH", "dmy": "TYPE_MISMATCH"}


def test_gold_closes(spark, gold):
    tables, judged, split = gold
    fact, accounts, customers = (tables[f"gold/{t}"] for t in ("fact_transactions", "dim_accounts", "dim_customers"))
    assert fact.columns == list(medallion.FACT) and accounts.columns == list(medallion.DIM_ACCOUNT) and customers.columns == list(medallion.DIM_CUSTOMER)
    assert fact.select("transaction_sk").distinct().count() == fact.count() == 8
    assert fact.join(accounts, "account_sk", "left_anti").count() == fact.join(customers, "customer_sk", "left_anti").count() == 0
    assert validate.failures(fact, accounts, customers, types=1, provinces=1) == [] and set(validate.failures(fact, accounts, customers)) == {"1 transaction types, not 4", "accounts in 1 provinces, not 9"}
    issues = [r.asDict() for r in quality.issue_counts(judged, split.rejected).collect()]
    report = quality.report(issues, Settings(), {"transactions": len(LINES)})
    assert {i["issue_type"]: i["records_affected"] for i in report["dq_issues"]} == {"DUPLICATE_DEDUPED": 2, "ORPHANED_ACCOUNT": 1, "TYPE_MISMATCH": 14, "DATE_FORMAT": 1, "CURRENCY_VARIANT": 1, "NULL_REQUIRED": 1}
    assert json.loads(quality.to_json(report))["summary"]["total_issue_types"] == 6
    assert {i["issue_type"]: i["handling_action"] for i in report["dq_issues"]}["NULL_REQUIRED"] == "EXCLUDED_NULL_PK"
    pct = spark.range(1).select(profile.percent(F.lit(1), F.lit(3)).alias("a"), profile.percent(F.lit(None).cast("long"), F.lit(0)).alias("b")).first()
    assert (pct.a, pct.b) == (33.33, 0.0)


def test_provenance(spark):
    df = spark.createDataFrame([("usd", ("Gauteng", "-26.2,28.0"))], "currency string, location struct<province: string, coordinates: string>")
    r = medallion.with_provenance(df, Settings()).first()
    assert (r.currency_clean, r.currency_conversion_ready, r.geo_latitude, r.geo_anomaly_flags) == ("USD", True, -26.2, None)


def test_mark_first_with_hot_keys(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 3 == 0, F.concat(F.lit("k"), F.col("id") % 300)).alias("k"), (F.col("id") % 7).alias("o"), F.col("id"))
    both = df.unionByName(df.where("id < 5")).unionByName(df.where("id < 4").withColumn("k", F.lit(None).cast("string")))
    plain = {r.k: r.n for r in both.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect() if r.k}
    for floor in (1, 10**9):
        marked = dedupe.mark_first(both, "k", [F.col("o"), F.col("id")], floor=floor)
        assert marked.where("_first").groupBy("k").count().where("count <> 1").count() == 0
        assert marked.where("_first").count() == len(plain) and marked.where("_first is null").count() == 4
        assert {r.k: r.id for r in marked.where("_first").collect()} == {r.k: r.id for r in dedupe.keep_first(both.where("k is not null"), ["k"], [F.col("o"), F.col("id")]).collect()}
    assert dedupe.surplus_rows(both, "k", [F.col("o")], floor=1).count() == sum(n - 1 for n in plain.values())
    assert dedupe.keep_first_window(both, ["k"], [F.col("o")]).count() == len(plain) + 1


def test_frequencies_and_drift(spark):
    df = spark.createDataFrame([("DEBIT", "APP", "ZAR", None), ("debit ", "FAX", "R", ("X",)), ("", "FAX", "usd", ("Gauteng",)), (None, "PIGEON", None, ("Y",))], "transaction_type string, channel string, currency string, location struct<province: string>")
    exact = {r.field: tuple(r)[2:] for r in frequency.domain_metrics(df, "transactions", Settings(), exact=True).collect()}
    assert exact == {r.field: tuple(r)[2:] for r in frequency.domain_metrics(df, "transactions", Settings()).collect()}
    assert exact["transactions.channel"] == (4, 3, 3, 2) and exact["transactions.transaction_type"] == (2, 0, 1, 0) and exact["transactions.currency"] == (3, 1, 2, 1)
    marked = {r.field: (r.high_cardinality, r.review) for r in frequency.drift(frequency.domain_metrics(df, "transactions", Settings(high_cardinality=2), exact=True), Settings(high_cardinality=2)).collect()}
    assert marked["transactions.channel"] == (True, False) and marked["transactions.currency"] == (False, True)
    assert rows(frequency.top_unknown(df, "transactions", Settings(top_k=1)), "field", "value", "n") == [("channel", "FAX", 2), ("currency", "USD", 1), ("province", "X", 1)]
    assert frequency.top_values(df.where("false"), {"a": F.col("channel")}).count() == 0


def test_profile_of_nothing(spark):
    none = spark.createDataFrame([], "o_totalprice double")
    assert rows(profile.quantiles(none, F.col("o_totalprice"), 100)) == []
    assert profile.dense_patterns(spark.createDataFrame([], "a string"), ["a"], 2).first()["largest_group"] == 0


# --- store
def test_store_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), keep=2)
    with pytest.raises(FileNotFoundError):
        store.read("t")
    assert store.read("t", spark.range(1).schema).count() == 0
    for n in range(1, 5):
        store.overwrite(store.read("t", spark.range(1).schema).unionByName(spark.range(n)), "t", files=1, most=F.max("id"))
    assert store.read("t").count() == 10 and store.pointer("t")["rows"] == 10 and store.pointer("t")["most"] == 3
    assert sorted(p for p in os.listdir(tmp_path / "s" / "t") if p.startswith("v=")) == ["v=3", "v=4"]
    store.overwrite(spark.range(3), "t", batch_id=7)
    store.overwrite(spark.range(99), "t", batch_id=7)
    assert store.read("t").count() == 3
    store.overwrite(spark.range(6).withColumn("p", F.col("id") % 2), "parted", partition_by=["p"])
    assert rows(store.read("parted").where("p = 1"), "id") == [(1,), (3,), (5,)]


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a ""b"", c"\n2,\n3,4,5\n')
    assert rows(files.read_csv(spark, str(tmp_path / "a.csv")).limit(2)) == [("1", 'a "b", c'), ("2", None)]
    assert [r._corrupt for r in files.read_csv(spark, str(tmp_path / "a.csv"), ("x", "y")).orderBy("x").collect()] == [None, None, "3,4,5"]
    assert files.estimate_rows(spark, str(tmp_path / "a.csv")) == 4
    prints = files.fingerprints(spark, str(tmp_path / "a.csv")).first()
    assert prints.file_size == (tmp_path / "a.csv").stat().st_size
    spark.range(2).write.parquet(str(tmp_path / "p1"))
    spark.range(2).withColumn("b", F.lit(1)).write.parquet(str(tmp_path / "p2"))
    assert files.read_union(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")]).where("b is null").count() == 2


def test_settings(tmp_path):
    (tmp_path / "s.yaml").write_text("top_k: 9\ndomains: {customers.gender: [A]}\noutput_files: {default: 2, gold: 3, gold/fact: 4}\n")
    s = load_settings(tmp_path / "s.yaml", as_of="2030-01-01")
    assert (s.top_k, s.as_of, s.domains["customers.gender"]) == (9, "2030-01-01", ("A",)) and "transactions.channel" in s.domains
    assert [s.files_for(t) for t in ("gold/fact", "gold/dim", "silver/x")] == [4, 3, 2] and load_settings(tmp_path / "none.json", env={}) == Settings()
    assert load_settings(env={"PIPELINE_CONFIG": str(tmp_path / "s.yaml"), "OUTPUT_FILES": "7"}).files_for("gold/fact") == 7 and load_settings(env={"PIPELINE_CONFIG": str(tmp_path / "s.yaml")}).top_k == 9
    (tmp_path / "stream_1.jsonl").write_text("")
    assert [infer_stage({}, tmp_path), infer_stage({}, None, tmp_path / "s.yaml"), infer_stage({}), infer_stage({"PIPELINE_STAGE": "2"}, tmp_path)] == ["3", "2", "1", "2"]


# --- streaming
def event(i, account="acc1", amount="1.00", time="10:00:00", kind="CREDIT", currency="ZAR"):
    return json.dumps({"transaction_id": i, "account_id": account, "transaction_date": "2024-01-05", "transaction_time": time, "transaction_type": kind, "amount": amount, "currency": currency, "channel": "APP"})


FILES = {
    "stream_1.jsonl": [event("a"), event("b", time="12:00:00"), event("a"), event("x", "nobody"), event("usd", currency="USD"), event("odd", kind="GIFT"), "{broken"],
    "stream_2.jsonl": [event("a"), event("c", time="09:00:00", kind="FEE", amount="0.25")] + [event(f"n{i:02}", "acc2", time=f"08:{i:02}:00") for i in range(60)],
}


def run_stream(spark, tmp_path, order, restart):
    folder, store = tmp_path / "in", Store(spark, str(tmp_path / "store"))
    folder.mkdir(parents=True)
    store.overwrite(states.seed_balances(spark.createDataFrame([("acc1", Decimal(10)), ("acc2", Decimal(0)), ("idle", Decimal(5))], "account_id string, current_balance decimal(18,2)")), feed.BALANCES)
    for n, name in enumerate(order):
        (folder / name).write_text("\n".join(FILES[name]))
        os.utime(folder / name, (1_700_000_000 + n, 1_700_000_000 + n))
        if restart or n == len(order) - 1:
            feed.start(feed.line_stream(spark, str(folder), files_per_batch=1), store, str(tmp_path / "check")).awaitTermination()
    return store


@pytest.mark.parametrize(("order", "restart"), [(["stream_1.jsonl", "stream_2.jsonl"], False), (["stream_2.jsonl", "stream_1.jsonl"], True)])
def test_stream_state_does_not_depend_on_order_or_restarts(spark, tmp_path, order, restart):
    store = run_stream(spark, tmp_path, order, restart)
    got = {r.account_id: (r.current_balance, r.last_transaction_timestamp.astimezone(UTC).strftime("%Y %H:%M")) for r in store.read(feed.BALANCES).collect()}
    assert got["acc1"] == (Decimal("11.75"), "2024 12:00") and got["acc2"][0] == Decimal(60) and got["idle"] == (Decimal(5), "1970 00:00")
    recent = store.read(feed.RECENT)
    assert recent.where("account_id = 'acc2'").count() == 50 and recent.where("account_id = 'acc2' and transaction_id < 'n10'").count() == 0
    assert rows(recent.where("account_id = 'acc1'"), "transaction_id") == [("a",), ("b",), ("c",)]
    feed.apply_batch(store, recent, 0)  # a batch that was applied already changes nothing
    assert {r.account_id: r.current_balance for r in store.read(feed.BALANCES).collect()} == {k: v[0] for k, v in got.items()}


EVENTS = "record string, event timestamp, arrival timestamp, key string, amount decimal(18,2)"


def record(i, day, arrives, key="k", amount=1):
    return (i, *(t and datetime(2024, 1, *t, tzinfo=UTC) for t in (day, arrives)), key, Decimal(amount))


RECORDS = [
    record("1", (1, 5), (1, 6)), record("2", (1, 7), (3,), amount=2), record("3", (1, 8), (9,), amount=4), record("4", (2,), (2, 1), "m", 8), record("2", (1, 7), (2, 12), amount=2),
    record("5", (9,), (2,), "m"), record("6", None, (1,)), record("7", (1,), None), record(None, (1,), (1, 3), amount=16), record(None, (1,), (1, 3), amount=16), record("8", (1, 1), (1, 2), None, 32),
    record("moved", (2, 3), (3,), amount=64), record("moved", (1, 3), (2, 2), amount=64), record("late", (1,), (8,)), record("late", (1,), (9,)), record("saved", (1,), (8,)), record("saved", (1,), (1, 9), amount=128),
]


def outcome(judged):
    totals = lateness.corrected(lateness.upserts(judged, "c_key", "c_amount"))
    return rows(judged, "record", "verdict"), rows(totals, "key", "period_start", "n", "total")


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_stream_of_corrections_equals_batch_in_any_order(spark, tmp_path, order):
    import random

    made = list(RECORDS)
    random.Random(order).shuffle(made)
    whole = lateness.judge_lateness(lateness.first_arrivals(spark.createDataFrame(RECORDS, EVENTS), "record", "event", "arrival", "key", "amount"))
    state = corrections.CorrectionStream(spark, str(tmp_path / "state"), disorder_hours=24 * 30)
    for n, part in enumerate((made[:6], made[6:12], made[12:])):
        spark.createDataFrame(part, EVENTS).repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        if n != 1:  # stopped and started again between the first and the later batches
            corrections.CorrectionStream(spark, state.root, disorder_hours=24 * 30).run(spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in")))
    assert outcome(state.records()) == outcome(whole)
    got = dict(outcome(whole)[0])
    assert (got["2"], got["3"], got["5"], got["6"], got["late"], got["saved"]) == ("late", "too_late", "on_time", "untimed", "too_late", "on_time")
    days = {(k, d.astimezone(UTC).day): (n, t) for k, d, n, t in outcome(whole)[1]}
    assert days["k", 1] == (7, Decimal(1 + 2 + 16 + 16 + 64 + 128 + 0) + 0) or days["k", 1][1] == Decimal(227)
    assert ("k", 2) not in days  # the record that moved is on one day only


def test_replay_and_empty_tables(spark):
    df = spark.createDataFrame(RECORDS, EVENTS)
    whole = lateness.judge_lateness(lateness.first_arrivals(df, "record", "event", "arrival", "key", "amount"))
    assert outcome(corrections.replay(df, "record", "event", "arrival", "key", "amount", batches=3).records()) == outcome(whole)
    assert rows(corrections.replay(df.where("false"), "record", "event", "arrival", "key", "amount").records()) == []


def test_state_is_evicted_and_lost_records_are_noticed(spark, tmp_path):
    def feed_in(name, data):
        spark.createDataFrame(data, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))

    state = corrections.CorrectionStream(spark, str(tmp_path / "state"))
    state.run(feed_in("in", [record(str(d), (d,), (d, 1)) for d in range(1, 6)]))
    stream = feed_in("in", [record("20", (20,), (20, 1))])
    q = state.start(stream)[0]
    q.awaitTermination()
    held = [op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]]
    assert held[-1] == 1  # the windows of the first days are gone
    with pytest.raises(ValueError, match="allow more disorder"):
        state.run(feed_in("in", [record("old", (1,), (1, 2))]))


def test_watermarked_windows(spark, tmp_path):
    spark.createDataFrame([("a", datetime(2024, 1, 1, 1), 2), ("a", datetime(2024, 1, 1, 2), 3), ("b", datetime(2024, 1, 2), 4)], "k string, ts timestamp_ntz, v long").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, ts timestamp_ntz, v long").parquet(str(tmp_path / "in"))
    q = corrections.windowed_totals(stream, "ts", "v", "k").writeStream.format("memory").queryName("windowed").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("windowed"), "k", "n", "total") == [("a", 2, 5), ("b", 1, 4)]


def test_ledger_of_balances(spark):
    state = spark.createDataFrame([("a", Decimal(10), datetime(2024, 1, 5, tzinfo=UTC), datetime(2024, 1, 5, tzinfo=UTC)), ("b", None, None, None), ("c", Decimal(1), None, None)], "account_id string, current_balance decimal(18,2), last_transaction_timestamp timestamp, updated_at timestamp")
    t = datetime(2024, 1, 3, tzinfo=UTC)
    events = spark.createDataFrame([("a", "DEBIT", Decimal(3), t), ("a", "CREDIT", Decimal(1), t), ("b", "FEE", Decimal(3), t), ("x", "FEE", Decimal(3), t)], "account_id string, transaction_type string, amount decimal(18,2), transaction_timestamp timestamp")
    got = {r.account_id: (r.current_balance, r.last_transaction_timestamp and r.last_transaction_timestamp.astimezone(UTC).day, r.updated_at and r.updated_at.astimezone(UTC).day) for r in states.apply_balances(state, events, "2024-02-09 00:00:00").collect()}
    assert got == {"a": (Decimal(8), 5, 9), "b": (None, 3, 9), "c": (Decimal(1), None, None)}


def test_rank_keys(spark):
    df = spark.createDataFrame([(k,) for k in ("b", "a", None, "c", "a")], "k string")
    assert rows(ranks.rank_key(df, "k")) == [("a", 1), ("b", 2), ("c", 3)] and rows(ranks.rank_key(df.where("false"), "k")) == []


def test_versions_without_rename(spark, tmp_path, monkeypatch):
    """A writer that dies leaves the version before it in force, and nothing relies on renaming over a file."""
    store = Store(spark, str(tmp_path / "s"))
    store.overwrite(spark.range(3), "t")
    torn = tmp_path / "s" / "t" / "_pointers" / "_v000000000002.json"
    torn.write_text('{"version": 2, "sch')  # cut off in the middle
    assert store.read("t").count() == 3 and store.pointer("t")["version"] == 1
    store.overwrite(spark.range(5), "t")
    assert store.read("t").count() == 5 and store.pointer("t")["version"] == 3
    with pytest.raises(Exception, match="(?i)exists"):  # another writer took the number
        store.versions("t/_pointers").publish({}, 3)


def test_scratch_is_shared_and_deleted(spark, tmp_path, monkeypatch):
    from lodestrom import scratch

    with scratch.scope(spark):
        made = scratch.materialise(spark.range(4), "x").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(made)
    assert not os.path.exists(made)

    class Cluster:
        sparkContext = type("C", (), {"getConf": lambda self: {}, "master": "spark://host:7077"})()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Cluster())


# --- buckets
def test_buckets_resume_after_a_failure(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    df = spark.range(100).select((F.col("id") % 40).cast("string").alias("k"), "id")
    plan = buckets.preflight(1000, "fp", Settings(bucket_bytes=250))
    assert plan.buckets == 4 and plan.large and not buckets.preflight(10, "x", Settings()).large
    assert (plan.tier, buckets.preflight(10, "x", Settings()).tier, buckets.preflight(10**9, "x", Settings(), "single").tier) == ("large", "medium", "single")
    refused = buckets.preflight(10**12, "x", Settings(bucket_bytes=1 << 20))
    assert not refused.safe and "exceed" in refused.refusal and refused.buckets > 256
    with pytest.raises(ValueError, match="exceed"):
        buckets.run(store, "bronze", "silver", refused, lambda p: p)
    buckets.ingest(df, "k", plan, store, "bronze")
    seen = []

    def transform(part, fail=True):
        seen.append(part.select("k").distinct().count())
        if fail and len(seen) == 3:
            raise RuntimeError("lost")
        return dedupe.keep_first(part, ["k"], [F.col("id")])

    with pytest.raises(RuntimeError, match="lost"):
        buckets.run(store, "bronze", "silver", plan, transform, {0: 4.0, 1: 3.0, 2: 2.0, 3: 1.0})
    manifest = buckets.load_manifest(store, "silver", plan)
    assert sorted(manifest["buckets"].values()) == ["complete", "complete", "failed"] and buckets.schedule(4, manifest)[0] == 2
    done = buckets.run(store, "bronze", "silver", plan, lambda p: transform(p, fail=False))
    assert len(seen) == 5 and rows(done) == rows(dedupe.keep_first(df, ["k"], [F.col("id")]))
    assert buckets.total_rows(buckets.load_manifest(store, "silver", plan)) == 40
    assert buckets.load_manifest(store, "silver", buckets.Preflight(1, 4, "other"))["buckets"] == {}
    shutil.rmtree(store.location("silver/bucket=3"))
    assert buckets.load_manifest(store, "silver", plan)["buckets"]["3"] == "failed"  # complete, but its output is gone
    redone = buckets.run(store, "bronze", "silver", plan, lambda p: transform(p, fail=False))
    assert rows(redone) == rows(dedupe.keep_first(df, ["k"], [F.col("id")])) and len(seen) == 6
    assert set(buckets.expected_work(store, "bronze", plan, buckets.load_manifest(store, "silver", plan))) == {0, 1, 2, 3}
    assert buckets.schedule(3, {"buckets": {"0": "complete"}}, {1: 1.0, 2: 5.0}) == [2, 1]
    assert buckets.distinct_over_buckets(df, "k", 4).first()[0] == 40
