"""Whole runs over the small tables: at once, in buckets, from files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lodestrom.config import Settings
from lodestrom.operators import dedupe
from lodestrom.plans import buckets, runner
from lodestrom.sources.store import Store
from tests.conftest import DATA


def test_batch_and_buckets_agree(spark, tmp_path):
    tables = [spark.read.parquet(str(DATA / f"{n}.parquet")) for n in ("customers", "accounts", "transactions")]
    once, parts = Store(spark, str(tmp_path / "once")), Store(spark, str(tmp_path / "parts"))
    a = runner.run_batch(*tables, once, Settings(provinces=8))
    b = runner.run_bucketed(*tables, parts, Settings(profile_mode="off", provinces=8), buckets.Preflight(0, 3, "x"))
    assert a.failures == b.failures == [] and {k: v for k, v in a.rows.items()} == {k: b.rows[k] for k in a.rows}
    assert a.rows["silver/transactions"] + a.rows["quarantine/transactions"] == a.rows["bronze/transactions"]
    key = lambda s: sorted(s.read("gold/fact_transactions").select("transaction_sk", "account_sk", F.col("dq_flag")).collect(), key=str)
    assert key(once) == key(parts)
    report = json.loads((tmp_path / "once" / "dq_report.json").read_text())
    assert report["record_counts"]["bronze/transactions"] == a.rows["bronze/transactions"] and report["dq_issues"]
    audit = json.loads((tmp_path / "once" / "audit.json").read_text())
    assert audit["metrics"]["transactions"]["rows"] == a.rows["bronze/transactions"]
    assert not (tmp_path / "parts" / "audit.json").exists()
    told = json.loads((tmp_path / "parts" / "performance.json").read_text())
    assert told["preflight"]["tier"] == "large" and {w["table"] for w in told["writes"]} == set(b.rows) and all(w["bytes"] > 0 for w in told["writes"])
    assert [p["phase"] for p in json.loads((tmp_path / "once" / "performance.json").read_text())["phases"]] == ["bronze", "silver and gold", "validation", "report", "audit"]


def test_run_from_files(spark, tmp_path):
    (tmp_path / "customers.csv").write_text("customer_id,province\nc1,Gauteng\n")
    (tmp_path / "accounts.csv").write_text("account_id,customer_ref,current_balance\na1,c1,5\n")
    (tmp_path / "transactions.jsonl").write_text('{"transaction_id": "t1", "account_id": "a1", "transaction_date": "2024-01-05", "transaction_type": "FEE", "amount": 1.5, "currency": "R", "channel": "APP"}\nbroken\n')
    run = runner.run_batch(*runner.read_sources(spark, str(tmp_path)), Store(spark, str(tmp_path / "out")), Settings(provinces=1), types=1)
    assert run.failures == [] and run.rows["gold/fact_transactions"] == 1 and run.rows["quarantine/transactions"] == 1


def test_optional_phases_may_fail():
    run = runner.RunContext()
    with run.phase("optional", may_fail=True):
        raise ValueError("no")
    with pytest.raises(ValueError, match="yes"), run.phase("needed"):
        raise ValueError("yes")
    assert [p["error"] for p in run.phases] == ["ValueError: no", "ValueError: yes"]


def test_more_buckets_than_one_part_of_the_manifest_holds(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    df = spark.range(200).select((F.col("id") % 70).cast("string").alias("k"), "id")
    plan = buckets.preflight(600, "fp", Settings(bucket_bytes=100, most_buckets=3))
    assert (plan.buckets, plan.parts, plan.safe) == (6, 2, True) and not buckets.preflight(1000, "fp", Settings(bucket_bytes=100, most_buckets=3)).safe
    assert buckets.preflight(307 * (2 << 20), "fp", Settings(bucket_bytes=2 << 20)).safe
    buckets.ingest(df, "k", plan, store, "bronze")
    first = lambda part: dedupe.keep_first(part, ["k"], [F.col("id")])
    lost = store.read("bronze").where("_bucket = 4").first()["k"]

    def transform(part):
        if part.where(F.col("k") == lost).count():
            raise RuntimeError("lost")
        return first(part)

    with pytest.raises(RuntimeError, match="lost"):
        buckets.run(store, "bronze", "silver", plan, transform, {b: 6.0 - b for b in range(6)}, workers=2)
    states = buckets.load_manifest(store, "silver", plan)["buckets"]
    assert states["4"] == "failed" and {states[str(b)] for b in range(4)} == {"complete"}
    before = {b: store.pointer(f"silver/bucket={b}")["version"] for b in range(4)}
    done = buckets.run(store, "bronze", "silver", plan, first, workers=2)
    assert sorted(done.collect()) == sorted(first(df).collect()) and done.count() == 70
    assert before == {b: store.pointer(f"silver/bucket={b}")["version"] for b in range(4)}
    assert buckets.total_rows(buckets.load_manifest(store, "silver", plan)) == 70


def test_whole_run_with_more_buckets_than_one_part_of_the_manifest_holds(spark, tmp_path):
    tables = [spark.read.parquet(str(DATA / f"{n}.parquet")) for n in ("customers", "accounts", "transactions")]
    settings = Settings(profile_mode="off", provinces=8, bucket_bytes=100, most_buckets=2)
    plan, store = buckets.preflight(300, "x", settings), Store(spark, str(tmp_path / "parts"))
    run = runner.run_auto(*tables, store, settings, plan)
    assert (plan.buckets, plan.parts) == (3, 2) and run.failures == []
    assert run.rows["silver/transactions"] + run.rows["quarantine/transactions"] == run.rows["bronze/transactions"] == tables[2].count()
    assert set(buckets.load_manifest(store, "judged", plan)["buckets"].values()) == {"complete"}
