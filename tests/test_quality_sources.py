"""The quality issues over all three sources, against SQL stated from the survey's definition (DQ3)."""

from __future__ import annotations

import json

import duckdb

import __spark_entry__ as entry
from lodestrom.config import Settings
from lodestrom.plans import runner
from lodestrom.sources.store import Store
from tests.conftest import DATA

_VARIANT = "count(*) FILTER (WHERE {0}) AS n, count(*) AS of FROM read_parquet('{1}/{2}.parquet')"


def counts(name: str, *columns: str) -> tuple[int, int]:
    """Rows of a table with a date in another notation, and all its rows."""
    other = " OR ".join(f"coalesce(NOT regexp_full_match(trim({c}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}'), false)" for c in columns)
    return duckdb.sql(f"SELECT {_VARIANT.format(other, DATA, name)}").fetchall()[0]


def wanted() -> dict[str, tuple[int, int]]:
    parts = [counts("transactions", "transaction_date"), counts("accounts", "open_date", "last_activity_date"), counts("customers", "dob")]
    nulls = duckdb.sql(f"SELECT count(*) FILTER (WHERE coalesce(regexp_replace(account_id, '[^\\p{{L}}\\p{{N}}]', '', 'g'), '') = ''), count(*) FROM read_parquet('{DATA}/accounts.parquet')").fetchall()[0]
    return {"DATE_FORMAT": (sum(n for n, _ in parts), sum(of for _, of in parts)), "NULL_REQUIRED": nulls}


def test_issues_are_counted_over_all_sources(spark):
    got = {r.issue: r for r in entry.queries()["dq_issues"](spark, str(DATA)).collect()}
    assert len(got) == 6
    assert {k: (got[k].affected, got[k].denominator) for k in wanted()} == wanted()
    assert got["DATE_FORMAT"].output <= got["DATE_FORMAT"].affected


def test_report_counts_raw_marks_of_all_sources(spark, tmp_path):
    tables = [spark.read.parquet(str(DATA / f"{n}.parquet")) for n in ("customers", "accounts", "transactions")]
    runner.run_batch(*tables, Store(spark, str(tmp_path)), Settings(profile_mode="off"))
    listed = {i["issue_type"]: i for i in json.loads((tmp_path / "dq_report.json").read_text())["dq_issues"]}
    for r in entry.queries()["dq_issues"](spark, str(DATA)).collect():
        if r.affected:
            assert (listed[r.issue]["records_affected"], listed[r.issue]["records_in_output"]) == (r.affected, r.output)
            assert listed[r.issue]["percentage_of_total"] == round(100 * r.affected / r.denominator, 2)
