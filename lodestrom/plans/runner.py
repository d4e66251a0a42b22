"""Whole runs: bronze, silver, gold, reports and the validation gate, timed by phase, at once or in resumable buckets.

A run keeps its numbers in a :class:`RunContext` of its own, so that several runs in one process do not mix.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrom.config import Settings
from lodestrom.functions.keys import identifier
from lodestrom.operators import frequency
from lodestrom.plans import buckets, medallion, profile, quality, validate
from lodestrom.sources import files
from lodestrom.sources.store import Store

#: Where Linux control groups tell what the process has used (version 2, then 1).
_CGROUP = {"memory_peak_bytes": ("/sys/fs/cgroup/memory.peak", "/sys/fs/cgroup/memory/memory.max_usage_in_bytes"), "memory_bytes": ("/sys/fs/cgroup/memory.current", "/sys/fs/cgroup/memory/memory.usage_in_bytes"), "memory_limit_bytes": ("/sys/fs/cgroup/memory.max", "/sys/fs/cgroup/memory/memory.limit_in_bytes")}


def usage() -> dict[str, int]:
    """What the control group says, as far as it can be read."""
    found = {}
    for name, paths in _CGROUP.items():
        for p in map(Path, paths):
            try:
                text = p.read_text().strip()
            except OSError:
                continue
            if text.isdigit():
                found[name] = int(text)
                break
    return found


@dataclass
class RunContext:
    """Phases, row counts and problems of one run."""

    phases: list[dict[str, Any]] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    failures: list[str] = field(default_factory=list)
    writes: list[dict[str, Any]] = field(default_factory=list)

    @contextmanager
    def phase(self, name: str, may_fail: bool = False) -> Iterator[None]:
        """Time a phase; an error in an optional one is noted and the run goes on."""
        began, error, before = time.perf_counter(), None, usage()
        try:
            yield
        except Exception as e:
            error = f"{type(e).__name__}: {e}"[:500]
            if not may_fail:
                raise
        finally:
            after = usage()
            deltas = {f"{k}_delta": after[k] - before[k] for k in after if k in before}
            self.phases.append({"phase": name, "seconds": round(time.perf_counter() - began, 3), "error": error} | after | deltas)

    def write(self, store: Store, df: DataFrame, name: str, files: int | None = None) -> None:
        """Write a table, noting its rows, its time and its size."""
        began = time.perf_counter()
        self.rows[name] = store.overwrite(df, name, files)["rows"]
        p, fs = store._path(store.location(name))
        self.writes.append({"table": name, "rows": self.rows[name], "seconds": round(time.perf_counter() - began, 3), "bytes": fs.getContentSummary(p).getLength()})


def read_sources(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``customers.csv``, ``accounts.csv`` and ``transactions.jsonl`` of a folder."""
    return (
        files.with_missing(files.read_csv(spark, f"{folder}/customers.csv"), {c: "string" for c in files.CUSTOMER_COLUMNS}),
        files.with_missing(files.read_csv(spark, f"{folder}/accounts.csv"), {c: "string" for c in files.ACCOUNT_COLUMNS}),
        files.read_transactions(spark, f"{folder}/transactions.jsonl"),
    )


def _rows(df: DataFrame) -> list[dict[str, Any]]:
    return [r.asDict() for r in df.collect()]  # aggregates of a handful of rows


def audit(store: Store, settings: Settings) -> dict[str, Any]:
    """The audit profile of the bronze tables: ``light`` has the metrics, ``full`` also top values and cross-table checks."""
    c, a, t = (store.read(f"bronze/{n}") for n in ("customers", "accounts", "transactions"))
    metrics = {"customers": profile.long_form(c, profile.customer_metrics(settings)), "accounts": profile.long_form(a, profile.account_metrics(settings)), "transactions": profile.long_form(t, profile.transaction_metrics(settings))}
    document: dict[str, Any] = {"mode": settings.profile_mode, "metrics": {k: {r["metric"]: r["n"] for r in _rows(v)} for k, v in metrics.items()}}
    drifting = [frequency.drift(frequency.domain_metrics(df, n, settings), settings) for n, df in (("customers", c), ("accounts", a), ("transactions", t))]
    document["domain_drift"] = [r for d in drifting for r in _rows(d)]
    if settings.profile_mode == "full":
        document["top_unknown"] = {n: _rows(frequency.top_unknown(df, n, settings)) for n, df in (("customers", c), ("accounts", a), ("transactions", t))}
        document["unknown_customers"] = profile.unknown_references(a, c, "customer_ref", "customer_id").count()
        document["unknown_accounts"] = profile.unknown_references(t, a, "account_id", "account_id").count()
        document["other_provinces"] = profile.province_mismatches(t, a, c).count()
        document["dense_patterns"] = _rows(profile.dense_patterns(t, ["account_id", "transaction_type", "channel"], settings.repeat_pattern))
    return document


def run_batch(customers: DataFrame, accounts: DataFrame, transactions: DataFrame, store: Store, settings: Settings, types: int = 4) -> RunContext:
    """All tables and reports under the store's root; raises nothing for what validation finds, but lists it."""
    run = RunContext()
    with run.phase("bronze"):
        for name, df in (("customers", customers), ("accounts", accounts), ("transactions", transactions)):
            run.write(store, df, f"bronze/{name}", settings.files_for(f"bronze/{name}"))
    with run.phase("silver and gold"):
        c, a, judged = medallion.judge(*(store.read(f"bronze/{n}") for n in ("customers", "accounts", "transactions")))
        for name, df in medallion.tables(c, a, judged, settings).items():
            run.write(store, df, name, settings.files_for(name))
    _finish(run, store, settings, types, judged)
    return run


def run_bucketed(customers: DataFrame, accounts: DataFrame, transactions: DataFrame, store: Store, settings: Settings, plan: buckets.Preflight, types: int = 4) -> RunContext:
    """The same result with the transactions transformed bucket by bucket; a run that was cut off resumes."""
    run = RunContext()
    fresh = buckets.load_manifest(store, "judged", plan)["buckets"] == {}
    if fresh:
        with run.phase("bronze"):
            for name, df in (("customers", customers), ("accounts", accounts), ("transactions", transactions)):
                run.write(store, df, f"bronze/{name}")
    with run.phase("dimensions"):
        c = medallion.silver_customers(store.read("bronze/customers"))
        run.write(store, c.valid, "silver/customers")
        a = medallion.silver_accounts(store.read("bronze/accounts"), store.read("silver/customers"))
        run.write(store, a.valid, "silver/accounts")
    known = store.read("silver/accounts")
    if fresh:
        with run.phase("ingest"):  # the accounts are met here, once, and not by every bucket
            buckets.ingest(medallion.mark_known(store.read("bronze/transactions"), known), identifier(F.col("transaction_id")), plan, store, "bronze/bucketed")
    with run.phase("buckets"):
        judged = buckets.run(store, "bronze/bucketed", "judged", plan, medallion.judged_transactions, workers=buckets.at_once(store.spark, plan))
    with run.phase("gold"):
        t = medallion.silver_transactions(judged)
        dims_c, dims_a = medallion.dim_customers(store.read("silver/customers"), settings), medallion.dim_accounts(known)
        out = {"silver/transactions": t.valid, "quarantine/customers": c.rejected, "quarantine/accounts": a.rejected, "quarantine/transactions": t.rejected, "gold/dim_customers": dims_c, "gold/dim_accounts": dims_a}
        for name, df in out.items():
            run.write(store, df, name, settings.files_for(name))
        fact = medallion.fact_transactions(store.read("silver/transactions"), store.read("gold/dim_accounts"), store.read("gold/dim_customers"))
        run.write(store, fact, "gold/fact_transactions", settings.files_for("gold/fact_transactions"))
    _finish(run, store, settings, types, judged, plan)
    return run


def run_auto(customers: DataFrame, accounts: DataFrame, transactions: DataFrame, store: Store, settings: Settings, plan: buckets.Preflight, types: int = 4) -> RunContext:
    """The run that the preflight asks for: in buckets if the input is large, else at once; a refused one raises."""
    if not plan.safe:
        raise ValueError(plan.refusal)
    if plan.large:
        return run_bucketed(customers, accounts, transactions, store, settings, plan, types)
    return run_batch(customers, accounts, transactions, store, settings, types)


def _finish(run: RunContext, store: Store, settings: Settings, types: int, judged: DataFrame, plan: buckets.Preflight | None = None) -> None:
    gold = [store.read(f"gold/{t}") for t in ("fact_transactions", "dim_accounts", "dim_customers")]
    with run.phase("validation"):
        run.failures += validate.failures(*gold, types=types, provinces=settings.provinces)
    with run.phase("report"):
        # the judged rows carry their raw marks: a row with several counts for each of them
        issues = _rows(quality.source_issues(judged, *(store.read(f"{layer}/{n}") for layer in ("bronze", "silver") for n in ("customers", "accounts"))))
        store.write_text(f"{store.root}/dq_report.json", quality.to_json(quality.report(issues, settings, run.rows)))
    if settings.profile_mode != "off":
        with run.phase("audit", may_fail=True):
            store.write_text(f"{store.root}/audit.json", quality.to_json(audit(store, settings)))
    store.write_text(f"{store.root}/performance.json", quality.to_json({"phases": run.phases, "rows": run.rows, "writes": run.writes, "failures": run.failures, "preflight": plan.report() if plan else None}))
