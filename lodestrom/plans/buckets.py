"""Resumable batch in hash buckets: each bucket is a partition of the input, transformed and committed on its own.

Duplicates of an id share a bucket, so transforming bucket by bucket gives the same rows as all at once. A numbered manifest
in the store says which buckets are complete for which input; a run resumes with those that were active or failed, or whose
output is gone, then takes the rest by the work they are expected to be. Metrics that add up are summed over buckets;
distinct counts merge as sketches.

A manifest is kept in parts of at most ``most_buckets`` buckets, so that committing a bucket rewrites a bounded document
however many there are, and a bucket is read from its own folder alone. Small buckets run side by side.
"""

from __future__ import annotations

import math
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import asdict, dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrom.config import Settings
from lodestrom.functions.keys import bucket_of
from lodestrom.sources import files
from lodestrom.sources.store import Store
from lodestrom.sources.versions import Versions

BUCKET = "_bucket"
#: Where Linux control groups state their limits (version 2, then 1).
_LIMITS = {"memory_limit_bytes": ("/sys/fs/cgroup/memory.max", "/sys/fs/cgroup/memory/memory.limit_in_bytes")}


@dataclass(frozen=True)
class Preflight:
    """What a bucketed run is about to do. ``fingerprint`` names the input; ``limits`` is what the machine allows."""

    input_bytes: int
    buckets: int
    fingerprint: str
    mode: str = "adaptive"
    refusal: str | None = None
    rows: int | None = None
    limits: dict[str, int] = field(default_factory=dict)
    per_part: int = Settings.most_buckets

    @property
    def parts(self) -> int:
        """Parts of the manifest."""
        return math.ceil(self.buckets / self.per_part)

    @property
    def tier(self) -> str:
        """``single`` for a run at once by choice, ``medium`` for one bucket, ``large`` for several."""
        return "single" if self.mode == "single" else "large" if self.buckets > 1 else "medium"

    @property
    def large(self) -> bool:
        """Whether the input goes through buckets."""
        return self.tier == "large"

    @property
    def safe(self) -> bool:
        return self.refusal is None

    def report(self) -> dict[str, Any]:
        return asdict(self) | {"tier": self.tier, "safe": self.safe}


def resource_limits() -> dict[str, int]:
    """The memory limit of the control group, as far as it can be read."""
    found = {}
    for name, paths in _LIMITS.items():
        texts = (p.read_text().strip() for p in map(Path, paths) if p.exists())
        found |= {name: int(t) for t in texts if t.isdigit() and name not in found}
    return found


def preflight(input_bytes: int, fingerprint: str, settings: Settings, mode: str = "adaptive", buckets: int | None = None, rows: int | None = None) -> Preflight:
    """As many buckets as the input needs, or as are asked for, in a manifest of as many parts as they need. A run that would
    need more than ``most_buckets`` parts of ``most_buckets`` is refused rather than squeezed into fewer, larger buckets:
    raise ``bucket_bytes`` or the limit."""
    wanted = buckets or (max(1, math.ceil(input_bytes / settings.bucket_bytes)) if mode == "adaptive" else 1)
    most = settings.most_buckets**2
    refusal = f"{wanted} buckets exceed the limit of {most}" if wanted > most else None
    return Preflight(input_bytes, wanted, fingerprint, mode, refusal, rows, resource_limits(), settings.most_buckets)


def preflight_files(spark: SparkSession, paths: list[str], settings: Settings, mode: str = "adaptive", kind: str = "text") -> Preflight:
    """The same for files: their sizes, and a fingerprint of their names, sizes and times of change. For text files the
    rows are estimated."""
    found = sorted((r.file_path, r.file_size, str(r.file_modification_time)) for p in paths for r in files.fingerprints(spark, p, kind).collect())  # one row a file
    size = sum(n for _, n, _ in found)
    return preflight(size, str(found), settings, mode, rows=sum(files.estimate_rows(spark, p) for p in paths) if kind == "text" else None)


def _check(plan: Preflight) -> None:
    if not plan.safe:
        raise ValueError(plan.refusal)


def ingest(df: DataFrame, key: str | Column, plan: Preflight, store: Store, table: str) -> None:
    """Write the input once, partitioned by bucket; rows of a bucket are gathered so that each writes few files.

    ``key`` must be what rows are compared by: where spellings of one id differ, its normal form.
    """
    _check(plan)
    store.overwrite(df.withColumn(BUCKET, bucket_of(F.col(key) if isinstance(key, str) else key, plan.buckets)).repartition(plan.buckets, BUCKET), table, partition_by=[BUCKET])


def expected_work(store: Store, source: str, plan: Preflight, manifest: dict, rows: int | None = None) -> dict[int, float]:
    """The work to expect of each bucket: what it took before, else its rows before or by its share of the bytes, else its bytes."""
    root, fs = store._path(store.location(source))
    sizes = {}
    for b in range(plan.buckets):
        p, _ = store._path(f"{root}/{BUCKET}={b}")
        sizes[b] = fs.getContentSummary(p).getLength() if fs.exists(p) else 0
    total = sum(sizes.values())
    known = manifest.get("metrics", {})
    work = {}
    for b, size in sizes.items():
        before = known.get(str(b), {})
        by_bytes = rows * size / total if rows and total else float(size)
        work[b] = float(before.get("seconds") or before.get("rows") or by_bytes)
    return work


def schedule(buckets: int, manifest: dict, weights: dict[int, float] | None = None) -> list[int]:
    """Buckets still to do: active first, then failed, then by weight."""
    state, weights = manifest.get("buckets", {}), weights or {}
    rank = {"active": 0, "failed": 1}
    todo = [b for b in range(buckets) if state.get(str(b)) != "complete"]
    return sorted(todo, key=lambda b: (rank.get(state.get(str(b), ""), 2), -weights.get(b, 0.0), b))


def _logs(store: Store, table: str, plan: Preflight) -> list[Versions]:
    return [store.versions(f"{table}/_manifest" + (f"-{k}" if k else "")) for k in range(plan.parts)]


def load_manifest(store: Store, table: str, plan: Preflight) -> dict:
    """The manifest of this input, of all its parts, or a fresh one if there is none or it belongs to another input. A bucket
    whose output is gone counts as failed, whatever the manifest says."""
    whole: dict[str, Any] = {"fingerprint": plan.fingerprint, "count": plan.buckets, "buckets": {}, "metrics": {}}
    for log in _logs(store, table, plan):
        part = log.latest() or {}
        if part.get("fingerprint") == plan.fingerprint and part.get("count") == plan.buckets:
            whole["buckets"] |= part["buckets"]
            whole["metrics"] |= part["metrics"]
    for b, state in whole["buckets"].items():
        if state == "complete" and not store.exists(f"{table}/bucket={b}"):
            whole["buckets"][b] = "failed"
    return whole


def read_bucket(store: Store, source: str, bucket: int) -> DataFrame:
    """The rows of one bucket, from its own folder: no other bucket is listed."""
    fields = T.StructType.fromJson(store.pointer(source)["schema"]).fields
    schema = T.StructType([f for f in fields if f.name != BUCKET])
    path = f"{store.location(source)}/{BUCKET}={bucket}"
    p, fs = store._path(path)
    return store.spark.read.schema(schema).parquet(path) if fs.exists(p) else store.spark.createDataFrame([], schema)


def at_once(spark: SparkSession, plan: Preflight) -> int:
    """How many buckets may run side by side: as many as there are cores, while together they hold no more than one bucket of
    the default size."""
    share = max(1, plan.input_bytes // plan.buckets)
    return max(1, min(spark.sparkContext.defaultParallelism, Settings.bucket_bytes // share))


def run(store: Store, source: str, target: str, plan: Preflight, transform: Callable[[DataFrame], DataFrame], weights: dict[int, float] | None = None, workers: int = 1) -> DataFrame:
    """Transform every bucket that is not complete and return all of them; raises after marking a bucket that fails.

    ``workers`` buckets run at a time. After a failure none is begun; those that run are finished and committed.
    """
    _check(plan)
    manifest, logs = load_manifest(store, target, plan), _logs(store, target, plan)
    guard, failed = threading.Lock(), threading.Event()

    def note(b: int, state: str, **metrics: float) -> None:
        with guard:
            manifest["buckets"][str(b)] = state
            if metrics:
                manifest["metrics"][str(b)] = metrics
            part = b // plan.per_part
            mine = {str(k) for k in range(part * plan.per_part, (part + 1) * plan.per_part)}
            logs[part].publish(manifest | {k: {b: v for b, v in manifest[k].items() if b in mine} for k in ("buckets", "metrics")})

    def one(b: int) -> None:
        if failed.is_set():
            return
        note(b, "active")
        began = time.perf_counter()
        try:
            done = store.overwrite(transform(read_bucket(store, source, b)), f"{target}/bucket={b}")
        except Exception:
            failed.set()
            note(b, "failed")
            raise
        note(b, "complete", rows=done["rows"], seconds=round(time.perf_counter() - began, 3))

    with ThreadPoolExecutor(workers) as pool:
        futures = [pool.submit(one, b) for b in schedule(plan.buckets, manifest, weights or expected_work(store, source, plan, manifest, plan.rows))]
        wait(futures)
    for f in futures:
        f.result()
    return files.read_union(store.spark, [store.location(f"{target}/bucket={b}") for b in range(plan.buckets)])


def total_rows(manifest: dict) -> int:
    """Rows over all buckets."""
    return sum(m["rows"] for m in manifest["metrics"].values())


def distinct_over_buckets(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Distinct keys, from one sketch per bucket merged: unlike the buckets' counts, sketches add up."""
    per = df.groupBy(bucket_of(F.col(key), buckets).alias(BUCKET)).agg(F.hll_sketch_agg(F.col(key), 14).alias("sketch"))
    return per.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_keys"))
