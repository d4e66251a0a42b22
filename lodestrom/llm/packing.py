"""Filling containers of fixed capacity with items, by large-item matching.

Sizes are whole numbers up to the capacity, so the plan needs only the *histogram* of sizes: at most ``capacity`` counts,
however many documents there are. From it the plan is made on the driver:

1. items above a third of the capacity go at most two to a container; greedily, the largest with the largest that fits;
2. smaller items, largest first, go to the smallest gap that takes them (best fit), else to a new container.

Equal containers are kept as one group with a count, so the plan, too, is bounded by the capacity. Documents then find
their place by their rank among documents of the same size, which is computed in buckets: a size shared by a third of
all rows is ranked by as many tasks as it needs.

Defined results
---------------
* A document's size is its UTF-8 bytes plus one end token. Null texts have no size and are not packed; empty ones have 1.
* A document larger than the capacity is cut at multiples of it; full pieces fill a container each, the rest is an item.
* A repeated row (same id and size) is packed once; one id with texts of several sizes is packed once per size.
* Empty tables give empty results. Only the two named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrom import scratch

CAPACITY = 2048
#: Rows per bucket in which ranks are computed.
RANK_ROWS = 50_000
#: A container group: how many containers, and how many items of each size one of them holds.
Group = tuple[int, dict[int, int]]


def byte_tokens(text: Column) -> Column:
    """Tokens of a text in a byte vocabulary with one end token."""
    return F.octet_length(text) + 1


def plan_containers(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Container groups that hold ``counts`` items of each size (all within the capacity)."""
    left = {s: n for s, n in counts.items() if n > 0}
    if any(not 0 < s <= capacity for s in left):
        raise ValueError("sizes must lie within the capacity")
    done: list[Group] = []
    gaps: list[int] = []  # sorted, distinct
    open_groups: dict[int, list[Group]] = {}

    def keep(gap: int, n: int, held: dict[int, int]) -> None:
        if n <= 0:
            return
        if gap == 0:
            done.append((n, held))
            return
        if gap not in open_groups:
            open_groups[gap] = []
            insort(gaps, gap)
        open_groups[gap].append((n, held))

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        s = large[-1]
        j = bisect_left(large, capacity - s + 1) - 1  # the largest that fits beside it
        if j < 0:
            keep(capacity - s, left[s], {s: 1})
            large.pop()
        elif large[j] == s:
            pairs, single = divmod(left[s], 2)
            keep(capacity - 2 * s, pairs, {s: 2})
            large.pop()
            left[s] = single
            if single:  # one is left: with the largest smaller one, if any
                if large:
                    t = large[-1]
                    keep(capacity - s - t, 1, {s: 1, t: 1})
                    left[t] -= 1
                    if not left[t]:
                        large.pop()
                else:
                    keep(capacity - s, 1, {s: 1})
        else:
            t = large[j]
            n = min(left[s], left[t])
            keep(capacity - s - t, n, {s: 1, t: 1})
            for x in (s, t):
                left[x] -= n
                if not left[x]:
                    large.remove(x)
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[s]
        while n:
            i = bisect_left(gaps, s)
            if i == len(gaps):
                keep(capacity, -(-n // (capacity // s)), {})
                continue
            gap = gaps[i]
            count, held = open_groups[gap].pop()
            if not open_groups[gap]:
                del open_groups[gap], gaps[i]
            each = gap // s
            full = min(count, n // each)
            keep(gap - each * s, full, held | {s: each})
            n -= full * each
            if full < count and n:
                keep(gap - n * s, 1, held | {s: n})
                full, n = full + 1, 0
            keep(gap, count - full, held)
    return done + [g for groups in open_groups.values() for g in groups if g[1]]


def _segments(plan: list[Group]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each size: first rank, items per container and first container of each group that holds it."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    base = 0
    for n, held in plan:
        for s, each in held.items():
            found.setdefault(s, []).append((ranks.get(s, 0), each, base))
            ranks[s] = ranks.get(s, 0) + n * each
        base += n
    return {s: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for s, rows in found.items()}


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, tokens, piece, start, size``: one row per document, or per piece of one that exceeds the capacity."""
    sized = docs.select(F.col(doc_id).cast("long").alias("doc_id"), byte_tokens(F.col(text)).cast("long").alias("tokens")).where("tokens is not null").distinct()
    cut = sized.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {capacity}"))))
    return cut.withColumn("start", F.col("piece") * capacity).withColumn("size", F.least(F.col("tokens") - F.col("start"), F.lit(capacity)))


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``container, doc_id, tokens, piece, start, size``: the container of every document or piece."""
    items = scratch.materialise(pieces(docs, doc_id, text, capacity), "pack-items")
    counts = {r["size"]: r["n"] for r in items.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    plan = plan_containers(counts, capacity)
    segments = _segments(plan)
    buckets = max(1, -(-sum(counts.values()) // RANK_ROWS))
    spread = items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = spread.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n"))  # at most capacity x buckets rows
    before = F.coalesce(F.sum("n").over(Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("size", "bucket", before.alias("offset"))
    within = F.row_number().over(Window.partitionBy("size", "bucket").orderBy("doc_id", "tokens", "piece"))
    ranked = spread.withColumn("_r", within).join(offsets, ["size", "bucket"]).select("doc_id", "tokens", "piece", "start", "size", (F.col("offset") + F.col("_r") - 1).alias("rank"))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            container = np.zeros(len(f), np.int64)
            for s, rows in f.groupby("size").indices.items():
                first, each, base = segments[s]
                rank = f["rank"].to_numpy()[rows]
                g = np.searchsorted(first, rank, "right") - 1
                container[rows] = base[g] + (rank - first[g]) // each[g]
            yield f.drop(columns="rank").assign(container=container)[["container", "doc_id", "tokens", "piece", "start", "size"]]

    return ranked.mapInPandas(place, "container long, doc_id long, tokens long, piece long, start long, size long")


def split_documents(packed: DataFrame) -> DataFrame:
    """Ids of the documents that were split."""
    return packed.where("piece > 0").select("doc_id").distinct()


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Containers, items, tokens, the least number of containers that could hold them, and the share filled."""
    per = packed.groupBy("container").agg(F.sum("size").alias("used"), F.count(F.lit(1)).alias("n"))
    total = per.agg(F.count(F.lit(1)).alias("containers"), F.sum("n").alias("items"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    return total.withColumns({"least": F.ceil(F.col("tokens") / capacity), "filled": F.col("tokens") / (F.col("containers") * capacity)})


def pack_checks(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row of what must hold of any packing: items, tokens, whether no container holds more than the capacity, whether
    each piece lies in one container, whether pieces of a document tile it, and whether only documents beyond the capacity
    were split."""
    per = packed.groupBy("container").agg(F.sum("size").alias("used"))
    pieces_of = packed.groupBy("doc_id", "tokens").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("piece").alias("pieces"), F.sum("size").alias("size"), F.max(F.col("start") + F.col("size")).alias("end"))
    facts = pieces_of.agg(
        F.sum("n").alias("items"), F.sum("size").alias("tokens"), F.every(F.col("n") == F.col("pieces")).alias("one_place_each"),
        F.every((F.col("size") == F.col("tokens")) & (F.col("end") == F.col("tokens"))).alias("tiled"), F.every((F.col("n") == 1) | (F.col("tokens") > capacity)).alias("split_only_if_larger"),
    )
    return facts.crossJoin(per.agg(F.every(F.col("used") <= capacity).alias("within_capacity"), (F.sum("used") >= F.count(F.lit(1)) * capacity * 0.97).alias("nearly_full")))  # one row each
