"""References to records that do not exist.

A Bloom filter of the parent keys, broadcast to the referring rows, proves definite orphans. Only references that pass
it are verified, by an exact join with the parents' periods of life; the findings are then aggregated.

The filter is blocked: a key sets ``PROBES`` bits within one block of 64 words, so it is built by a distributed
aggregation, probed with JVM bit operations, and has one small row per block. Its size is known before it is broadcast;
beyond ``joins.BROADCAST_BYTES`` it is broadcast in parts of that size.

Defined results
---------------
* A null or blank identifier is no reference and no parent; identifiers compare by letters and digits, ignoring case.
* A parent row is live at t if ``loaded_at <= t`` and ``removed_at`` is null or later than t. A parent row without
  ``loaded_at`` is never live and does not make a reference ``deleted`` or ``late``; a reference without a time finds
  no parent live: it is ``missing`` if no parent bears the key, else ``deleted``.
* ``missing``: no parent row bears the key; ``late``: all were loaded after the time; ``deleted``: otherwise.
* Repeated referring rows all count; repeated parents count once. Empty tables: without parents each reference is
  missing, without references the result is empty. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrom import scratch
from lodestrom.functions.keys import identifier
from lodestrom.operators import joins
from lodestrom.operators.joins import skew_safe_join

WORDS, BITS_PER_KEY, PROBES = 64, 12, 4
#: Parents with more separate periods of life than this are matched by (key, month) rather than by an array of periods.
MANY_PERIODS = 64


def _positions(key: Column) -> list[Column]:
    h = F.xxhash64(F.lit("bloom"), key)
    return [F.shiftrightunsigned(h, 12 * i).bitwiseAND(F.lit(WORDS * 64 - 1)).cast("int") for i in range(PROBES)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def build_bloom(keys: DataFrame, key: str, rows: int) -> tuple[DataFrame, int]:
    """The filter of ``rows`` distinct keys as ``block, words`` (array of 64 longs), and its number of blocks."""
    blocks = max(1, -(-rows * BITS_PER_KEY // (WORDS * 64)))
    bits = keys.select(_block(F.col(key), blocks).alias("block"), F.explode(F.array(*_positions(F.col(key)))).alias("p"))
    words = bits.groupBy("block", F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, p & 63)")).alias("bits"))
    filled = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("m"))  # at most 64 entries
    return filled.select("block", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))).alias("words")), blocks


def probe_bloom(refs: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """``refs`` with ``maybe``: false proves that no parent bears the key.

    A filter beyond the limit of one broadcast is broadcast in several parts, so that the references, whatever key most of
    them bear, are never moved by their block.
    """
    bit = "(shiftright(_words[shiftright(_p[{0}], 6)], _p[{0}] & 63) & 1L) = 1"
    found = F.expr(" and ".join(bit.format(i) for i in range(PROBES)))
    per = max(1, joins.BROADCAST_BYTES // (WORDS * 8 + 64))
    probed = refs.withColumns({"_block": _block(F.col(key), blocks), "_p": F.array(*_positions(F.col(key))), "maybe": F.lit(False)})
    for first in range(0, blocks, per):
        part = bloom.where(F.col("block").between(first, first + per - 1)).select(F.col("block").alias("_block"), F.col("words").alias("_words"))
        probed = probed.join(F.broadcast(part), "_block", "left").withColumn("maybe", F.col("maybe") | F.coalesce(found, F.lit(False))).drop("_words")
    return probed.drop("_block", "_p")


def parent_lives(parents: DataFrame, key: str, loaded: str, removed: str) -> DataFrame:
    """``key, part, first, a, b, n``: the distinct parents' lives merged to disjoint periods (``b`` never null, both null for
    a parent that never lives), the earliest loading, and how many parts the key has. Two shuffles: distinct rows, then keys."""
    rows = parents.select(identifier(F.col(key)).alias("key"), F.col(loaded).alias("a"), F.col(removed).alias("b")).where("key is not null").distinct()
    far = F.lit("9999-12-31").cast("timestamp")
    order = Window.partitionBy("key").orderBy(F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last())
    until = F.when(F.col("a").isNotNull() & (F.col("b").isNull() | (F.col("b") > F.col("a"))), F.coalesce("b", far))
    rows = rows.withColumn("until", until)
    reach = F.max("until").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.col("until").isNotNull() & F.coalesce(F.col("a") > reach, F.lit(True))
    parts = rows.withColumn("_new", starts.cast("int")).withColumn("part", F.sum("_new").over(order))
    merged = parts.groupBy("key", "part").agg(F.min("a").alias("first"), F.min(F.when(F.col("until").isNotNull(), F.col("a"))).alias("a"), F.max("until").alias("b"))
    return merged.withColumn("n", F.count("b").over(Window.partitionBy("key")))


def find_orphans(refs: DataFrame, parents: DataFrame, ref_key: str, at: str, row_key: str, parent_key: str, loaded: str = "loaded_at", removed: str = "removed_at") -> DataFrame:
    """``row_id, at, orphan_type`` of the rows of ``refs`` whose reference finds no live parent at ``at``."""
    lives = parent_lives(parents, parent_key, loaded, removed)
    few = F.collect_list(F.when(F.col("b").isNotNull() & (F.col("n") <= MANY_PERIODS), F.struct("a", "b")))
    known = scratch.materialise(lives.groupBy("key").agg(F.min("first").alias("first_loaded"), few.alias("periods"), F.max(F.when(F.col("n") > MANY_PERIODS, True)).alias("many")), "parent-lives")
    n = known.count()
    bloom, blocks = build_bloom(known, "key", n)
    given = refs.select(identifier(F.col(ref_key)).alias("key"), F.col(at).alias("at"), F.col(row_key).alias("row_id")).where("key is not null")
    probed = probe_bloom(given, "key", scratch.materialise(bloom, "bloom"), blocks)
    definite = probed.where(~F.col("maybe")).select("row_id", "at", F.lit("missing").alias("orphan_type"))
    # exact check of what the filter lets pass
    checked = skew_safe_join(probed.where("maybe").drop("maybe"), known.withColumn("_there", F.lit(True)), "key", "left")
    live = F.exists("periods", lambda p: (p["a"] <= F.col("at")) & (F.col("at") < p["b"]))
    verdict = F.when(F.col("_there").isNull(), "missing").when(F.col("first_loaded") > F.col("at"), "late").otherwise("deleted")
    judged = checked.withColumn("live", F.coalesce(live, F.lit(False))).where("not live")
    result = definite.unionByName(judged.where("many is null").select("row_id", "at", verdict.alias("orphan_type")))
    if known.where("many").limit(1).count():
        month = lambda c: F.months_between(F.trunc(c, "month"), F.lit("1970-01-01").cast("date")).cast("int")
        latest = refs.agg(F.max(at).alias("m"))
        spans = lives.where((F.col("n") > MANY_PERIODS) & F.col("b").isNotNull()).join(F.broadcast(latest), F.col("a") <= F.col("m"))  # one row of one value
        spans = spans.select("key", "a", "b", F.explode(F.sequence(month(F.col("a")), month(F.least("b", "m")))).alias("mon"))
        left = judged.where("many").withColumn("mon", month(F.col("at")))
        gone = left.join(spans.withColumnRenamed("key", "k2").withColumnRenamed("mon", "m2"), (F.col("key") == F.col("k2")) & (F.col("mon") == F.col("m2")) & (F.col("a") <= F.col("at")) & (F.col("at") < F.col("b")), "left_anti")
        result = result.unionByName(gone.select("row_id", "at", verdict.alias("orphan_type")))
    return result


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans per table, period and type."""
    return found.groupBy("src_table", "ref_month", "orphan_type").agg(F.count(F.lit(1)).alias("n"))
