"""Late and out-of-order events: per-period aggregates by event time that are corrected as late records arrive.

The arrival time is the clock. A period closes at its end and accepts corrections for the allowed lateness after it;
whatever arrives later is diverted for reporting. State is keyed by (key, period); each arrival period that touches a
state emits its updated aggregate as a new revision of that key, to be applied by upsert (the highest revision wins).
:mod:`lodestrom.streaming.corrections` keeps the state: it streams records through watermarked windows and judges what is in
force with the functions of this module, which by themselves do the same for a whole table at once.

Defined results
---------------
* A record delivered more than once counts once, at its earliest arrival (ties: the smallest event time).
* Records with a null identifier are each their own; those without event or arrival time get the verdict ``untimed`` and
  enter no aggregate. Clocks that run ahead (event after arrival) are in time.
* Empty tables give empty results; only the named columns are read, so that other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrom.operators.joins import skew_safe_join

ALLOWED_HOURS = 48


def first_arrivals(df: DataFrame, record: str, event: str, arrival: str, *carry: str) -> DataFrame:
    """``record, event, arrival`` and the ``carry`` columns of each record's earliest arrival (map-side combined)."""
    rows = df.select(F.col(record).alias("record"), F.col(event).alias("event"), F.col(arrival).alias("arrival"), *(F.col(c).alias(f"c_{c}") for c in carry))
    rest = [c for c in rows.columns if c not in ("record", "arrival")]
    order = F.struct(F.col("arrival").isNull(), "arrival", F.col("event").isNull(), *rest)
    named = rows.where("record is not null").groupBy("record").agg(F.min_by(F.struct("arrival", *rest), order).alias("r")).select("record", "r.*")
    return named.unionByName(rows.where("record is null"))


def judge_lateness(records: DataFrame, allowed_hours: int = ALLOWED_HOURS, period: str = "day") -> DataFrame:
    """``records`` with ``period_start`` and ``verdict``: on_time, late, too_late or untimed."""
    start = F.date_trunc(period, "event")
    end = F.date_trunc(period, "event") + F.expr(f"interval 1 {period}")
    deadline = end + F.expr(f"interval {allowed_hours} hours")
    late = F.when(F.col("event").isNull() | F.col("arrival").isNull(), "untimed").when(F.col("arrival") < end, "on_time").when(F.col("arrival") <= deadline, "late").otherwise("too_late")
    return records.withColumns({"period_start": start, "verdict": late})


def upserts(judged: DataFrame, key: str, amount: str) -> DataFrame:
    """The emitted revisions ``key, period_start, revision, emitted_by, n, total``: one per state and arrival day."""
    accepted = judged.where(F.col("verdict").isin("on_time", "late"))
    step = accepted.groupBy(F.col(key).alias("key"), "period_start", F.date_trunc("day", F.greatest("arrival", "period_start")).alias("emitted_by")).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total"))
    order = Window.partitionBy("key", "period_start").orderBy("emitted_by")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return step.select("key", "period_start", F.row_number().over(order).alias("revision"), "emitted_by", F.sum("n").over(so_far).alias("n"), F.sum("total").over(so_far).alias("total"))


def corrected(revisions: DataFrame) -> DataFrame:
    """The state after all upserts."""
    return revisions.groupBy("key", "period_start").agg(F.max_by(F.struct("revision", "n", "total"), "revision").alias("s")).select("key", "period_start", "s.*")


def diverted(judged: DataFrame) -> DataFrame:
    """What came too late or has no times, for reporting."""
    return judged.where(F.col("verdict").isin("too_late", "untimed"))


def stale_states(states: DataFrame, events: DataFrame, key: str, state_time: str, as_of: str, event: str, arrival: str) -> DataFrame:
    """Distinct keys of ``states`` whose ``state_time`` is not the latest event that had arrived by ``as_of``.

    A state without such an event is no case; a null ``state_time`` with such an event is one.
    """
    kept = states.select(F.col(key).alias("key"), F.col(state_time).alias("said"), F.col(as_of).alias("as_of")).where("key is not null and as_of is not null").distinct()
    seen = events.select(F.col(key).alias("key"), F.col(event).alias("event"), F.col(arrival).alias("arrival")).where("key is not null and event is not null and arrival is not null")
    met = skew_safe_join(seen, kept, "key", "inner").where("arrival <= as_of")
    latest = met.groupBy("key", "said", "as_of").agg(F.max("event").alias("latest"))
    return latest.where(~F.col("said").eqNullSafe(F.col("latest"))).select("key").distinct()
