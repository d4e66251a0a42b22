"""Totals and averages over trailing periods for every entity and day, idle days too.

Amounts are aggregated to one row per entity and active day. Entities are crossed with a calendar: each entity meets the
days between its own first and last one. The calendar is cut into blocks, so that the crossing is an equi-join on the
block and costs the days of the result, not entities x all days there are. Totals are then window sums over a fixed
number of preceding rows (``rowsBetween(-6, 0)`` for 7 days), which the calendar makes the same as days.

The one shuffle is that of the active days: they are spread by entity before they are crossed, so the dense rows, which
are many times more, are made and summed where they are. The number of tasks follows the number of dense rows.

Defined results
---------------
* Rows with a null entity, day or amount are ignored. Repeated rows all count: deduplicate before.
* Totals are exact decimals; the average divides by the length of the period, also at the start of an entity's calendar.
* ``active_<n>`` is the number of source rows in the period. An empty table gives an empty result.
* Only the three named columns are read, so other columns may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrom import scratch
from lodestrom.operators.joins import broadcast_if_small

#: Days in a block of the calendar, and dense rows that one task sorts and sums.
BLOCK_DAYS, TASK_ROWS = 64, 1_500_000
#: Cents in a unit. Totals are summed as whole numbers (see ``_Form``), because window sums of long decimals are slow.
_UNIT = 10**12


def daily_totals(df: DataFrame, entity: str, day: str, amount: str) -> DataFrame:
    """``entity, day, total, n`` of the active days (partial aggregation: a hot entity moves as one row a day and task)."""
    rows = df.select(F.col(entity).alias("entity"), F.col(day).cast("date").alias("day"), F.col(amount).cast("decimal(18,2)").alias("amount"))
    return rows.where("entity is not null and day is not null and amount is not null").groupBy("entity", "day").agg(F.sum("amount").alias("total"), F.count(F.lit(1)).alias("n"))


def _block(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BLOCK_DAYS).cast("int")


def calendar(like: DataFrame, first: str, last: str) -> DataFrame:
    """``block, on_day`` for every day from ``first`` to ``last`` (at most 3.7 million, the days of the years 1 to 9999)."""
    days = like.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("on_day"))
    return days.select(_block(F.col("on_day")).alias("block"), "on_day")


@dataclass(frozen=True)
class _Form:
    """How a day's total and number of rows are held while they are summed, as one long or as three.

    One long holds both where the largest day, times the longest period, leaves room: cents above, rows in the low ``bits``.
    Otherwise it is ``units`` of ``_UNIT`` cents, ``cents``, and ``n``. The results are the same.
    """

    bits: int | None

    @classmethod
    def of(cls, most_cents: int, most_rows: int, days: int) -> _Form:
        bits = (most_rows * days).bit_length()
        return cls(bits if (most_cents * days + 1) << bits < 1 << 62 else None)

    @property
    def columns(self) -> tuple[str, ...]:
        return ("packed",) if self.bits else ("units", "cents", "n")

    def held(self, cents: Column, n: Column) -> list[Column]:
        """The columns of a day, of its cents (decimal) and rows."""
        if self.bits:
            return [(F.shiftleft(cents.cast("long"), self.bits) + n).alias("packed")]
        c = cents.cast("decimal(38,0)")
        unit = F.lit(_UNIT).cast("decimal(13,0)")
        rest = (c % unit).cast("long")
        return [((c - rest) / unit).cast("long").alias("units"), rest.alias("cents"), n.cast("long").alias("n")]

    def total(self, period: int) -> tuple[Column, Column, Column]:
        """Total (decimal), cents (double) and rows of a summed period."""
        column = lambda c: F.col(f"_{c}_{period}")
        hundredth = F.lit("0.01").cast("decimal(3,2)")
        if self.bits:
            cents = F.shiftright(column("packed"), self.bits)
            return (cents.cast("decimal(20,0)") * hundredth).cast("decimal(38,2)"), cents.cast("double"), column("packed").bitwiseAND(F.lit((1 << self.bits) - 1).cast("long"))
        whole = column("units").cast("decimal(24,0)") * F.lit(_UNIT).cast("decimal(13,0)") + column("cents").cast("decimal(20,0)")
        return (whole.cast("decimal(38,0)") * hundredth).cast("decimal(38,2)"), column("units") * F.lit(float(_UNIT)) + column("cents"), column("n")


def dense_days(daily: DataFrame, longest: int) -> tuple[DataFrame, _Form]:
    """``entity, first_day, day`` and what is held of each day of each entity's calendar, partitioned by entity."""
    daily = scratch.materialise(daily, "daily")
    spans = daily.groupBy("entity").agg(F.min("day").alias("a"), F.max("day").alias("b"), F.max(F.abs("total")).alias("t"), F.max("n").alias("n"))
    known = spans.agg(F.min("a").cast("string").alias("first"), F.max("b").cast("string").alias("last"), F.coalesce(F.sum(F.datediff("b", "a") + 1), F.lit(0)).alias("rows"), F.coalesce(F.max("t"), F.lit(0)).alias("t"), F.coalesce(F.max("n"), F.lit(0)).alias("n")).first()
    form = _Form.of(int(known["t"] * 100), known["n"], longest)
    session = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(session, -(-known["rows"] // TASK_ROWS))
    split = daily.repartition(tasks, "entity").select("entity", "day", *form.held(F.col("total") * 100, F.col("n")))
    # an entity's active days are at most as many as the days of the calendar
    held = split.groupBy("entity").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.collect_list(F.struct(_block(F.col("day")).alias("block"), "day", *form.columns)).alias("days"))
    in_blocks = held.withColumn("block", F.explode(F.sequence(_block(F.col("first_day")), _block(F.col("last_day")))))
    own = F.filter("days", lambda d: d["block"] == F.col("block"))
    value = (lambda d: d["packed"]) if form.bits else (lambda d: F.struct(*(d[c].alias(c) for c in form.columns)))
    in_blocks = in_blocks.select("entity", "first_day", "last_day", "block", F.map_from_entries(F.transform(own, lambda d: F.struct(d["day"], value(d)))).alias("of_day"))
    days = broadcast_if_small(calendar(daily, known["first"], known["last"]))
    dense = in_blocks.join(days, "block").where(F.col("on_day").between(F.col("first_day"), F.col("last_day")))
    dense = dense.select("entity", "first_day", F.col("on_day").alias("day"), F.try_element_at("of_day", F.col("on_day")).alias("v"))
    zero = F.lit(0).cast("long")
    each = [F.coalesce("v", zero).alias("packed")] if form.bits else [F.coalesce(F.col(f"v.{c}"), zero).alias(c) for c in form.columns]
    return dense.select("entity", "first_day", "day", *each), form


def trailing_totals(daily: DataFrame, periods: tuple[int, ...] = (7, 30)) -> DataFrame:
    """``entity, day`` and for each period n ``total_n, mean_n, active_n``, for each day of each entity's calendar.

    ``daily`` is the result of :func:`daily_totals`.
    """
    by_day = Window.partitionBy("entity").orderBy("day")
    dense, form = dense_days(daily, max(periods))
    summed = dense.withColumns({f"_{c}_{p}": F.sum(c).over(by_day.rowsBetween(1 - p, 0)) for p in periods for c in form.columns})
    columns = []
    for p in periods:
        total, cents, n = form.total(p)
        columns += [total.alias(f"total_{p}"), (cents / F.lit(100.0) / p).alias(f"mean_{p}"), n.alias(f"active_{p}")]
    return summed.select("entity", "day", "first_day", *columns)


def surges_and_lulls(trailing: DataFrame, floor: float = 25_000.0, share: float = 0.7) -> DataFrame:
    """``entity, day, pattern``: ``surge`` where T7 >= floor and T7 >= share of T30, ``lull`` where nothing happened for 7
    days and T30 >= floor; only days with a full period of 30 days."""
    t7, t30 = F.col("total_7"), F.col("total_30")
    share_dec = F.lit(str(share)).cast("decimal(5,4)")
    surge = (t7 >= F.lit(floor)) & (t7 >= t30 * share_dec)
    lull = (F.col("active_7") == 0) & (t30 >= F.lit(floor))
    full = trailing.where(F.col("day") >= F.date_add("first_day", 29))
    # the averages are doubles, cheap to compute: with a margin for rounding they spare most days the exact totals
    near = F.lit(floor - abs(floor) * 1e-9)
    full = full.where((F.col("mean_7") * 7 >= near) | (F.col("mean_30") * 30 >= near))
    # an idle week has T7 = 0, so the two patterns exclude each other for a positive floor
    return full.select("entity", "day", F.when(surge, "surge").when(lull, "lull").alias("pattern")).where("pattern is not null")
