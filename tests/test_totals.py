"""Trailing totals of every account and day, against plain loops."""

from __future__ import annotations

from collections import defaultdict
from datetime import timedelta

import __spark_entry__ as entry
from lodestrom.queries import training
from tests.conftest import DATA


def test_totals_of_every_account_and_day(spark):
    daily = defaultdict(dict)
    for r in training.p2_amounts(spark, str(DATA)).collect():
        daily[r.entity][r.day] = r.total
    want = {}
    for account, days in daily.items():
        for k in range((max(days) - min(days)).days + 1):
            at = min(days) + timedelta(k)
            want[account, str(at)] = tuple(sum(days.get(at - timedelta(j), 0) for j in range(n)) for n in (7, 30))
    got = entry.queries()["p2_totals"](spark, str(DATA)).collect()
    assert len(got) == len(want) and {(r.account_id, r.on_day): (r.total_7, r.total_30) for r in got} == want
    assert all(abs(r.mean_7 * 7 - float(r.total_7)) < 1e-6 and abs(r.mean_30 * 30 - float(r.total_30)) < 1e-6 for r in got)
    # most accounts never reach the threshold of p2_found
    small = [a for a, days in daily.items() if sum(max(t, 0) for t in days.values()) < 25_000]
    assert small and set(small) <= {r.account_id for r in got}
