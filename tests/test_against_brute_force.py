"""The pN_found queries of problems 1, 2, 4, 5 and 7 against independent, plain versions on a whole small input."""

from __future__ import annotations

import pytest

from lodestrom.queries import training
from tests import brute
from tests.conftest import DATA

CASES = {
    "p1_found": lambda t: brute.p1(t["transactions"], t["places"]),
    "p2_found": lambda t: brute.p2(t["transactions"], t["accounts"]),
    "p4_found": lambda t: brute.p4(t["raw_lines"], t["transactions"], t["accounts"]),
    "p5_found": lambda t: {(i,) for i in brute.p5(t["transactions"])},
    "p7_found": lambda t: brute.p7(t["transactions"], t["accounts"]),
}


@pytest.mark.parametrize("name", CASES)
def test_same_rows(spark, tables, name):
    got = [tuple(r) for r in training.QUERIES[name](spark, str(DATA)).collect()]
    assert len(got) == len(set(got)), "rows are distinct"
    assert set(got) == CASES[name](tables)
