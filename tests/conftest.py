"""One small session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lodestrom.session import build_session  # noqa: E402

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", cores=2, **{"spark.driver.memory": "3g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    """The small tables as pandas frames, for the brute-force versions."""
    import pandas as pd

    names = ("transactions", "accounts", "customers", "places", "raw_lines", "recent_transactions", "current_balances")
    return {n: pd.read_parquet(DATA / f"{n}.parquet") for n in names}
