import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from rebuy.config import TX_SCHEMA  # noqa: E402
from rebuy.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", app="rebuy-tests", **{"spark.sql.shuffle.partitions": "8"})
    yield s
    from rebuy.sources.stage import drop_stage_tables

    drop_stage_tables(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


# Fixture 1 of FIXTURES.md: hand-worked transactions.
FIXTURE1 = [
    ("C1", "A", d("2024-01-01"), 2),
    ("C1", "B", d("2024-01-01"), 1),
    ("C1", "A", d("2024-01-05"), 1),
    ("C1", "A", d("2024-01-05"), 3),
    ("C1", "C", d("2024-01-10"), 1),
    ("C1", "A", d("2024-02-02"), 1),
    ("C1", "B", d("2024-02-02"), 1),
    ("C2", "A", d("2024-01-05"), 1),
    ("C2", "B", d("2024-02-05"), 4),
    ("C3", "C", d("2024-02-05"), 0),
]


@pytest.fixture(scope="session")
def fixture_tx(spark):
    return spark.createDataFrame(FIXTURE1, TX_SCHEMA)
