from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

@pytest.fixture(scope="session")
def spark():
    from orderflow.session import checkpoint_root, get_spark
    s = get_spark("local[4]", app="orderflow-tests", shuffle_partitions=4)
    checkpoint_root(s)  # sets a folder of our own only if the session has none
    yield s


@pytest.fixture()
def events(spark):
    """Build an envelope frame from (event_type, ts, order_id, location, body) tuples."""
    from orderflow.schemas import EVENT

    def make(rows):
        full = []
        for i, r in enumerate(rows):
            et, ts, oid, loc, body = r
            full.append((f"e{i:04d}", et, ts, loc, loc, oid, None, body))
        return spark.createDataFrame(full, EVENT)
    return make
