from __future__ import annotations

import gzip
import json

from orderflow.schemas import EVENT
from orderflow.session import scratch_path
from orderflow.sources import load_once, read_events, write_events


def test_read_gzip_json_lines(spark, tmp_path):
    p = tmp_path / "raw_events.json.gz"
    rec = {"event_id": "a", "event_type": "order_created", "ts": "2024-01-01 10:00:00.000000",
           "gk_id": "g", "location": "x", "order_id": "o1", "sequence": 0, "body": "{}"}
    with gzip.open(p, "wt") as f:
        f.write(json.dumps(rec) + "\n")
    df = read_events(spark, str(p))
    assert df.schema == EVENT and df.collect()[0].order_id == "o1"


def test_write_events_roundtrip(spark, events):
    ev = events([("order_created", "2024-01-01 10:00:00.000000", "o1", "x", '{"a":1}')])
    path = scratch_path(spark, "test-write")
    write_events(ev, path)
    back = read_events(spark, path).collect()[0]
    assert back.body == '{"a":1}' and back.ts == "2024-01-01 10:00:00.000000"


def test_load_once_guard(spark, events, tmp_path):
    ev = events([("order_created", "2024-01-01 10:00:00.000000", "o1", "x", "{}")])
    spark.sql("DROP TABLE IF EXISTS orderflow_test_all_events")
    assert load_once(spark, ev, "orderflow_test_all_events", str(tmp_path / "t")) is True
    assert load_once(spark, ev.union(ev), "orderflow_test_all_events") is False
    assert spark.table("orderflow_test_all_events").count() == 1


def test_cut_lineage_uses_shared_checkpoint_folder(spark):
    from orderflow.session import checkpoint_root, cut_lineage
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    cut = cut_lineage(df)
    assert cut.count() == 10
    assert "ExistingRDD" in cut._jdf.queryExecution().executedPlan().toString()
    assert checkpoint_root(spark) == spark.sparkContext.getCheckpointDir().rstrip("/")


def test_checkpoint_root_requires_shared_folder_on_a_cluster():
    import pytest
    from orderflow.session import checkpoint_root

    class SC:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = SC()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
