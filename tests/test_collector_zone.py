"""The collector's times do not depend on the machine's time zone."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import textwrap

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import json, sys
    from orderflow.schemas import EVENT
    from orderflow.session import checkpoint_root, get_spark, scratch_path
    from orderflow.sources.events import read_events_stream, write_events
    from orderflow.streaming import stateful
    from orderflow.streaming.sinks import run_append

    spark = get_spark("local[2]", shuffle_partitions=2)
    checkpoint_root(spark)
    root = scratch_path(spark, "zone")

    def land(rows):
        full = [(f"e{i}", t, ts, loc, loc, oid, None, body) for i, (t, ts, oid, loc, body) in enumerate(rows)]
        write_events(spark.createDataFrame(full, EVENT), f"{root}/in")
        run_append(stateful.completed_orders(read_events_stream(spark, f"{root}/in"), strict=False,
                                             pandas=sys.argv[1] == "pandas"), f"{root}/out", f"{root}/ckpt")

    def rows(df):
        return [[r.order_id, r.location, [[e.event_type, e.t] for e in r.events]] for r in
                df.selectExpr("order_id", "location", "transform(events, e -> struct(e.event_type, "
                              "date_format(e.ts, 'HH:mm') AS t)) AS events").orderBy("order_id").collect()]

    land([("order_created", "2024-01-01 10:00:00.000000", "o1", "A", "b"),
          ("driver_ping", "bad", "o1", "B", "p"), ("driver_ping", "bad", None, "B", "p")])
    waiting = rows(stateful.orders_in_progress(spark, f"{root}/ckpt"))
    land([("delivered", "2024-01-01 10:30:00.000000", "o1", "A", "d")])
    done = rows(spark.read.parquet(f"{root}/out"))
    batch = rows(stateful.completed_orders_batch(spark.read.schema(EVENT).json(f"{root}/in"), strict=False))
    print("RESULT" + json.dumps([waiting, done, batch]))
""")


@pytest.mark.parametrize("form", ["row", "pandas"])
def test_times_survive_state_in_another_zone(form):
    env = os.environ | {"TZ": "America/Los_Angeles", "PYTHONPATH": ROOT}
    run = subprocess.run([sys.executable, "-c", SCRIPT, form], env=env, cwd=ROOT, capture_output=True,
                         text=True, timeout=300)
    line = [x for x in run.stdout.splitlines() if x.startswith("RESULT")]
    assert line, run.stderr[-2000:]
    waiting, done, batch = json.loads(line[0][6:])
    assert waiting == [["o1", "A", [["order_created", "10:00"], ["driver_ping", None]]]]
    assert done == [["o1", "A", [["order_created", "10:00"], ["delivered", "10:30"], ["driver_ping", None]]]]
    assert batch == done
