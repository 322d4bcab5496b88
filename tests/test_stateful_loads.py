"""Collector with timers, a seeded state, numbering and change feed, over several runs."""

from __future__ import annotations

from datetime import timedelta

from orderflow.operators import quality
from orderflow.session import scratch_path
from orderflow.sources.events import read_events_stream, write_events
from orderflow.streaming import stateful
from orderflow.streaming.sinks import run_append


class Runs:
    """Land rows and run the same stream again and again."""

    def __init__(self, spark, events, stream):
        self.spark, self.events, self.stream = spark, events, stream
        self.root = scratch_path(spark, "test-loads")

    def land(self, rows):
        write_events(self.events([(et, f"2024-01-{ts}.000000" if ts else ts, oid, "x", "{}") for et, ts, oid in rows]),
                     f"{self.root}/landing")
        run_append(self.stream(read_events_stream(self.spark, f"{self.root}/landing")), f"{self.root}/out", self.checkpoint)
        return self.spark.read.parquet(f"{self.root}/out")

    @property
    def checkpoint(self):
        return f"{self.root}/ckpt"


def test_orders_and_flags_expire(spark, events):
    runs = Runs(spark, events, lambda s: stateful.expiring_orders(s, timedelta(hours=5), "1 hour"))

    def outcomes(df):
        return sorted((r.order_id, r.outcome, len(r.events)) for r in df.collect())

    first = outcomes(runs.land([("order_created", "01 10:00:00", "a"), ("order_created", "01 10:00:00", "b"),
                                ("delivered", "01 10:30:00", "b"), ("order_created", "01 10:00:00", "c")]))
    assert first == [("b", "delivered", 2)]
    # c moves its timer on; the watermark reaches 14:20, before a's timer at 15:00
    assert outcomes(runs.land([("driver_ping", "01 15:20:00", "c"), ("delivered", "01 15:10:00", "b")])) == first
    # the watermark passes 15:00 (a) and 15:30 (the flag of b, which the late event did not move), not 20:20 (c)
    second = outcomes(runs.land([("order_created", "01 17:00:00", "d")]))
    assert second == [("a", "expired", 1), ("b", "delivered", 2), ("b", "forgotten", 0)]
    assert sorted(r.order_id for r in stateful.orders_in_progress(spark, runs.checkpoint).collect()) == ["c", "d"]
    third = outcomes(runs.land([("order_created", "02 17:00:00", "e")]))
    assert third == sorted([*second, ("c", "expired", 2), ("d", "expired", 1)])


def test_seeded_state_equals_one_stream(spark, events):
    history = [("order_created", "01 10:00:00", "a"), ("order_created", "01 10:01:00", "b"), ("delivered", "01 10:30:00", "b"),
               ("order_created", None, "n")]
    later = [[("driver_ping", "01 11:00:00", "a"), ("driver_ping", "01 11:00:00", "b")],
             [("delivered", "01 12:00:00", "a"), ("delivered", "01 12:00:00", "c"), ("delivered", "01 12:00:00", "n")]]
    past = events([(et, f"2024-01-{ts}.000000" if ts else ts, oid, "x", "{}") for et, ts, oid in history])
    opened = stateful.open_orders_batch(past)
    seeded = Runs(spark, events, lambda s: stateful.completed_orders(s, opened=opened))
    whole = Runs(spark, events, stateful.completed_orders)
    whole.land(history)
    for rows in later:
        got, want = seeded.land(rows), whole.land(rows)
    got = got.unionByName(stateful.completed_orders_batch(past))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, stateful.orders_in_progress(spark, seeded.checkpoint).collect())) == sorted(
        map(str, stateful.orders_in_progress(spark, whole.checkpoint).collect()))


def test_numbers_go_on_across_runs(spark, events):
    loads = [[("order_created", "01 10:00:00", "a"), ("gk_started", "01 10:00:00", "a"), ("order_created", "01 09:00:00", None)],
             [("driver_ping", "01 11:00:00", "a"), ("order_created", "01 11:00:00", "b")],
             [("delivered", None, "a"), ("delivered", "01 12:00:00", "a"), ("delivered", "01 12:00:00", "b")]]
    runs = Runs(spark, events, stateful.numbered_events)
    for rows in loads:
        got = runs.land(rows)
    everything = spark.read.schema(got.schema).json(f"{runs.root}/landing").select(got.columns)
    want = quality.with_sequence(everything)
    key = ["event_type", "ts", "order_id", "sequence"]
    assert got.select(key).exceptAll(want.select(key)).count() == 0 and got.count() == want.count() == 8


def test_change_feed_and_snapshots(spark, events):
    runs = Runs(spark, events, stateful.completed_orders)
    runs.land([("order_created", "01 10:00:00", "a"), ("order_created", "01 10:00:00", "b"), ("delivered", "01 10:30:00", "c")])
    runs.land([("delivered", "01 11:00:00", "a"), ("driver_ping", "01 11:00:00", "b"), ("order_created", "01 11:00:00", "d")])
    runs.land([("driver_ping", "01 12:00:00", "a"), ("delivered", "01 12:00:00", "b"), ("delivered", "01 12:00:00", "b")])

    def changes(first=0):
        return sorted((r.batch_id, r.order_id, r.change)
                      for r in stateful.orders_opened_closed(spark, runs.checkpoint, first).collect())

    every = [(0, "a", "opened"), (0, "b", "opened"), (1, "a", "closed"), (1, "d", "opened"), (2, "a", "opened"),
             (2, "b", "closed")]
    assert changes() == every
    assert changes(2) == every[4:]
    held = [sorted(r.order_id for r in stateful.orders_in_progress(spark, runs.checkpoint, b).collect()) for b in range(3)]
    assert held == [["a", "b"], ["b", "d"], ["a", "d"]]


def test_a_call_handles_a_bucket_of_orders(spark, events, monkeypatch):
    """Many orders, few keys of the state store; rows as with a key per order."""
    monkeypatch.setattr(stateful, "BUCKETS", 2)
    names = [f"o{k:02d}" for k in range(60)]
    loads = [[("order_created", f"01 10:00:{k:02d}", o) for k, o in enumerate(names)],
             [("delivered", "01 11:00:00", o) for o in names[:40:2]] + [("driver_ping", "01 11:00:00", names[1])],
             [("driver_ping", "01 12:00:00", names[0]), ("delivered", "01 12:00:00", names[1])]]
    runs = Runs(spark, events, stateful.completed_orders)
    for rows in loads:
        done = runs.land(rows)
    state = spark.read.format("statestore").option("stateVarName", stateful.STATE_VAR).load(runs.checkpoint)
    assert 1 <= state.select("key").distinct().count() <= 2
    assert {r.order_id: [e.event_type for e in r.events] for r in done.collect()} == {
        **{o: ["order_created", "delivered"] for o in names[:40:2]}, names[1]: ["order_created", "driver_ping", "delivered"]}
    waiting = {r.order_id: len(r.events) for r in stateful.orders_in_progress(spark, runs.checkpoint).collect()}
    assert waiting == {names[0]: 1, **{o: 1 for o in names[3:40:2] + names[40:]}}
    changes = {b: sorted((r.order_id, r.change) for r in stateful.orders_opened_closed(spark, runs.checkpoint).collect()
                         if r.batch_id == b) for b in range(3)}
    assert changes == {0: [(o, "opened") for o in names], 1: [(o, "closed") for o in names[:40:2]],
                       2: [(names[0], "opened"), (names[1], "closed")]}
    numbered = Runs(spark, events, stateful.numbered_events)
    for rows in loads:
        got = numbered.land(rows)
    assert {(r.order_id, r.event_type): r.sequence for r in got.collect() if r.order_id in names[:2]} == {
        (names[0], "order_created"): 0, (names[0], "delivered"): 1, (names[0], "driver_ping"): 2,
        (names[1], "order_created"): 0, (names[1], "driver_ping"): 1, (names[1], "delivered"): 2}


def test_an_event_crosses_the_processor_as_one_line(spark, events):
    """A call gets one text per event, and one text per open cell is held;
    texts with breaks, quotes and nothing in them come back as they were."""
    bodies = ['two\nlines, "quoted" \\ [1,2]', "", None, "\u2028 \u00e9\u4e2d \t\r", '{"a": [null]}']
    runs = Runs(spark, events, stateful.completed_orders)
    rows = [("order_created", f"2024-01-01 10:00:0{k}.000000", oid, "x\ny", body)
            for oid in ("a\nb", "c") for k, body in enumerate(bodies)]
    write_events(events(rows + [("delivered", "2024-01-01 11:00:00.123456", "a\nb", "z", None)]), f"{runs.root}/landing")
    run_append(runs.stream(read_events_stream(spark, f"{runs.root}/landing")), f"{runs.root}/out", runs.checkpoint)
    (done,) = spark.read.parquet(f"{runs.root}/out").collect()
    assert (done.order_id, done.location) == ("a\nb", "x\ny")
    assert [e.body for e in done.events] == [*bodies, None] and done.events[-1].ts.microsecond == 123456
    (waiting,) = stateful.orders_in_progress(spark, runs.checkpoint).collect()
    assert waiting.order_id == "c" and [e.body for e in waiting.events] == bodies
    state = spark.read.format("statestore").option("stateVarName", stateful.STATE_VAR).load(runs.checkpoint)
    assert state.schema["user_map_value"].dataType["events"].dataType.simpleString() == "string"
