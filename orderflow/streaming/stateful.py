"""Orders held in streaming state until delivered.

Each order's events are kept in a map state.  When a
``delivered`` event arrives the order is released as one row with all
its events (by time, type and body) and its state is cleared.  Orders still in
state are the orders in progress; they are read back from the
checkpoint with the state data source.

The streams are keyed by a bucket of orders (a hash of order_id), not by the
order: a call of a Python processor, with its key, its clock and an Arrow
batch of results, costs some ten times what an order's few events do, so
a call handles all orders of a bucket.  A state call costs as much as well,
so a bucket's state has one map entry per cell, a share of its orders.
What a processor takes, holds and hands out costs by the field: an event is
one line (a JSON array of texts, which Spark writes and reads), a cell's events
are one text of lines, and so are those of an order that is handed out.

State is the events of open orders, so it grows with the number of
open orders, not with the log; a batch rewrites the cells it touches.  Known behaviour kept from the original:
an event arriving after ``delivered`` opens a new state that never
closes, and a second ``delivered`` releases a second row.
"""

from __future__ import annotations

import json
import sys
import zlib
from collections.abc import Iterable, Iterator
from datetime import timedelta
from operator import itemgetter

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.time import parse_ts
from ..schemas import EVENT, NUMBERED, STATE_EVENT

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_VAR = "events"
CLOSED_VAR = "closed"
DEADLINE_VAR = "deadline"
NEXT_VAR = "next"
CELL_KEY = "cell int"
#: Texts of an event's line.
LINE = ["order_id", "event_type", "ts", "body", "location"]
HELD_EVENTS = "events string"
#: Buckets of orders, the keys of the streams, and cells of a bucket (both are
#: part of a checkpoint's format).
BUCKETS = 4096
CELLS = 4
#: Up to so many cells of a bucket are read one by one.
FEW_CELLS = 3
RELEASED = Row("order_id", "lines")
RELEASED_STATE = "order_id string, lines string"
EXPIRED = Row("order_id", "location", "lines", "outcome")
EXPIRED_STATE = "order_id string, location string, lines string, outcome string"
NUMBERED_LINE = Row("line", "sequence")
NUMBERED_STATE = "line string, sequence bigint"
EVENT_IN_ORDER = "struct<no_time:boolean,ts:bigint,event_type:string,body:string,location:string>"
STATE_COLUMNS = STATE_EVENT.names
EVENT_COLUMNS = EVENT.names

# The processors run in Python workers.  Pickle this module's classes and
# helpers by value, so executors need no copy of the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _text(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _cell(order_id: str) -> int:
    """As ``_cell_column``."""
    return zlib.crc32(order_id.encode()) % CELLS


def _event_order(line: str) -> tuple:
    """Time (none last), then event type, body and location (none first)."""
    _, event_type, ts, body, location = json.loads(line)
    return (ts is None, int(ts or 0), *((x is not None, x or "") for x in (event_type, body, location)))


def _location(lines: list[str]) -> str | None:
    """The location of an order's first event."""
    return json.loads(min(lines, key=_event_order))[4]


def _by_order(lines: str) -> dict[str, list[str]]:
    """A cell's lines per order."""
    found: dict[str, list[str]] = {}
    for line in lines.split("\n"):
        found.setdefault(json.loads(line)[0], []).append(line)
    return found


def _joined(by_order: dict[str, list[str]]) -> str:
    return "\n".join([line for lines in by_order.values() for line in lines])


class Arrived:
    """New events of an order: their lines, whether one is ``delivered``, and
    the latest time."""

    __slots__ = ("lines", "delivered", "last")

    def __init__(self):
        self.lines: list[str] = []
        self.delivered, self.last = False, None


def _by_cell(lines: Iterable[str]) -> dict[int, dict[str, Arrived]]:
    """A bucket's new events per cell and order."""
    orders: dict[str, Arrived] = {}
    for line in lines:
        order_id, event_type, ts, _, _ = json.loads(line)
        new = orders.get(order_id)
        if new is None:
            new = orders[order_id] = Arrived()
        new.lines.append(line)
        if event_type == "delivered":
            new.delivered = True
        if ts is not None:
            new.last = int(ts) if new.last is None else max(new.last, int(ts))
    found: dict[int, dict[str, Arrived]] = {}
    for order_id, new in orders.items():
        found.setdefault(_cell(order_id), {})[order_id] = new
    return found


def _lines(rows: Iterable[Row]) -> Iterator[str]:
    """The lines of a call's rows (a Row's fields are slow to get at by name)."""
    at = None
    for row in rows:
        if at is None:
            at = row.__fields__.index("line")
        yield tuple(row)[at]


def _read(state, cells) -> dict[int, tuple]:
    """What a map state holds for ``cells`` of the bucket."""
    if len(cells) > FEW_CELLS:  # the bucket as a whole, in a few calls
        return {k[0]: tuple(value) for k, value in state.iterator() if k[0] in cells}
    found = ((c, state.getValue((c,))) for c in cells)
    return {c: tuple(value) for c, value in found if value is not None}


def _write(state, cell: int, value: tuple, was: bool) -> None:
    """New value of a cell; a cell without orders (empty first text) has no entry."""
    if value[0]:
        state.updateValue((cell,), value)
    elif was:
        state.removeKey((cell,))


class OrderEventCollector(StatefulProcessor):
    """Collector on Rows, one call per bucket of orders; emits an order when
    it is delivered.

    A map state holds the events of the open orders of each cell.  State
    never holds a delivered event (the order's events go on release), so an
    order whose new rows bring no ``delivered`` keeps its events and the
    new ones; otherwise the order is released and leaves its cell.

    ``remember_delivered=True`` keeps the id of each released order, and
    later events of that order are dropped instead of opening
    state that never closes.  The ids have no expiry: a TTL needs
    processing-time mode, whose pending expiries keep a one-shot
    (availableNow) run from finishing.
    """

    def __init__(self, remember_delivered: bool = False):
        self.remember = remember_delivered

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.events = handle.getMapState(STATE_VAR, CELL_KEY, HELD_EVENTS)
        if self.remember:
            self.closed = handle.getMapState(CLOSED_VAR, CELL_KEY, "orders string")

    def _released(self, by_cell: dict[int, dict[str, Arrived]]) -> Iterator[tuple[str, str]]:
        """(order_id, lines) of the orders that are delivered."""
        gone = _read(self.closed, by_cell) if self.remember else {}
        held = _read(self.events, by_cell)
        for cell, by_order in by_cell.items():
            flags = json.loads(gone[cell][0]) if cell in gone else []
            for order_id in flags:  # orders already released: drop late events
                by_order.pop(order_id, None)
            if not by_order:
                continue
            still = _by_order(held[cell][0]) if cell in held else {}
            done = []
            for order_id, new in by_order.items():
                lines = still.pop(order_id, []) + new.lines
                if new.delivered:
                    done.append(order_id)
                    yield order_id, "\n".join(lines)
                else:
                    still[order_id] = lines
            _write(self.events, cell, (_joined(still),), cell in held)
            if self.remember and done:
                self.closed.updateValue((cell,), (_text(flags + done),))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for released in self._released(_by_cell(_lines(rows))):
            yield RELEASED(*released)

    def close(self) -> None:
        pass


class SeededOrderEventCollector(OrderEventCollector):
    """The collector, started from orders that were open before the stream:
    one initial row per cell, with the lines of its orders' events."""

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        _write(self.events, initialState.cell, (initialState.lines,), False)


class ExpiringOrderEventCollector(StatefulProcessor):
    """The collector with a deadline per order, and an event-time timer per
    bucket at the earliest of them.

    The deadline is ``delay_ms`` after the latest event of the order.  If
    the watermark passes it before the order is delivered, the order is
    handed out as ``expired`` with the events it has; after delivery it
    removes the flag that keeps later events out and hands out
    ``forgotten``.  So no state outlives the watermark by more than the
    delay.  Orders whose events carry no time count from the watermark of
    the batch that brings them.

    A timer that fires reads its bucket and sets the next one; it may find
    nothing due, if the earliest deadline has moved on.
    """

    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Texts of JSON: due is {order_id: ms}, orders is [[order_id, location, ms], ...].
        self.events = handle.getMapState(STATE_VAR, CELL_KEY, f"{HELD_EVENTS}, due string")
        self.closed = handle.getMapState(CLOSED_VAR, CELL_KEY, "orders string")
        self.deadline = handle.getValueState(DEADLINE_VAR, "ms bigint")

    def _set_timer(self, due: int) -> None:
        old = self.deadline.get()
        if old is not None and old[0] <= due:
            return
        if old is not None:
            self.handle.deleteTimer(old[0])
        self.handle.registerTimer(due)
        self.deadline.update((due,))

    def _keep(self, cell: int, still: dict[str, list[str]], due: dict[str, int], was: bool) -> None:
        _write(self.events, cell, (_joined(still), _text({order_id: due[order_id] for order_id in still})), was)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        by_cell = _by_cell(_lines(rows))
        gone, held = _read(self.closed, by_cell), _read(self.events, by_cell)
        earliest = []
        for cell, by_order in by_cell.items():
            flags = json.loads(gone[cell][0]) if cell in gone else []
            for order_id, _, _ in flags:
                # released before: late events stay out, and the flag waits no longer for them
                by_order.pop(order_id, None)
            if not by_order:
                continue
            still = _by_order(held[cell][0]) if cell in held else {}
            due = json.loads(held[cell][1]) if cell in held else {}
            done = []
            for order_id, new in by_order.items():
                lines = still.pop(order_id, []) + new.lines
                ms = (timerValues.getCurrentWatermarkInMs() if new.last is None else new.last // 1000) + self.delay_ms
                ms = due[order_id] = max(ms, due.get(order_id, ms))
                earliest.append(ms)
                if new.delivered:
                    done.append((order_id, _location(lines), ms))
                    yield EXPIRED(order_id, None, "\n".join(lines), "delivered")
                else:
                    still[order_id] = lines
            self._keep(cell, still, due, cell in held)
            if done:
                self.closed.updateValue((cell,), (_text(flags + done),))
        if earliest:
            self._set_timer(min(earliest))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.deadline.clear()
        fired, watermark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        left = []

        def over(ms: int) -> bool:
            if ms <= fired or ms < watermark:
                return True
            left.append(ms)
            return False

        for (cell,), (text,) in list(self.closed.iterator()):
            flags = json.loads(text)
            past = [over(f[2]) for f in flags]
            if any(past):
                waiting = [f for f, p in zip(flags, past) if not p]
                _write(self.closed, cell, (_text(waiting) if waiting else "",), True)
            for f, p in zip(flags, past):
                if p:
                    yield EXPIRED(f[0], f[1], None, "forgotten")
        for (cell,), (events, deadlines) in list(self.events.iterator()):
            due = json.loads(deadlines)
            past = [order_id for order_id, ms in due.items() if over(ms)]
            if not past:
                continue
            still = _by_order(events)
            for order_id in past:
                yield EXPIRED(order_id, None, "\n".join(still.pop(order_id)), "expired")
            self._keep(cell, still, due, True)
        if left:
            self._set_timer(min(left))

    def close(self) -> None:
        pass


class SequenceNumberer(StatefulProcessor):
    """Numbers an order's events 0, 1, 2, ... across micro-batches, one call
    per bucket of orders.

    A micro-batch is numbered by time, then event id (none last), as
    ``quality.with_sequence`` does; numbers go on where the last batch of
    the order ended.  State is one counter per order.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Text of JSON: {order_id: n}.
        self.next = handle.getMapState(NEXT_VAR, CELL_KEY, "orders string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        by_cell: dict[int, dict[str, list]] = {}
        for line in _lines(rows):
            order_id, at, event_id, *_ = json.loads(line)
            place = (at is None, int(at or 0), event_id is None, event_id or "")
            by_cell.setdefault(_cell(order_id), {}).setdefault(order_id, []).append((place, line))
        held = _read(self.next, by_cell)
        for cell, by_order in by_cell.items():
            counts = json.loads(held[cell][0]) if cell in held else {}
            for order_id, batch in by_order.items():
                n = counts.get(order_id, 0)
                batch.sort(key=itemgetter(0))
                for k, (_, line) in enumerate(batch, n):
                    yield NUMBERED_LINE(line, k)
                counts[order_id] = n + len(batch)
            self.next.updateValue((cell,), (_text(counts),))

    def close(self) -> None:
        pass


class PandasOrderEventCollector(OrderEventCollector):
    """The same collector on pandas frames (``transformWithStateInPandas``),
    kept for pandas-based callers."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done = list(self._released(_by_cell(line for pdf in rows for line in pdf["line"])))
        if done:
            yield pd.DataFrame(done, columns=list(RELEASED))


def use_rocksdb(spark: SparkSession) -> None:
    """transformWithState needs the RocksDB state store provider; with
    changelog checkpoints a batch uploads its changes only, and they can be
    read back (``orders_opened_closed``)."""
    for key, value in (("spark.sql.streaming.stateStore.providerClass", ROCKSDB),
                       ("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")):
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def _bucket() -> Column:
    """The bucket of an order."""
    return F.pmod(F.xxhash64("order_id"), F.lit(BUCKETS)).cast("int").alias("bucket")


def _cell_column() -> Column:
    """The cell of an order in its bucket."""
    return (F.crc32(F.encode("order_id", "UTF-8")) % CELLS).cast("int").alias("cell")


def _line(columns: list[Column]) -> Column:
    """One line for a processor: a JSON array of texts, which has no line breaks."""
    return F.to_json(F.array(*[c.cast("string") for c in columns]))


def _texts(line: Column, kind: str = "array<string>") -> Column:
    return F.from_json(line, kind, {"mode": "FAILFAST"})


def _keyed(rows: DataFrame, *more: str) -> DataFrame:
    """(bucket, line) of state rows."""
    return rows.select(_bucket(), _line([F.col(c) for c in LINE]).alias("line"), *more)


def _all_texts(lines: Column) -> Column:
    """The events of some lines, each as an array of texts."""
    whole = F.concat(F.lit("["), F.replace(lines, F.lit("\n"), F.lit(",")), F.lit("]"))
    return _texts(whole, "array<array<string>>")


def _cells_of(opened: DataFrame) -> DataFrame:
    """(bucket, cell, lines) of open orders (order_id, events)."""
    events = opened.select(F.explode("events").alias("e"))
    lines = events.select(F.col("e.order_id").alias("order_id"), _line([F.col(f"e.{c}") for c in LINE]).alias("line"))
    return lines.groupBy(_bucket(), _cell_column()).agg(F.array_join(F.collect_list("line"), "\n").alias("lines"))


def state_input(events: DataFrame, strict: bool = True) -> DataFrame:
    """Project the envelope to the state row; ts cast strictly by default.

    State and the processors hold time as epoch microseconds, which no
    time zone of a worker or a session can shift.  Events without an
    order id belong to no order and stay out (``quality.time_audit``
    counts them).
    """
    ts = F.col("ts").cast("timestamp") if strict else parse_ts("ts")
    return events.filter(F.col("order_id").isNotNull()).select(
        "event_type", F.unix_micros(ts).alias("ts"), "body", "order_id", "location")


def _with_times(df: DataFrame) -> DataFrame:
    """Event times from epoch microseconds to TIMESTAMP."""
    return df.withColumn("events", F.transform("events", lambda e: F.struct(
        e["event_type"].alias("event_type"), F.timestamp_micros(e["ts"]).alias("ts"),
        e["body"].alias("body"))))


def _event(event_type: Column, ts: Column, body: Column, location: Column) -> Column:
    """Sorts by time (none last), then event type, body and location (none first)."""
    return F.struct(ts.isNull().alias("no_time"), ts.alias("ts"), event_type.alias("event_type"),
                    body.alias("body"), location.alias("location"))


def _events_of(lines: Column) -> Column:
    """The events of some lines in event order; none for NULL."""
    events = F.transform(_all_texts(lines), lambda e: _event(
        e[LINE.index("event_type")], e[LINE.index("ts")].cast("bigint"), e[LINE.index("body")],
        e[LINE.index("location")]))
    return F.sort_array(F.when(lines.isNull(), F.array().cast("array<" + EVENT_IN_ORDER + ">")).otherwise(events))


def _released_rows(df: DataFrame) -> DataFrame:
    """Rows of the collector with their events; the location is that of the
    first one."""
    rows = df.withColumn("events", _events_of(F.col("lines")))
    first = F.get("events", F.lit(0))["location"]
    location = F.coalesce(F.col("location"), first) if "location" in df.columns else first
    return _with_times(rows.select("order_id", location.alias("location"), "events",
                                   *[c for c in df.columns if c == "outcome"]))


def completed_orders(events_stream: DataFrame, strict: bool = True, pandas: bool = False,
                     remember_delivered: bool = False, opened: DataFrame | None = None) -> DataFrame:
    """Stream of delivered orders with all their events (append).

    Keyed by buckets of orders (one shuffle to the state partitions), no timers.
    ``pandas=True`` runs the pandas form of the processor;
    ``remember_delivered=True`` drops events that arrive after an order
    was released (see ``OrderEventCollector``).  ``opened`` (see
    ``open_orders_batch``) fills the state of a new stream with orders that
    were open before it; a restart from the checkpoint does not read it.
    """
    use_rocksdb(events_stream.sparkSession)
    grouped = _keyed(state_input(events_stream, strict)).groupBy("bucket")
    if pandas:
        return _released_rows(grouped.transformWithStateInPandas(
            statefulProcessor=PandasOrderEventCollector(), outputStructType=RELEASED_STATE,
            outputMode="Append", timeMode="None"))
    if opened is not None:
        return _released_rows(grouped.transformWithState(
            statefulProcessor=SeededOrderEventCollector(remember_delivered), outputStructType=RELEASED_STATE,
            outputMode="Append", timeMode="None", initialState=_cells_of(opened).groupBy("bucket")))
    return _released_rows(grouped.transformWithState(
        statefulProcessor=OrderEventCollector(remember_delivered),
        outputStructType=RELEASED_STATE, outputMode="Append", timeMode="None"))


def expiring_orders(events_stream: DataFrame, delay: timedelta = timedelta(days=2), lateness: str = "3 hours",
                    strict: bool = True) -> DataFrame:
    """Stream of orders with their ``outcome``: delivered, expired (not
    delivered within ``delay`` of their latest event) and forgotten (the
    flag of a delivered order is dropped after the same delay).

    ``lateness`` is the watermark; timers fire once it has passed them.
    """
    use_rocksdb(events_stream.sparkSession)
    rows = state_input(events_stream, strict).withColumn("at", F.timestamp_micros("ts")).withWatermark("at", lateness)
    # The time stays a column: rows older than the watermark are dropped by it.
    return _released_rows(_keyed(rows, "at").groupBy("bucket").transformWithState(
        statefulProcessor=ExpiringOrderEventCollector(int(delay.total_seconds() * 1000)),
        outputStructType=EXPIRED_STATE, outputMode="Append", timeMode="EventTime"))


def numbered_events(events_stream: DataFrame) -> DataFrame:
    """Stream of events with their 0-based position in the order (see
    ``SequenceNumberer``).  Events without an order id have no number."""
    use_rocksdb(events_stream.sparkSession)
    own = events_stream.filter(F.col("order_id").isNotNull()).withColumn("at", F.unix_micros(parse_ts("ts")))
    columns = ["order_id", "at", "event_id", *[c for c in NUMBERED.names[:-1] if c not in ("order_id", "event_id")]]
    lines = own.select(_bucket(), _line([F.col(c) for c in columns]).alias("line"))
    numbered = lines.groupBy("bucket").transformWithState(
        statefulProcessor=SequenceNumberer(), outputStructType=NUMBERED_STATE, outputMode="Append", timeMode="None")
    numbered = numbered.select(_texts(F.col("line")).alias("texts"), "sequence").select(
        *[F.col("texts")[k].cast(NUMBERED[c].dataType).alias(c) for k, c in enumerate(columns) if c != "at"], "sequence")
    rest = events_stream.filter(F.col("order_id").isNull()).withColumn("sequence", F.lit(None).cast("bigint"))
    return numbered.select(*EVENT_COLUMNS).unionByName(rest.select(*EVENT_COLUMNS))


def open_orders_batch(events: DataFrame, strict: bool = True) -> DataFrame:
    """(order_id, events): orders without a delivered event, as state rows
    for ``completed_orders(opened=...)``."""
    s = state_input(events, strict)
    delivered = s.filter(F.col("event_type") == "delivered").select("order_id").distinct()
    return s.join(delivered, "order_id", "left_anti").groupBy("order_id").agg(
        F.collect_list(F.struct(*STATE_COLUMNS)).alias("events"))


def _ordered(event_type, ts, body, location):
    """An order's events as one array in the collector's event order."""
    return F.sort_array(F.collect_list(_event(event_type, ts, body, location)))


def completed_orders_batch(events: DataFrame, strict: bool = True) -> DataFrame:
    """Batch equal of ``completed_orders`` when all input is one batch:
    orders with a delivered event, with their events in event order.
    Only events of delivered orders are gathered."""
    s = state_input(events, strict)
    delivered = s.filter(F.col("event_type") == "delivered").select("order_id").distinct()
    g = s.join(delivered, "order_id", "left_semi").groupBy("order_id").agg(
        _ordered(F.col("event_type"), F.col("ts"), F.col("body"), F.col("location")).alias("events"))
    return _with_times(g.select("order_id", F.col("events")[0]["location"].alias("location"), "events"))


def orders_in_progress(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Orders still held in the collector's state, with their events.

    Reads the map state from the checkpoint (state data source, one row
    per cell) and regroups it per order; ``batch_id`` reads the state as
    it was after that batch instead of the newest.
    """
    reader = spark.read.format("statestore").option("stateVarName", STATE_VAR)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    held = reader.load(checkpoint).select(F.explode(_all_texts(F.col("user_map_value.events"))).alias("e"))
    e = {c: F.col("e")[k] for k, c in enumerate(LINE)}
    g = held.groupBy(e["order_id"].alias("order_id")).agg(
        _ordered(e["event_type"], e["ts"].cast("bigint"), e["body"], e["location"]).alias("events"))
    return _with_times(g.select("order_id", F.col("events")[0]["location"].alias("location"), "events"))


def orders_opened_closed(spark: SparkSession, checkpoint: str, first_batch: int = 0) -> DataFrame:
    """(batch_id, order_id, change): what each batch did to the collector's
    state: ``opened`` (events held where none were) or ``closed``.

    Read from the change feed of the state store, whose size is that of the
    cells that the batches touched, not of the state.  An order was opened
    where the cell holds it and did not before, and closed the other way
    round.  From a later ``first_batch`` on, the state before that batch
    tells what a cell held.
    """
    def cells(df: DataFrame, batch: Column, orders: Column) -> DataFrame:
        return df.select(F.col("key.bucket").alias("bucket"), F.col("user_map_key.cell").alias("cell"),
                         batch.cast("bigint").alias("batch_id"), orders.alias("orders"))

    reader = spark.read.format("statestore").option("stateVarName", STATE_VAR)
    feed = reader.option("readChangeFeed", True).option("changeStartBatchId", first_batch).load(checkpoint)
    events = _all_texts(F.col("user_map_value.events"))
    orders, none = F.array_distinct(F.transform(events, lambda e: e[0])), F.array().cast("array<string>")
    changes = cells(feed, F.col("batch_id"), F.when(F.col("change_type") == "delete", none).otherwise(orders))
    if first_batch:
        before = spark.read.format("statestore").option("stateVarName", STATE_VAR).option(
            "batchId", first_batch - 1).load(checkpoint)
        changes = changes.unionByName(cells(before, F.lit(first_batch - 1), orders))
    w = Window.partitionBy("bucket", "cell").orderBy("batch_id")
    turns = changes.withColumn("was", F.coalesce(F.lag("orders").over(w), none)).filter(F.col("batch_id") >= first_batch)
    return turns.select("batch_id", F.explode(F.array_except("orders", "was")).alias("order_id"), F.lit("opened").alias("change")).unionByName(
        turns.select("batch_id", F.explode(F.array_except("was", "orders")).alias("order_id"), F.lit("closed").alias("change")))
