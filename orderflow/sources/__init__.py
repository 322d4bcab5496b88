"""Sources and sinks: event files, tables, fixtures from the driver's tables."""

from .events import read_events, read_events_stream, write_events
from .tables import load_once

__all__ = ["read_events", "read_events_stream", "write_events", "load_once"]
