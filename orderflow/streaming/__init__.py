"""Structured Streaming: stream tables, windowed append, stateful collector."""
