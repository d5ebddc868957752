"""Structured Streaming forms of the batch operators (EXT-16: current notional)."""

from ledgerlens.streaming.notional import EVENT_SCHEMA, current_notional, start_notional_stream

__all__ = ["EVENT_SCHEMA", "current_notional", "start_notional_stream"]
