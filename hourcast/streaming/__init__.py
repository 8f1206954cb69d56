"""Streaming entry points (an incremental trigger; the operators are batch)."""

from hourcast.streaming.incremental import stage3_stream

__all__ = ["stage3_stream"]
