"""Streams written to tables."""

from terrace.streaming.append import BATCH, append_new

__all__ = ["BATCH", "append_new"]
