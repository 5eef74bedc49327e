"""Incremental forms of ingest and weekly bars (Structured Streaming)."""

from .bars import weekly_bars_stream
from .ingest import start_ingest

__all__ = ["start_ingest", "weekly_bars_stream"]
