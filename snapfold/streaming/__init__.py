"""Structured Streaming entry points."""

from snapfold.streaming.ingest import stream_snapshots
from snapfold.streaming.latest import latest_state, upsert_latest, write_latest

__all__ = ["latest_state", "stream_snapshots", "upsert_latest", "write_latest"]
