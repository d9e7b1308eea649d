"""Structured Streaming ingest."""

from tidemark.streaming.ingest import run_ingest, start_ingest

__all__ = ["run_ingest", "start_ingest"]
