"""File-by-file ingest with Structured Streaming."""

from lakestrata.streaming.ingest import ingest_new_files

__all__ = ["ingest_new_files"]
