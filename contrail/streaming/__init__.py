"""Incremental form of the row-level cleaning stage (no new operators)."""

from contrail.streaming.ingest import clean_stream  # noqa: F401
