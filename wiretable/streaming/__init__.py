"""Structured Streaming: incremental ingest of export files."""
