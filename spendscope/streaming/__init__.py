"""Incremental, append-only cost history (Structured Streaming + batch)."""
