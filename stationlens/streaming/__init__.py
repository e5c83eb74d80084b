"""Structured Streaming: incremental price-history refresh (snapshots)."""
