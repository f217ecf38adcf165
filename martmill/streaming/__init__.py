"""Incremental loads fed by a stream."""
