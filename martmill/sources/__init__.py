"""Readers, writers, and the adapters that shape the given tables."""
