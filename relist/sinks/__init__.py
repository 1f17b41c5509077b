"""Stored tables: append, upsert, publish, export."""
