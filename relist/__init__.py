"""Incremental listing ingestion expressed as Spark DataFrame operators."""

from relist.session import build_session, configure, shared_dir

__all__ = ["build_session", "configure", "shared_dir"]
