"""Marketplace and business-process analytics as Spark DataFrame jobs."""

from ledgerloom.session import build_session, configure, scratch_dir

__all__ = ["build_session", "configure", "scratch_dir"]
