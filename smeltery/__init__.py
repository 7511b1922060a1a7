"""Medallion-style batch analytics over nested, paginated JSON, written as Spark jobs."""

from smeltery.session import build_session, configure, scratch_path

__all__ = ["build_session", "configure", "scratch_path"]
