"""Wind and solar weather lakehouse on Spark: every transform is DataFrame -> DataFrame."""

from solvind.session import build_session, use_utc

__all__ = ["build_session", "use_utc"]
