"""Registered queries over the driver's tables, each next to the SQL that must give the same rows."""

from acceptance import gold, lake, reports, rows, streams  # noqa: F401  (registration)
from acceptance.base import CASES

__all__ = ["CASES"]
