"""Readers. Batch readers return lazy frames with an explicit schema; nothing is inferred."""

from solvind.sources.documents import read_json_history, read_landing
from solvind.sources.tables import describe_table, read_gold_normalised, read_table
from solvind.sources.topics import message_source

__all__ = [
    "describe_table",
    "message_source",
    "read_gold_normalised",
    "read_json_history",
    "read_landing",
    "read_table",
]
