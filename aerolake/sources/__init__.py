"""Sources and sinks (SRC*, SNK*): table reads, fixture views, JSON Lines, streams."""

from aerolake.sources.tables import read_table, register_views, write_jsonl, read_jsonl
from aerolake.sources import fixtures

__all__ = ["read_table", "register_views", "write_jsonl", "read_jsonl", "fixtures"]
