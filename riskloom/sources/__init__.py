"""Readers, writers and table adapters."""

from riskloom.sources.tables import read_table, write_table

__all__ = ["read_table", "write_table"]
