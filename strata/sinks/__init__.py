"""Sinks: versioned replace, append, day layout, lineage cuts."""

from strata.sinks.store import append, materialize, read_latest, with_day, write_version

__all__ = ["append", "materialize", "read_latest", "with_day", "write_version"]
