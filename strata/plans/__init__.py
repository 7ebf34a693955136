"""Compositions: the order medallion, its query catalogue and SQL oracle."""
