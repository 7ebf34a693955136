"""Checks counted by the job that writes a table, without a second scan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation


class Watch:
    """Named counts over the rows of one DataFrame, taken while it is written.

    It belongs right before the write, behind any shuffle: in the stage that
    writes, a partition counts once however often its task is tried, whereas a
    stage before a shuffle that a lost executor makes Spark run again would count
    twice. One row of numbers reaches the driver.
    """

    def __init__(self, counts: Mapping[str, Column]):
        self.counts = dict(counts)
        self._seen = Observation()

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *[c.cast("long").alias(n) for n, c in self.counts.items()]) if self.counts else df

    def get(self) -> dict[str, int]:
        """The counts, once the write has ended."""
        return dict(self._seen.get) if self.counts else {}
