"""Layer profile: row counts (and a preview) per table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def layer_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(layer, table_name, row_count)`` for ``{"layer.table": df}``, one union.

    Each count is a global aggregate with partial counts per task, so only
    one number per task crosses the shuffle.
    """
    parts = []
    for name, df in tables.items():
        layer, _, table = name.rpartition(".")
        parts.append(df.agg(F.count(F.lit(1)).cast("long").alias("row_count"))
                       .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows of a table, for eyeballing (a bounded limit)."""
    return df.limit(n)
