"""Expose DataFrames to SQL users as temporary views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """``createOrReplaceTempView`` for each table; ``"silver.orders"`` → ``silver_orders``.

    Views are names for plans, not copies: a SQL query over them is planned
    by Catalyst together with the DataFrame lineage behind each view.
    """
    names = []
    for name, df in tables.items():
        view = prefix + name.replace(".", "_")
        df.createOrReplaceTempView(view)
        names.append(view)
    return names
