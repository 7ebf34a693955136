"""Keyed latest-row selection and snapshot-scoped replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from strata.functions.columns import ColumnLike, sort_keys

_RN = "__strata_rn"


def latest_by(df: DataFrame, keys: Sequence[str] | str, order: Sequence[ColumnLike] | ColumnLike,
              tiebreak: Sequence[ColumnLike] | ColumnLike | None = None, within: str | None = None) -> DataFrame:
    """One row per key: the first row under ``order`` then ``tiebreak``.

    ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order, tiebreak) = 1``.
    Catalyst turns this into a partial ``WindowGroupLimit`` before the shuffle
    and a final one after it, so a hot key ships at most one row per input
    partition instead of all of its rows. Without ``tiebreak`` ties fall to
    the smallest row over the other flat columns, so the survivor never
    depends on the order of arrival.

    ``within`` names a column that the keys determine. It changes no result: rows
    that a join has already partitioned by it are not shuffled again.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if tiebreak is None:
        tiebreak = [F.col(f"`{f.name}`").asc_nulls_first() for f in df.schema.fields
                    if f.name not in (*keys, within) and not isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    w = Window.partitionBy(*([within] if within else []), *keys).orderBy(*(sort_keys(order) + sort_keys(tiebreak)))
    return (df.withColumn(_RN, F.row_number().over(w))
              .filter(F.col(_RN) == 1)
              .drop(_RN))


def snapshot_replace(target: DataFrame, new: DataFrame, label_col: str, label: str) -> DataFrame:
    """All rows of ``target`` except those labelled ``label``, plus ``new``.

    The NULL-safe comparison keeps rows whose label is NULL. ``new`` gets the
    label stamped. Writing the result to a fresh version (or a dynamic
    partition overwrite on ``label_col``) makes the replacement atomic.
    """
    keep = target.filter(~F.col(label_col).eqNullSafe(F.lit(label)))
    stamped = new.withColumn(label_col, F.lit(label))
    return keep.unionByName(stamped.select(*target.columns))
