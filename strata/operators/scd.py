"""Slowly changing dimensions: Type 1 upsert and Type 2 versioning.

A Type 2 dimension row is a version valid on ``[effective_from,
effective_to)``; ``effective_to`` NULL means open, ``is_current`` flags the
open version. One SCD2 run is one plan, closed ∪ untouched ∪ opened, computed
from the same inputs; only the change set, read twice, is worth pinning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import any_of, differs, null_key_salt, typed_null
from strata.operators.keys import assign_surrogate_keys, max_key
from strata.operators.merge import Matched, merge, merge_upsert
from strata.sinks.store import empty_table


def scd1(dim: DataFrame, source: DataFrame, key: str, sk: str | None = None) -> DataFrame:
    """Type 1: overwrite attributes in place, insert new keys, never delete.

    With ``sk`` the surrogate key is the business key (``sk = key``).
    """
    src = source.withColumn(sk, F.col(key)) if sk else source
    return merge_upsert(dim, src.select(*dim.columns), key)


def scd2_changes(dim: DataFrame, source: DataFrame, key: str, tracked: Sequence[str],
                 current_flag: str = "is_current", null_safe: bool = False) -> DataFrame:
    """Source rows that are new or differ from the current version.

    ``<>`` is NULL-unsafe by default (a NULL → value change is not a
    change); ``null_safe=True`` uses ``IS DISTINCT FROM``. Untracked columns
    never cause a version.
    """
    cur = (dim.filter(F.col(current_flag))
              .select(F.col(key).alias("__d_key"), *[F.col(c).alias("__d_" + c) for c in tracked]))
    cur = cur.withColumn("__d_salt", null_key_salt(["__d_key"], ["__d_key"]))
    # NULL source keys cannot match; the salt spreads them over the join
    src = source.withColumn("__s_salt", null_key_salt([key], source.columns))
    j = src.join(cur, (src[key] == cur["__d_key"]) & (src["__s_salt"] == cur["__d_salt"]), "left")
    changed = F.col("__d_key").isNull() | F.coalesce(
        any_of(differs(F.col("__d_" + c), F.col(c), null_safe) for c in tracked), F.lit(False))
    return j.filter(changed).select(*source.columns)


def scd2_close(dim: DataFrame, changes: DataFrame, key: str, changed_at: str = "updated_at",
               current_flag: str = "is_current", valid_to: str = "effective_to") -> DataFrame:
    """Close the current version of every changed key.

    ``MERGE … ON d.key = s.key AND d.is_current WHEN MATCHED THEN UPDATE SET
    is_current = false, effective_to = s.changed_at``. Only current versions
    can match, so the closed history passes by without a shuffle.
    """
    is_current = F.coalesce(F.col(current_flag), F.lit(False))
    closed = merge(dim.filter(is_current), changes.select(key, changed_at), key,
                   [Matched(update={current_flag: F.lit(False), valid_to: (lambda t, s: s[changed_at])})])
    return dim.filter(~is_current).unionByName(closed)


def scd2_open(changes: DataFrame, dim: DataFrame, key: str, attrs: Sequence[str], sk: str,
              changed_at: str = "updated_at", valid_from: str = "effective_from",
              valid_to: str = "effective_to", current_flag: str = "is_current") -> DataFrame:
    """New open versions: ``sk = max(sk) + row_number() over (order by key)``."""
    keyed = assign_surrogate_keys(changes, key, out=sk, start=max_key(dim, sk))
    ts_type = dim.schema[valid_from].dataType
    return keyed.select(
        F.col(sk).cast(dim.schema[sk].dataType).alias(sk), key, *attrs,
        F.col(changed_at).cast(ts_type).alias(valid_from),
        typed_null(dim.schema[valid_to].dataType).alias(valid_to),
        F.lit(True).alias(current_flag)).select(*dim.columns)


def scd2_apply(dim: DataFrame, source: DataFrame, key: str, tracked: Sequence[str],
               attrs: Sequence[str], sk: str, changed_at: str = "updated_at",
               null_safe: bool = False, stage=None) -> DataFrame:
    """One SCD2 run: close changed current versions, open new ones.

    ``attrs`` are all carried attributes (tracked and untracked). A change
    with the same ``changed_at`` as the version it replaces yields a
    zero-length closed version ``[t, t)``, which covers no instant.

    The change set is read by both steps; ``stage`` (a DataFrame →
    DataFrame function such as a write to the shared folder) pins it once
    so the comparison join is not recomputed.
    """
    changes = scd2_changes(dim, source, key, tracked, null_safe=null_safe)
    if stage is not None:
        changes = stage(changes)
    closed = scd2_close(dim, changes, key, changed_at)
    opened = scd2_open(changes, dim, key, attrs, sk, changed_at)
    return closed.unionByName(opened)


def empty_dim(spark, schema) -> DataFrame:
    """A typed empty dimension (first run) the optimizer can fold away."""
    return empty_table(spark, schema)


__all__ = ["empty_dim", "scd1", "scd2_apply", "scd2_changes", "scd2_close", "scd2_open"]
