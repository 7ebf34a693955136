"""MERGE (upsert) semantics on plain DataFrames.

``merge(target, source, on, matched=[...], not_matched=[...])`` returns the
new target. It is one full outer join on the key: both sides are shuffled
once on the key (or AQE broadcasts a side whose runtime size is small), and
every output column is a ``CASE`` over the clauses. Rules, as in SQL MERGE:

* clauses are tried in order; a matched row whose conditions are all false
  or NULL keeps the target row (it never falls through to an insert);
* NULL keys never match, so a NULL-keyed source row can only be inserted;
* ``"*"`` assigns by column name; a target column missing from the source is
  an error;
* two source rows matching one target row is an error (raised inside the
  plan; the source-side count shares the join's shuffle);
* rows with a NULL key cannot match; a deterministic salt spreads them over
  the join's partitions, so many NULL keys do not funnel into one task;
* target rows without a source partner are kept (no NOT MATCHED BY SOURCE).

Without matched clauses it is target ∪ (source anti target) instead.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import all_of, not_null, null_key_salt

_T = "__t_"
_S = "__s_"
_TP = "__t_present"
_SP = "__s_present"
_SN = "__s_dups"


class Side:
    """Accessor handed to clause callbacks: ``t["col"]`` / ``s["col"]``."""

    def __init__(self, prefix: str, columns: Sequence[str]):
        self._prefix = prefix
        self._columns = set(columns)

    def __getitem__(self, name: str) -> Column:
        if name not in self._columns:
            raise KeyError(f"unknown column {name!r}")
        return F.col(self._prefix + name)

    __getattr__ = __getitem__


Cond = Callable[[Side, Side], Column] | None
Assign = str | Mapping[str, Callable[[Side, Side], Column] | Column]


@dataclass
class Matched:
    """WHEN MATCHED [AND cond] THEN UPDATE SET … | DELETE."""

    cond: Cond = None
    update: Assign = "*"
    delete: bool = False


@dataclass
class NotMatched:
    """WHEN NOT MATCHED [AND cond] THEN INSERT …"""

    cond: Cond = None
    insert: Assign = "*"


class MergeError(ValueError):
    pass


def _value(assign: Assign, name: str, t: Side, s: Side, source_cols: set[str]) -> Column | None:
    if assign == "*":
        if name not in source_cols:
            raise MergeError(f"source has no column {name!r} for '*'")
        return s[name]
    if name not in assign:
        return None
    v = assign[name]
    return v(t, s) if callable(v) else v


def merge(target: DataFrame, source: DataFrame, on: Sequence[str] | str,
          matched: Sequence[Matched] = (), not_matched: Sequence[NotMatched] = (),
          target_condition: Callable[[Side], Column] | None = None,
          check_unique_source: bool = True) -> DataFrame:
    """Apply MERGE clauses and return the new target (target column order).

    ``target_condition`` is an extra ON predicate on the target only (e.g.
    ``lambda t: t["is_current"]``): target rows failing it are never matched.
    """
    on = [on] if isinstance(on, str) else list(on)
    tcols, scols = list(target.columns), list(source.columns)
    for k in on:
        if k not in tcols or k not in scols:
            raise MergeError(f"merge key {k!r} missing on one side")
    t, s = Side(_T, tcols), Side(_S, scols)
    for m in matched:
        if not m.delete and m.update != "*":
            bad = set(m.update) - set(tcols)
            if bad:
                raise MergeError(f"update of unknown target columns {sorted(bad)}")

    if not matched and target_condition is None:
        return _insert_only(target, source, on, not_matched)

    tdf = target.select(*[F.col(c).alias(_T + c) for c in tcols], F.lit(True).alias(_TP))
    sdf = source.select(*[F.col(c).alias(_S + c) for c in scols], F.lit(True).alias(_SP))
    # A row with a NULL key can never match; a salt spreads such rows over
    # partitions instead of hashing them all to one (see null_key_salt).
    tdf = tdf.withColumn("__t_salt", null_key_salt([_T + k for k in on], [_T + c for c in tcols]))
    sdf = sdf.withColumn("__s_salt", null_key_salt([_S + k for k in on], [_S + c for c in scols]))
    if check_unique_source and matched:
        # Same hash partitioning as the join below, so no extra shuffle.
        sdf = sdf.withColumn(_SN, F.count(F.lit(1)).over(
            Window.partitionBy(*[_S + k for k in on], "__s_salt")))

    cond = all_of(F.col(_T + k) == F.col(_S + k) for k in on) & (F.col("__t_salt") == F.col("__s_salt"))
    if target_condition is not None:
        cond = cond & target_condition(t)
    # without an insert clause a source row that matches nothing is dropped: the target's side alone is kept,
    # and AQE can split a skewed target
    j = tdf.join(sdf, cond, "full_outer" if not_matched else "left")

    is_m = F.col(_TP).isNotNull() & F.col(_SP).isNotNull()
    is_new = F.col(_TP).isNull()
    scol_set = set(scols)

    def clause_cond(c: Cond) -> Column:
        if c is None:
            return F.lit(True)
        return F.coalesce(c(t, s), F.lit(False))

    # Index of the clause that fires for each row (NULL = none).
    m_idx = None
    for i in reversed(range(len(matched))):
        m_idx = F.when(is_m & clause_cond(matched[i].cond), F.lit(i)).otherwise(
            m_idx if m_idx is not None else F.lit(None).cast("int"))
    n_idx = None
    for i in reversed(range(len(not_matched))):
        n_idx = F.when(is_new & clause_cond(not_matched[i].cond), F.lit(i)).otherwise(
            n_idx if n_idx is not None else F.lit(None).cast("int"))
    m_idx = m_idx if m_idx is not None else F.lit(None).cast("int")
    n_idx = n_idx if n_idx is not None else F.lit(None).cast("int")
    j = j.withColumn("__m_idx", m_idx).withColumn("__n_idx", n_idx)

    keep = ~is_new | F.col("__n_idx").isNotNull()
    deletes = [i for i, m in enumerate(matched) if m.delete]
    if deletes:
        keep = keep & ~(F.coalesce(F.col("__m_idx").isin(deletes), F.lit(False)))
    if check_unique_source and matched:
        # in the row filter, so no column pruning downstream can drop the check
        keep = keep & F.when(is_m & (F.col(_SN) > 1),
                             F.raise_error(F.lit("MERGE: several source rows match one target row"))
                             ).otherwise(F.lit(True))
    j = j.filter(keep)

    out = []
    for name in tcols:
        expr = F.col(_T + name)
        for i in reversed(range(len(matched))):
            m = matched[i]
            if m.delete:
                continue
            v = _value(m.update, name, t, s, scol_set)
            if v is not None:
                expr = F.when(F.col("__m_idx") == i, v).otherwise(expr)
        ins = None
        for i in reversed(range(len(not_matched))):
            v = _value(not_matched[i].insert, name, t, s, scol_set)
            if v is None:
                v = F.lit(None)
            ins = F.when(F.col("__n_idx") == i, v).otherwise(ins if ins is not None else F.lit(None))
        if ins is not None:
            expr = F.when(is_new, ins).otherwise(expr)
        out.append(expr.cast(target.schema[name].dataType).alias(name))
    return j.select(*out)


def _insert_only(target: DataFrame, source: DataFrame, on: list[str], clauses: Sequence[NotMatched]) -> DataFrame:
    """Target ∪ inserted rows of (source anti target): the target meets the join with its keys only."""
    tcols, scols = list(target.columns), list(source.columns)
    t, s = Side(_T, tcols), Side(_S, scols)
    new = source.select(*[F.col(c).alias(_S + c) for c in scols])
    new = new.withColumn("__s_salt", null_key_salt([_S + k for k in on], [_S + c for c in scols]))
    tkeys = [_T + k for k in on]
    keys = target.select(*[F.col(k).alias(_T + k) for k in on]).filter(not_null(tkeys))
    keys = keys.withColumn("__t_salt", null_key_salt(tkeys, tkeys))
    new = new.join(keys, all_of(F.col(_T + k) == F.col(_S + k) for k in on) & (F.col("__t_salt") == F.col("__s_salt")), "left_anti")
    for c in tcols:  # the conditions of an insert clause see an absent target row
        new = new.withColumn(_T + c, F.lit(None).cast(target.schema[c].dataType))
    idx = F.lit(None).cast("int")
    for i in reversed(range(len(clauses))):
        fires = F.lit(True) if clauses[i].cond is None else F.coalesce(clauses[i].cond(t, s), F.lit(False))
        idx = F.when(fires, F.lit(i)).otherwise(idx)
    new = new.withColumn("__n_idx", idx).filter(F.col("__n_idx").isNotNull())
    out = []
    for name in tcols:
        value = F.lit(None)
        for i in reversed(range(len(clauses))):
            v = _value(clauses[i].insert, name, t, s, set(scols))
            value = F.when(F.col("__n_idx") == i, F.lit(None) if v is None else v).otherwise(value)
        out.append(value.cast(target.schema[name].dataType).alias(name))
    return target.unionByName(new.select(*out))


# Shapes used by the medallion flow -------------------------------------------------------

def merge_upsert(target: DataFrame, source: DataFrame, on, check_unique_source: bool = True) -> DataFrame:
    """MATCHED → UPDATE SET *; NOT MATCHED → INSERT *."""
    return merge(target, source, on, [Matched()], [NotMatched()], check_unique_source=check_unique_source)


def merge_conditional(target: DataFrame, source: DataFrame, on, newer_col: str) -> DataFrame:
    """Latest wins: update only when ``s.newer_col >= t.newer_col``; insert new keys."""
    return merge(target, source, on,
                 [Matched(cond=lambda t, s: s[newer_col] >= t[newer_col])], [NotMatched()])


def merge_guarded(target: DataFrame, source: DataFrame, on, owner_col: str, owner: str,
                  check_unique_source: bool = True) -> DataFrame:
    """Update only target rows owned by ``owner`` (``t.owner_col = owner``); insert new keys."""
    return merge(target, source, on,
                 [Matched(cond=lambda t, s: t[owner_col] == F.lit(owner))], [NotMatched()],
                 check_unique_source=check_unique_source)


def merge_insert_only(target: DataFrame, source: DataFrame, on) -> DataFrame:
    """NOT MATCHED → INSERT *; matched rows are never touched."""
    return merge(target, source, on, [], [NotMatched()], check_unique_source=False)
