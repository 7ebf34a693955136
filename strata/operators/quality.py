"""Data-quality checks with severities, a gate and an audit row per check.

Each check yields one ``violations`` count (0 = pass). Checks on the same
table that are plain row predicates (not-empty, NULL keys, predicates) are
evaluated together in one aggregate over one scan and unpivoted with
``stack``; duplicate, integrity and single-current checks are two-level
aggregates or anti joins that pre-aggregate before their shuffle. All
results come back as one small DataFrame (one row per check), so the gate
reads a bounded result, never the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import any_null

ERROR, WARN = "ERROR", "WARN"

RESULT_COLUMNS = ["run_ts", "stage", "check_name", "severity", "violations", "passed"]


@dataclass(frozen=True)
class Check:
    name: str
    severity: str
    kind: str
    table: str
    params: Mapping = field(default_factory=dict)


def not_empty(name: str, table: str, severity: str = ERROR) -> Check:
    """1 when the table has no rows, else 0."""
    return Check(name, severity, "not_empty", table)


def null_keys(name: str, table: str, cols: Sequence[str], severity: str = ERROR) -> Check:
    """Rows where any of ``cols`` is NULL."""
    return Check(name, severity, "null_keys", table, {"cols": tuple(cols)})


def duplicates(name: str, table: str, key: Sequence[str] | str, severity: str = ERROR, within: str | None = None) -> Check:
    """Surplus rows ``Σ(count − 1)`` over key groups; NULL keys form one group.

    ``within``: a column that the key (a single one) determines. Where the table has it, rows that a
    join has partitioned by it are grouped without another shuffle.
    """
    key = (key,) if isinstance(key, str) else tuple(key)
    if within and len(key) > 1:
        raise ValueError("'within' goes with a single key")
    return Check(name, severity, "duplicates", table, {"key": key, "within": within})


def predicate(name: str, table: str, bad: str | Column, severity: str = ERROR) -> Check:
    """Rows where ``bad`` is TRUE (NULL is not a violation)."""
    return Check(name, severity, "predicate", table, {"bad": bad})


def ref_integrity(name: str, table: str, key: str, parent: str, parent_key: str | None = None,
                  severity: str = ERROR) -> Check:
    """Child rows without a parent row; NULL child keys count as violations."""
    return Check(name, severity, "ref_integrity", table,
                 {"key": key, "parent": parent, "parent_key": parent_key or key})


def single_current(name: str, table: str, key: str, flag: str = "is_current",
                   severity: str = ERROR) -> Check:
    """Keys with more than one current row (keys with none pass)."""
    return Check(name, severity, "single_current", table, {"key": key, "flag": flag})


def _expr(c: str | Column) -> Column:
    return F.expr(c) if isinstance(c, str) else c


#: Checks that are plain row predicates: one aggregate, or a count in the write of the table.
ROW_KINDS = ("not_empty", "null_keys", "predicate")


def _row_metric(check: Check, rows: Column | None = None) -> Column | None:
    """A per-table aggregate for checks that are plain row predicates (over ``rows`` only)."""
    among = (lambda c: c) if rows is None else (lambda c: rows & c)
    if check.kind == "not_empty":
        return F.when(F.count(F.lit(1) if rows is None else F.when(rows, 1)) == 0, 1).otherwise(0).cast("long")
    if check.kind == "null_keys":
        return F.count_if(among(any_null(list(check.params["cols"])))).cast("long")
    if check.kind == "predicate":
        return F.count_if(among(F.coalesce(_expr(check.params["bad"]), F.lit(False)))).cast("long")
    return None


def row_counts(checks: Sequence[Check], rows: Column | None = None) -> dict[str, Column]:
    """The row checks of one table by name, for a ``Watch`` over its write; ``rows``
    says which of the rows written make up the table (all, by default)."""
    return {c.name: _row_metric(c, rows) for c in checks if c.kind in ROW_KINDS}


def _violations(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables[check.table]
    p = check.params
    if check.kind == "duplicates":
        if p.get("within") in df.columns:
            key = F.col(p["key"][0])
            per_key = df.groupBy(p["within"], key).agg(F.count(F.lit(1)).alias("__c"))
            nulls = F.sum(F.when(key.isNull(), F.col("__c")))  # a NULL key determines nothing: its groups are one
            return per_key.agg((F.coalesce(F.sum(F.when(key.isNotNull(), F.col("__c") - 1)), F.lit(0)) + F.coalesce(nulls - 1, F.lit(0)))
                               .cast("long").alias("violations"))
        per_key = df.groupBy(*p["key"]).agg(F.count(F.lit(1)).alias("__c"))
        return per_key.agg(F.coalesce(F.sum(F.when(F.col("__c") > 1, F.col("__c") - 1)), F.lit(0))
                           .cast("long").alias("violations"))
    if check.kind == "ref_integrity":
        parent = tables[p["parent"]].select(F.col(p["parent_key"]).alias("__pk")).distinct()
        child = df.select(F.col(p["key"]).alias("__ck"))
        # one row per child key before the join, so neither a hot key nor the
        # NULL keys (orphans by definition, one group) are shuffled row by row
        keys = child.groupBy("__ck").agg(F.count(F.lit(1)).alias("__n"))
        return (keys.join(parent, F.col("__ck") == F.col("__pk"), "left_anti")
                    .agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("violations")))
    if check.kind == "single_current":
        per_key = df.filter(F.col(p["flag"])).groupBy(p["key"]).agg(F.count(F.lit(1)).alias("__c"))
        return per_key.agg(F.count_if(F.col("__c") > 1).cast("long").alias("violations"))
    raise ValueError(f"unknown check kind {check.kind!r}")


def check_counts(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """``(check_name, violations)`` for every check, as one DataFrame."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if _row_metric(c) is not None:
            by_table.setdefault(c.table, []).append(c)
        else:
            parts.append(_violations(c, tables).select(F.lit(c.name).alias("check_name"), "violations"))
    for table, cs in by_table.items():
        wide = tables[table].agg(*[_row_metric(c).alias(f"m{i}") for i, c in enumerate(cs)])
        pairs = ", ".join(f"'{c.name}', m{i}" for i, c in enumerate(cs))
        parts.append(wide.selectExpr(f"stack({len(cs)}, {pairs}) AS (check_name, violations)"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check], stage: str,
               run_ts: Column | None = None) -> DataFrame:
    """Audit rows ``(run_ts, stage, check_name, severity, violations, passed)``."""
    spark = tables[checks[0].table].sparkSession
    meta = spark.createDataFrame([(c.name, c.severity) for c in checks],
                                 "check_name string, severity string")
    counts = check_counts(tables, checks)
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    return (counts.join(F.broadcast(meta), "check_name")
                  .select(run_ts.alias("run_ts"), F.lit(stage).alias("stage"), "check_name", "severity",
                          "violations", (F.col("violations") == 0).alias("passed")))


def observed_results(spark: SparkSession, counts: Mapping[str, int], checks: Sequence[Check], stage: str,
                     run_ts: Column | None = None) -> DataFrame:
    """The audit rows of ``run_checks`` for the checks that a write has counted (one row per check, no scan)."""
    found = spark.createDataFrame([(c.name, c.severity, counts[c.name]) for c in checks if c.name in counts],
                                  "check_name string, severity string, violations long")
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    return found.select(run_ts.alias("run_ts"), F.lit(stage).alias("stage"), "check_name", "severity",
                        "violations", (F.col("violations") == 0).alias("passed"))


class QualityGateError(RuntimeError):
    def __init__(self, stage: str, failed: Sequence[str]):
        self.stage, self.failed = stage, list(failed)
        super().__init__(f"data quality FAILED for stage '{stage}': {', '.join(failed)}")


def gate(results: DataFrame, stage: str | None = None) -> list[str]:
    """Raise ``QualityGateError`` if any ERROR check failed; return WARN failures.

    ``results`` has one row per check, so collecting it is bounded.
    """
    rows = results.filter(~F.col("passed")).select("check_name", "severity", "stage").collect()
    errors = sorted(r.check_name for r in rows if r.severity == ERROR)
    if errors:
        raise QualityGateError(stage or (rows[0].stage if rows else ""), errors)
    return sorted(r.check_name for r in rows)
