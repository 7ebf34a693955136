"""Declarative expectation suites: unexpected counts, success flags, audit rows.

Semantics follow the public documentation of the common expectation
vocabulary: NULLs are skipped by every column-value expectation except
not-null; for uniqueness every member of a duplicated value is unexpected;
bounds are inclusive and either may be absent. Success means zero unexpected
values (no ``mostly`` threshold).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_COLUMNS = ["run_ts", "table_name", "expectation", "kwargs", "success", "observed"]


@dataclass(frozen=True)
class Expectation:
    kind: str
    kwargs: dict = field(default_factory=dict)

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column")

    def kwargs_json(self) -> str:
        return json.dumps(self.kwargs)


def values_not_null(column: str) -> Expectation:
    return Expectation("expect_column_values_to_not_be_null", {"column": column})


def values_unique(column: str) -> Expectation:
    return Expectation("expect_column_values_to_be_unique", {"column": column})


def values_between(column: str, min_value=None, max_value=None) -> Expectation:
    kw = {"column": column}
    if min_value is not None:
        kw["min_value"] = min_value
    if max_value is not None:
        kw["max_value"] = max_value
    return Expectation("expect_column_values_to_be_between", kw)


def values_in_set(column: str, value_set: Sequence) -> Expectation:
    return Expectation("expect_column_values_to_be_in_set", {"column": column, "value_set": list(value_set)})


def row_count_between(min_value=None, max_value=None) -> Expectation:
    kw = {}
    if min_value is not None:
        kw["min_value"] = min_value
    if max_value is not None:
        kw["max_value"] = max_value
    return Expectation("expect_table_row_count_to_be_between", kw)


def _unexpected(e: Expectation, rows: Column | None = None) -> Column | None:
    """Per-row aggregate for expectations that need no grouping (over ``rows`` only)."""
    kw = e.kwargs
    among = (lambda c: c) if rows is None else (lambda c: rows & c)
    if e.kind == "expect_column_values_to_not_be_null":
        return F.count_if(among(F.col(e.column).isNull()))
    if e.kind == "expect_column_values_to_be_between":
        c = F.col(e.column)
        bad = F.lit(False)
        if "min_value" in kw:
            bad = bad | (c < F.lit(kw["min_value"]))
        if "max_value" in kw:
            bad = bad | (c > F.lit(kw["max_value"]))
        return F.count_if(among(c.isNotNull() & bad))
    if e.kind == "expect_column_values_to_be_in_set":
        c = F.col(e.column)
        return F.count_if(among(c.isNotNull() & ~c.isin(list(kw["value_set"]))))
    if e.kind == "expect_table_row_count_to_be_between":
        return F.count(F.lit(1) if rows is None else F.when(rows, 1))
    return None


def row_counts(expectations: Sequence[Expectation], rows: Column | None = None) -> dict[str, Column]:
    """The row-level expectations of one table by their place in the suite, for a ``Watch`` over its write."""
    found = {f"expectation_{i}": _unexpected(e, rows) for i, e in enumerate(expectations)}
    return {n: c for n, c in found.items() if c is not None}


def _success(e: Expectation, observed: Column) -> Column:
    if e.kind == "expect_table_row_count_to_be_between":
        ok = F.lit(True)
        if "min_value" in e.kwargs:
            ok = ok & (observed >= F.lit(e.kwargs["min_value"]))
        if "max_value" in e.kwargs:
            ok = ok & (observed <= F.lit(e.kwargs["max_value"]))
        return ok
    return observed == 0


def unexpected_counts(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """``(idx, observed)`` per expectation; row-level ones share one aggregate.

    ``observed`` is the unexpected count, or the row count for row-count
    expectations.
    """
    parts: list[DataFrame] = []
    simple = [(i, e) for i, e in enumerate(expectations) if _unexpected(e) is not None]
    if simple:
        wide = df.agg(*[_unexpected(e).cast("long").alias(f"m{i}") for i, e in simple])
        pairs = ", ".join(f"{i}, m{i}" for i, _ in simple)
        parts.append(wide.selectExpr(f"stack({len(simple)}, {pairs}) AS (idx, observed)"))
    for i, e in enumerate(expectations):
        if e.kind == "expect_column_values_to_be_unique":
            per_value = (df.filter(F.col(e.column).isNotNull())
                           .groupBy(e.column).agg(F.count(F.lit(1)).alias("__c")))
            parts.append(per_value.agg(F.coalesce(F.sum(F.when(F.col("__c") > 1, F.col("__c"))), F.lit(0))
                                       .cast("long").alias("observed"))
                                  .select(F.lit(i).alias("idx"), "observed"))
        elif _unexpected(e) is None:
            raise ValueError(f"unknown expectation {e.kind!r}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_suite(df: DataFrame, table_name: str, expectations: Sequence[Expectation],
              run_ts: Column | None = None) -> DataFrame:
    """Audit rows ``(run_ts, table_name, expectation, kwargs, success, observed)``."""
    counts = unexpected_counts(df, expectations)
    meta = df.sparkSession.createDataFrame(
        [(i, e.kind, e.kwargs_json()) for i, e in enumerate(expectations)],
        "idx int, expectation string, kwargs string")
    j = counts.join(F.broadcast(meta), "idx")
    success = None
    for i, e in enumerate(expectations):
        s = _success(e, F.col("observed"))
        success = F.when(F.col("idx") == i, s) if success is None else success.when(F.col("idx") == i, s)
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    return j.select(run_ts.alias("run_ts"), F.lit(table_name).alias("table_name"), "expectation",
                    "kwargs", success.alias("success"), "observed")


def observed_results(spark: SparkSession, counts: Mapping[str, int], table_name: str, expectations: Sequence[Expectation],
                     run_ts: Column | None = None) -> DataFrame:
    """The audit rows of ``run_suite`` for the expectations that a write has counted (one row each, no scan)."""
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    out = None
    for i, e in enumerate(expectations):
        if f"expectation_{i}" in counts:
            n = F.lit(counts[f"expectation_{i}"]).cast("long")
            row = spark.range(1).select(run_ts.alias("run_ts"), F.lit(table_name).alias("table_name"), F.lit(e.kind).alias("expectation"),
                                        F.lit(e.kwargs_json()).alias("kwargs"), _success(e, n).alias("success"), n.alias("observed"))
            out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError(f"no expectation of {table_name} was counted")
    return out


class ExpectationsFailed(RuntimeError):
    def __init__(self, failed: int):
        self.failed = failed
        super().__init__(f"expectations FAILED: {failed} expectation(s) not met")


def assert_suite(results: DataFrame) -> None:
    """Raise with the number of failed expectations (results: one row each)."""
    failed = results.filter(~F.col("success")).count()
    if failed:
        raise ExpectationsFailed(failed)
