"""Column-expression helpers shared by the operators.

All helpers return built-in Catalyst expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType, TimestampNTZType

ColumnLike = str | Column

# Open end of a validity interval (the reference closes open
# versions at this instant) and the default "unknown member" surrogate key.
OPEN_END = "9999-12-31 00:00:00"
UNKNOWN_SK = -1


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sort_key(spec: ColumnLike) -> Column:
    """``"ts DESC"`` / ``"ts"`` / a Column → a sort expression.

    DESC sorts NULLs last and ASC NULLs first, as in Spark SQL.
    """
    if isinstance(spec, Column):
        return spec
    parts = spec.split()
    name = parts[0]
    direction = parts[1].upper() if len(parts) > 1 else "ASC"
    if direction not in ("ASC", "DESC"):
        raise ValueError(f"bad sort spec {spec!r}")
    return F.col(name).desc() if direction == "DESC" else F.col(name).asc()


def sort_keys(specs: Iterable[ColumnLike] | ColumnLike | None) -> list[Column]:
    if specs is None:
        return []
    if isinstance(specs, (str, Column)):
        specs = [specs]
    return [sort_key(s) for s in specs]


def all_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def any_of(preds: Iterable[Column]) -> Column:
    """Balanced OR: the expression is log(n) deep however many there are."""
    preds = list(preds)
    while len(preds) > 1:
        preds = [reduce(lambda a, b: a | b, preds[i:i + 2]) for i in range(0, len(preds), 2)]
    return preds[0] if preds else F.lit(False)


def not_null(cols: Sequence[ColumnLike]) -> Column:
    """TRUE when every column is non-NULL."""
    return all_of(col(c).isNotNull() for c in cols)


def any_null(cols: Sequence[ColumnLike]) -> Column:
    return any_of(col(c).isNull() for c in cols)


def differs(a: Column, b: Column, null_safe: bool = False) -> Column:
    """``a <> b``; NULL-unsafe by default (NULL on either side → NULL)."""
    return ~a.eqNullSafe(b) if null_safe else (a != b)


def whole_seconds(ts: ColumnLike) -> Column:
    """Seconds since the epoch, truncated to whole seconds (``unix_timestamp``)."""
    return F.unix_timestamp(col(ts))


def date_key(ts: ColumnLike) -> Column:
    """``yyyyMMdd`` as INT, computed arithmetically (no string formatting)."""
    d = F.to_date(col(ts))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def try_cast_to(schema: StructType | str, df: DataFrame) -> list[Column]:
    """Project ``df`` onto ``schema``: columns by name, each ``try_cast``.

    A value that does not parse becomes NULL instead of failing the job (the
    pre-ANSI cast behaviour the ingestion relies on). Text times with a zone
    become wall-clock times of the session's zone (UTC, ``session.apply_policy``);
    zone-less ones are kept.
    """
    if isinstance(schema, str):
        schema = flat_schema(schema)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"input lacks columns {missing}")
    out = []
    for f in schema.fields:
        src = df.schema[f.name].dataType
        c = F.col(f.name)
        if src == f.dataType:
            out.append(c)
        elif isinstance(src, StringType) and isinstance(f.dataType, TimestampNTZType):
            # a cast to NTZ drops the zone and a cast to TIMESTAMP takes a bare time of day, so both must parse
            out.append(F.when(c.try_cast(f.dataType).isNotNull(), c.try_cast("timestamp").cast(f.dataType)).alias(f.name))
        else:
            out.append(c.try_cast(f.dataType).alias(f.name))
    return out


def typed_null(dt: DataType | str) -> Column:
    return F.lit(None).cast(dt)


_TYPES = {
    "string": "StringType", "int": "IntegerType", "integer": "IntegerType", "bigint": "LongType",
    "long": "LongType", "double": "DoubleType", "boolean": "BooleanType", "date": "DateType",
    "timestamp": "TimestampType", "timestamp_ntz": "TimestampNTZType",
}


def flat_schema(ddl: str) -> StructType:
    """``"a string, b bigint"`` → StructType, without needing a live session.

    Flat primitive fields only (``StructType.fromDDL`` needs a running JVM,
    which module-level constants cannot assume).
    """
    from pyspark.sql import types as T
    fields = []
    for part in ddl.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, getattr(T, _TYPES[typ.lower()])(), True))
    return StructType(fields)


def null_key_salt(keys: Sequence[str], cols: Sequence[str]) -> Column:
    """Extra join key that spreads NULL-key rows without letting them match.

    0 for rows whose keys are all set; for rows with a NULL key, a hash of the
    whole row. Joining on ``key = key AND salt = salt`` leaves matches of
    non-NULL keys unchanged (both salts 0), while NULL keys still never match
    (``NULL = x`` is not true) but now hash to many partitions instead of
    one. Deterministic, so a retried task partitions its rows identically.

    The 0 is written as ``xxhash64(keys) & 0``: a literal 0 (or ``x * 0``,
    which Catalyst simplifies when ``x`` cannot be NULL) would be
    constant-folded, and the optimizer would then demote the salt equality to
    a residual filter, leaving the join keyed, and partitioned, by the key
    alone. ``tests/test_skew.py`` checks the salt stays a join key.
    """
    zero = F.xxhash64(*[F.col(k) for k in keys]).bitwiseAND(F.lit(0).cast("long"))
    return F.when(any_null(list(keys)), F.xxhash64(*[F.col(c) for c in cols])).otherwise(zero)
