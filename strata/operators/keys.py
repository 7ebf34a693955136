"""Dense surrogate keys without a single-task global sort.

``start + ROW_NUMBER() OVER (ORDER BY k)`` over a whole table puts every row
in one task. Here the rows are range-partitioned by the key, with boundaries
that Spark takes from a sample of the real keys (so outliers, shared prefixes
and any orderable type are fine), and written once with the number of their
range. Rows are numbered inside their range, and each range is shifted by the
rows before it. The counts have one row per range, at most the session's
shuffle partitions, so they are broadcast. The numbering equals the global
window's; the sample moves the boundaries only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.sinks.store import materialize

RANGE = "__sk_range"


def key_ranges(df: DataFrame, order_col: str, tiebreak: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``df`` with the number of its key range, staged in the shared folder; ranges rise with the key."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(order_col).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in tiebreak]]
    return materialize(df.repartitionByRange(n, *order).withColumn(RANGE, F.spark_partition_id()), "key_ranges")


def assign_surrogate_keys(df: DataFrame, order_col: str, out: str = "sk",
                          start: int | DataFrame = 0, tiebreak: Sequence[str] = (),
                          ranges: int | None = None) -> DataFrame:
    """Add ``out = start + row_number() over (order by order_col, tiebreak)``.

    ``start`` is an integer or a one-row DataFrame whose first column is the
    offset (e.g. ``COALESCE(MAX(sk), 0)`` of the existing dimension), fetched
    as a scalar. NULL order values sort first, as in the SQL window. Rows
    equal in the key and ``tiebreak`` share a range. ``ranges`` defaults to
    the session's shuffle partitions.
    """
    staged = key_ranges(df, order_col, tiebreak, ranges)
    base = int(start.first()[0] or 0) if isinstance(start, DataFrame) else int(start)
    counts = staged.groupBy(RANGE).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(RANGE, (F.coalesce(before, F.lit(0)) + F.lit(base)).cast("long").alias("__off"))
    w = Window.partitionBy(RANGE).orderBy(F.col(order_col).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in tiebreak])
    return (staged.withColumn("__rn", F.row_number().over(w)).join(F.broadcast(offsets), RANGE)
                  .withColumn(out, (F.col("__off") + F.col("__rn")).cast("long"))
                  .drop(RANGE, "__off", "__rn"))


def max_key(dim: DataFrame, sk: str) -> DataFrame:
    """One-row ``COALESCE(MAX(sk), 0)``."""
    return dim.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long").alias("max_sk"))
