"""Sharding by proportional stratified interleaving.

Within each source the rows are ranked in a seeded shuffle. A row's fractional
rank is (rank + 1/2) / rows of its source. Sorted by it, every stretch of the
table holds the sources in their overall proportions, so cutting the order into
equal runs gives shards that match the mixture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import fresh, stage

def _numbered(spark: SparkSession, df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` with ``out``, each row's 0-based place in ``order`` (a total order).

    Rows go to ranges of the order, are numbered inside their range in the write
    that stages them, and add the sizes of the ranges before. Ranges are cut
    by Spark's sample of the whole order, so no group of rows is one task's work.
    """
    at = F.monotonically_increasing_id()     # range number, then 33 bits of the place inside
    ranged = stage(spark, df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at), "shard-order")
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    # a row per range, at most the shuffle partitions
    sizes = ranged.groupBy("part").agg(F.count("*").alias("c"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(F.broadcast(before), "part").withColumn(out, place).drop("part", "at", "before")


def interleave(spark: SparkSession, rows: DataFrame, shards: int, source_col: str = "source", key_cols: tuple[str, ...] = ("doc_id",),
               seed: str = "strata") -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard);
    with more underscores where ``rows`` has such a column in any case.

    Shard sizes differ by one row at most. The shuffle order is the md5 of seed and
    ``key_cols`` (then the keys themselves; rows equal in all of them keep the order
    they are staged in). A null source is a source of its own, null keys count as
    such; fewer rows than shards leave shards empty; no rows give no rows. Only
    ``rows`` as given moves, so pass ids and digests instead of texts.
    """
    name = F.concat_ws("\x1f", F.lit(seed), *[F.coalesce(rows[c].cast("string"), F.lit("\x00")) for c in key_cols])
    keys = [f"k{i}" for i in range(len(key_cols))]
    df = stage(spark, rows.select(F.struct(*[rows[c] for c in rows.columns]).alias("row"), rows[source_col].alias("source"), F.md5(name).alias("h"),
                                  *[rows[c].alias(k) for c, k in zip(key_cols, keys)], F.monotonically_increasing_id().alias("rid")), "shard-rows")
    df = _numbered(spark, df, [F.asc_nulls_last("source"), F.asc("h"), *map(F.asc_nulls_last, keys), F.asc("rid")], "pos").select("row", "source", "pos")
    # staged: beside an aggregate Spark cannot split a source's rows
    size = stage(spark, df.groupBy("source").agg(F.min("pos").alias("start"), F.count("*").alias("n")), "shard-sources")
    size = size.withColumnRenamed("source", "of")
    df = df.join(size, df["source"].eqNullSafe(size["of"])).drop("of")
    df = df.withColumn("f", (2 * (F.col("pos") - F.col("start")) + 1) / (2 * F.col("n")).cast("double")).select("row", "source", "f")
    total = int(size.agg(F.sum("n")).first()[0] or 0)
    df = _numbered(spark, df, [F.asc("f"), F.asc_nulls_last("source")], "pos")
    # exact in whole numbers: shard = floor(pos * shards / total), begun at ceil(shard * total / shards)
    shard = F.expr(f"cast((pos * {shards}) div {max(total, 1)} as int)")
    begin = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    return df.withColumn("shard", shard).withColumn("slot", F.col("pos") - begin).select(
        *[F.col("row")[c].alias(c) for c in rows.columns], F.col("shard").alias(fresh(rows, "shard")), F.col("slot").alias(fresh(rows, "slot")))
