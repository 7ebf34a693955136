"""Which keys a growing table holds, without reading the table.

The index is a table of its own: stored keys and the partition they lie in, laid
out in hash buckets of the key. A batch opens the buckets of its keys alone
(dynamic partition pruning); at scale Spark's runtime Bloom filter drops the
other keys of those buckets while they are scanned.

Keys enter the index before their rows enter the table. A write is marked as
open (a small file in ``<path>_open``) from its first key to its last row, and its
entries name it. A key of a write that ended counts as stored; a key of a write
that is open or unknown only if the row is found in the partition it names. So a
write that breaks off anywhere loses no row and doubles none when the batch
comes again, and a batch opens the table for the keys of broken-off writes alone.
Rows are added to such a table and not taken out: who deletes some deletes the
index and its ``_layout`` too, and ``KeyIndex.beside`` makes it anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import all_of, not_null
from strata.sinks import store

#: Partitions that a batch touches at most for their list to be broadcast (a few bytes each); beyond it a shuffled join reads them.
MAX_BROADCAST_PARTITIONS = 100_000
DEFAULT_BUCKETS = 64
_ROWS = "__rows"
_WRITE = "__write"
_ENDED = "__ended"


def touched_partitions(source: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The partitions of ``source``, staged: one row each."""
    return store.materialize(source.groupBy(*parts).agg(F.count(F.lit(1)).alias(_ROWS)), "touched_partitions")


def within(table: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The rows of ``table`` in the staged partitions, by a join that prunes the scan while it runs."""
    # one row for each set of columns that are NULL together: almost always one
    shapes = touched.select(*[F.col(c).isNull().alias(c) for c in parts], F.lit(1).alias(_ROWS)).groupBy(*parts).agg(F.sum(_ROWS).alias(_ROWS)).collect()
    found = None
    for shape in shapes:
        null = [c for c in parts if shape[c]]
        known = [c for c in parts if not shape[c]]
        rows = table.filter(all_of(F.col(c).isNull() for c in null)) if null else table
        if known:
            # Spark prunes by equality with a side that has a predicate of its own
            side = touched.filter(F.col(_ROWS) > 0)
            side = side.filter(all_of(F.col(c).isNull() for c in null)) if null else side
            side = side.select(*[F.col(c).alias(f"__p_{c}") for c in known])
            side = F.broadcast(side) if shape[_ROWS] <= MAX_BROADCAST_PARTITIONS else side
            rows = rows.join(side, all_of(F.col(c) == F.col(f"__p_{c}") for c in known), "left_semi")
        found = rows if found is None else found.unionByName(rows)
    return table.filter(F.lit(False)) if found is None else found


class KeyIndex:
    """Stored keys of the partitioned table whose rows have ``key`` columns and ``parts`` columns.

    ``buckets`` is recorded when the index is made and cannot change later.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] | str, parts: Sequence[str], buckets: int | None = None,
                 record: bool = True):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.parts = [key] if isinstance(key, str) else list(key), list(parts)
        self.buckets = store.recorded_number(spark, self.path, buckets, DEFAULT_BUCKETS) if record else buckets or DEFAULT_BUCKETS

    @classmethod
    def beside(cls, spark: SparkSession, table_path: str, key: Sequence[str] | str, parts: Sequence[str], buckets: int | None = None) -> KeyIndex:
        """The index ``<table_path>_keys``. A table that is older than its index has its keys entered first;
        the number of buckets is recorded only then, so an attempt that breaks off is made anew."""
        path = table_path.rstrip("/") + "_keys"
        if not store.path_exists(spark, f"{path}_layout/_SUCCESS") and store.has_data(spark, table_path):
            store.delete(spark, path)
            store.delete(spark, f"{path}_open")
            older = cls(spark, path, key, parts, buckets, record=False)
            older.settle(older.add(spark.read.parquet(table_path)))
        return cls(spark, path, key, parts, buckets)

    def _entries(self, rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int").alias("bucket")
        return rows.filter(not_null(self.key)).select(*self.key, *self.parts, bucket)

    def add(self, rows: DataFrame) -> str:
        """Enter the keys of ``rows`` and return the name of the write, for ``settle`` once the rows are stored.
        An entry may be there already: that does no harm."""
        write = uuid.uuid4().hex
        store.touch(self.spark, f"{self.path}_open/{write}")
        store.append(self._entries(rows).withColumn(_WRITE, F.lit(write)), self.path, partition_by=["bucket"])
        return write

    def settle(self, write: str) -> None:
        """All rows of this write are in the table."""
        store.delete(self.spark, f"{self.path}_open/{write}")

    def _ended(self) -> tuple[Column, list[str]]:
        """Whether an entry's write ended (entries that name none are as those of a broken-off write), and the open writes."""
        broken = store.names(self.spark, f"{self.path}_open")
        named = F.col(_WRITE).isNotNull()
        return named & ~F.col(_WRITE).isin(broken) if broken else named, broken

    def candidates(self, batch: DataFrame) -> DataFrame:
        """Entries whose key is in ``batch``, and whether a write of theirs ended: read from the batch's buckets alone."""
        wanted = self._entries(batch)
        stored = self.spark.read.schema(wanted.schema.add(_WRITE, "string")).parquet(self.path)
        near = within(stored, touched_partitions(wanted, ["bucket"]), ["bucket"])
        near = near.join(wanted.select(*self.key, "bucket"), [*self.key, "bucket"], "left_semi")
        return near.groupBy(*self.key, *self.parts).agg(F.max(self._ended()[0]).alias(_ENDED))

    def unseen(self, batch: DataFrame, table_path: str) -> DataFrame:
        """The rows of ``batch`` whose key the table does not hold; rows without a key are always among them.
        The batch is read several times: stage it before."""
        if not store.has_data(self.spark, self.path) or not store.has_data(self.spark, table_path):
            return batch
        found = store.materialize(self.candidates(batch), "known_keys")
        if found.isEmpty():
            return batch
        stored = found.filter(F.col(_ENDED)).select(*self.key)
        doubtful = found.filter(~F.col(_ENDED))
        if not doubtful.isEmpty():
            # a write that broke off may have left keys whose rows were never written: look at the rows themselves
            schema = [f for f in store.table_schema(self.spark, table_path) if f.name not in self.parts]
            table = self.spark.read.schema(type(batch.schema)([*schema, *[batch.schema[c] for c in self.parts]])).parquet(table_path)
            rows = within(table, touched_partitions(doubtful, self.parts), self.parts).select(*self.key)
            stored = stored.unionByName(doubtful.select(*self.key).distinct().join(rows, self.key, "left_semi"))
        return batch.join(stored, self.key, "left_anti")

    def compact(self) -> None:
        """Rewrite the index with one entry a key and place, a few files a bucket (between batches). Marks of broken-off writes go."""
        if store.has_data(self.spark, self.path):
            entries = self.spark.read.option("mergeSchema", "true").parquet(self.path)
            if _WRITE not in entries.columns:
                entries = entries.withColumn(_WRITE, F.lit(None).cast("string"))
            ended, broken = self._ended()
            whole = store.materialize(entries.groupBy(*self.key, *self.parts, "bucket").agg(F.max(F.when(ended, F.col(_WRITE))).alias(_WRITE)), "key_index")
            store.clear_broken(self.spark, self.path)
            (whole.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                  .partitionBy("bucket").parquet(self.path))
            for write in broken:
                self.settle(write)
