"""Partition-scoped MERGE into a partitioned parquet table.

A full MERGE rewrites the whole target. When the target is partitioned and
every key lives in exactly one partition (the partition column is derived
from the key, e.g. a hash bucket, or from an attribute that never changes,
e.g. the event day), only the partitions the source touches can change:

1. the touched partitions, ``source.groupBy(parts).count()``, are staged: at
   most one row per partition folder (the driver lists those anyway);
2. the target is joined with them, and dynamic partition pruning turns that
   join into the list of folders the scan opens. No literals enter the plan, so
   it stays the same size for one partition or ten thousand;
3. ``merge`` runs on those rows only, the result is staged in the shared
   folder (the target path cannot be read and overwritten in one plan);
4. the staged rows replace exactly their partitions (dynamic partition
   overwrite); touched partitions left empty by deletes are removed.

Insert-only MERGE (no matched clause) rewrites nothing: new keys are appended.
A key is unique over the table, not only in its partition: a second delivery
whose partition differs (an event redelivered with another day) is no new row.
Which keys are stored is asked of a ``KeyIndex`` if there is one, else of the
key column of the whole table.

The cost is proportional to the touched partitions, not the table. Each
partition is replaced by a rename, so a failure mid-commit can leave some
partitions new and some old; re-running the same MERGE converges, since
MERGE with the same source is idempotent. A table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.columns import all_of
from strata.operators.merge import Matched, NotMatched, merge
from strata.sinks import store
from strata.sinks.key_index import KeyIndex, touched_partitions, within


def _fmt(spark, v) -> str:
    """Folder name of a partition value, escaped as Spark's writer does."""
    if v is None or v == "":
        return "__HIVE_DEFAULT_PARTITION__"
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(v))


def read_partitioned(source: DataFrame, path: str, parts: list[str]) -> DataFrame:
    """The table with the source's types for the partition columns (a folder name such as 01 stays text)."""
    spark = source.sparkSession
    found = store.table_schema(spark, path)
    schema = StructType([source.schema[f.name] if f.name in parts else f for f in found.fields])
    return spark.read.schema(schema).parquet(path)


def touched_rows(target_path: str, source: DataFrame, parts: list[str]) -> tuple[DataFrame, DataFrame]:
    """The target's rows in the partitions of ``source`` (pruned at run time), and the staged list of those partitions."""
    touched = touched_partitions(source, parts)
    return within(read_partitioned(source, target_path, parts), touched, parts), touched


def merge_into_partitions(target_path: str, source: DataFrame, on: Sequence[str] | str,
                          partition_cols: Sequence[str], matched: Sequence[Matched] = (),
                          not_matched: Sequence[NotMatched] = (), target_condition=None,
                          check_unique_source: bool = True, index: KeyIndex | None = None) -> list[tuple]:
    """MERGE ``source`` into the partitioned table at ``target_path``; return touched partitions.

    ``source`` must carry the partition columns with the values its keys
    live in. A first call (no committed data yet) writes the inserted rows.
    With ``index``, an insert-only MERGE asks it for the stored keys and adds the new ones.
    """
    spark = source.sparkSession
    parts, keys = list(partition_cols), ([on] if isinstance(on, str) else list(on))
    inserting = not matched and target_condition is None
    if not store.has_data(spark, target_path):
        new = merge(source.filter(F.lit(False)), source, on, [], list(not_matched) or [NotMatched()], check_unique_source=False)
        if index is not None:
            new = store.materialize(new, "first_rows")
            write = index.add(new)
        store.append(new, target_path, partition_by=parts)
        if index is not None:
            index.settle(write)
        return [tuple(r) for r in source.select(*parts).distinct().collect()]
    if inserting:
        # Existing rows never change, so nothing is rewritten: new keys are appended to their partitions.
        cols = store.table_schema(spark, target_path).names
        if index is not None:
            new = index.unseen(source.select(*cols), target_path)
        else:
            target = read_partitioned(source, target_path, parts)
            new = source.select(*cols).join(target.select(*keys), keys, "left_anti")
        new = merge(new.filter(F.lit(False)), new, keys, [], list(not_matched) or [NotMatched()], check_unique_source=False)
        if index is not None:
            new = store.materialize(new, "new_rows")
            write = index.add(new)  # before the rows: a key without its row is found out, a row without its key is not
        store.append(new.select(*cols), target_path, partition_by=parts)
        if index is not None:
            index.settle(write)
        return [tuple(r) for r in source.select(*parts).distinct().collect()]
    current, touched = touched_rows(target_path, source, parts)
    cols = current.columns
    merged = merge(current, source.select(*cols), on, matched, not_matched, target_condition, check_unique_source)
    # staged unpartitioned: an all-deleted result still has a readable schema
    staged = store.materialize(merged, "merge_partitions")
    store.clear_broken(spark, target_path)
    (staged.select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*parts).parquet(target_path))
    if any(m.delete for m in matched):
        left = staged.select(*[F.col(c).alias(f"__l_{c}") for c in parts]).distinct()
        emptied = touched.select(*parts).join(left, all_of(F.col(c).eqNullSafe(F.col(f"__l_{c}")) for c in parts), "left_anti")
        for row in emptied.collect():  # every row of the partition was deleted
            store.delete(spark, target_path.rstrip("/") + "/" + "/".join(f"{c}={_fmt(spark, v)}" for c, v in zip(parts, row)))
    return [tuple(r) for r in touched.select(*parts).collect()]
