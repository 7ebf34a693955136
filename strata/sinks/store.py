"""Table storage at the edges: versioned replace, append, day layout, lineage cuts.

Parquet on a path cannot be overwritten while the same plan reads it (the
source files are deleted first), so every replace writes a fresh version
folder and readers pick the newest committed one. All paths live under the
cluster's shared folder, never a machine-local temp dir.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.observed import Watch
from strata.session import scratch_path

_VERSION = "v="


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, watch: Watch | None = None) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (later plans start from files, so a lost executor only
    re-reads them) and gives later scans column pruning and filter pushdown,
    unlike ``DataFrame.checkpoint``'s row format. ``watch`` counts in the write.
    Compressed as the tables of a cluster are (``session.CLUSTER_CONF``), whatever the session's default.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _writer(df, "error", partition_by, watch).option("compression", "zstd").parquet(path)
    return read_as(spark, path, df.schema)


def read_as(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path`` with the schema it was written with, also if it holds no file (a partitioned write of no rows)."""
    names = [f"`{c}`" for c in schema.fieldNames()]
    return spark.read.schema(schema).parquet(path).select(*names)


def with_day(df: DataFrame, ts_col: str, out: str = "dt") -> DataFrame:
    """Materialised day column for a day-partitioned layout (``days(ts)``)."""
    return df.withColumn(out, F.to_date(F.col(ts_col)))


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """A typed empty table the optimizer can see through.

    ``createDataFrame([])`` is an opaque RDD scan; a ``WHERE false`` over a
    one-row projection folds to an empty local relation, so e.g. a first
    run's MERGE into a missing target plans no join at all.
    """
    return (spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
                 .filter(F.lit(False)))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a committed data file lies under ``path`` (a broken-off first write leaves ``_temporary`` alone)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return False
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not name.startswith(("_", ".")) and (not st.isDirectory() or has_data(spark, st.getPath().toString())):
            return True
    return False


def table_schema(spark: SparkSession, path: str) -> StructType:
    """The schema of the table at ``path`` by one of its files: its folders, which may be many, are not all listed."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def first(folder) -> str | None:
        for st in fs.listStatus(folder):
            if not st.getPath().getName().startswith(("_", ".")):
                found = first(st.getPath()) if st.isDirectory() else st.getPath().toString()
                if found is not None:
                    return found
        return None
    file = first(at)
    return (spark.read.parquet(path) if file is None else spark.read.option("basePath", path).parquet(file)).schema


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p).close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in ``folder``, by name; nothing if there is no such folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


def clear_broken(spark: SparkSession, path: str) -> None:
    """Delete what a broken-off write left beside the table's files.

    The next commit into the same folder would publish its finished tasks as well.
    For tables with one writer at a time.
    """
    delete(spark, f"{path.rstrip('/')}/_temporary")


def recorded_number(spark: SparkSession, path: str, asked: int | None, default: int) -> int:
    """A table's number of buckets, recorded beside it (``<path>_layout``) when it is first asked for."""
    record = path.rstrip("/") + "_layout"
    if not path_exists(spark, record + "/_SUCCESS"):
        n = asked or default
        spark.range(1).select(F.lit(n).alias("buckets")).write.mode("overwrite").parquet(record)
        return n
    found = spark.read.parquet(record).first().buckets
    if asked not in (None, found):
        raise ValueError(f"{path} is laid out in {found} buckets, not {asked}")
    return found


def _versions(spark: SparkSession, base: str, committed: bool = True) -> list[int]:
    """Version numbers in ascending order: committed ones, or all folders (also of a write that broke off)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        done = not committed or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
        if name.startswith(_VERSION) and name[len(_VERSION):].isdigit() and done:
            out.append(int(name[len(_VERSION):]))
    return sorted(out)


def _writer(df: DataFrame, mode: str, partition_by: list[str] | None, watch: Watch | None = None):
    if partition_by:
        # AQE rebalance: one shuffle on the partition columns that splits big
        # partitions and merges small ones, so each day gets a few right-sized
        # files instead of one small file per task.
        df = df.hint("rebalance", *partition_by)
    if watch is not None:
        df = watch(df)
    return df.write.mode(mode).partitionBy(*partition_by) if partition_by else df.write.mode(mode)


def next_version(spark: SparkSession, base: str) -> str:
    """The folder of the next version. One left by a write that broke off keeps its number and is never read or written again."""
    vs = _versions(spark, base, committed=False)
    return f"{base.rstrip('/')}/{_VERSION}{(vs[-1] + 1) if vs else 0}"


def write_version(df: DataFrame, base: str, partition_by: list[str] | None = None, path: str | None = None,
                  watch: Watch | None = None, judge: Callable[[dict[str, int]], None] | None = None) -> str:
    """Create-or-replace: write a new committed version folder (``path``, by default the next one); return its path.

    ``watch`` counts in the write. ``judge`` gets the counts before the version is
    committed and refuses it by raising: the folder then never gets its mark, so
    readers stay with the version before, and ``expire`` deletes it by age.
    """
    path = path or next_version(df.sparkSession, base)
    writer = _writer(df, "error", partition_by, watch)
    if judge is None:
        writer.parquet(path)
        return path
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    judge(watch.get() if watch is not None else {})
    jvm = df.sparkSession.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    mark.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).create(mark).close()
    return path


def expire(spark: SparkSession, base: str, keep: int, older_than_seconds: float) -> list[str]:
    """Delete old versions of a replaced table; return their paths.

    The newest ``keep`` committed versions stay, and so does any folder changed in
    the last ``older_than_seconds``: longer than the longest job that may still be
    reading a version or writing one. Folders of broken-off writes go by age alone.
    """
    if keep < 1:
        raise ValueError("keep at least the newest version")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept = set(_versions(spark, base)[-keep:])
    limit = jvm.java.lang.System.currentTimeMillis() - int(older_than_seconds * 1000)
    gone = []
    for n in _versions(spark, base, committed=False):
        path = f"{base.rstrip('/')}/{_VERSION}{n}"
        if n not in kept and fs.getFileStatus(jvm.org.apache.hadoop.fs.Path(path)).getModificationTime() <= limit:
            # its mark goes first: nobody starts to read a version that is being deleted
            delete(spark, f"{path}/_SUCCESS")
            delete(spark, path)
            gone.append(path)
    return gone


def read_latest(spark: SparkSession, base: str, schema: StructType | None = None) -> DataFrame:
    """Newest committed version; an empty typed table if none exists yet."""
    vs = _versions(spark, base)
    if not vs:
        if schema is None:
            raise FileNotFoundError(base)
        return empty_table(spark, schema)
    path = f"{base.rstrip('/')}/{_VERSION}{vs[-1]}"
    return spark.read.parquet(path) if schema is None or has_data(spark, path) else read_as(spark, path, schema)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows by name (the file set is the table; one writer at a time)."""
    clear_broken(df.sparkSession, path)
    _writer(df, "append", partition_by).parquet(path)
