"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: Text bytes that one task-side block holds at a time (one row at least).
BLOCK_BYTES = 4 << 20

_OPEN: list[tuple[SparkSession, str]] = []


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: what follows survives lost executors without running the
    earlier jobs again, and row ids given before the write stay as they are.
    """
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    _OPEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release() -> int:
    """Delete the staged tables of earlier operators; their results must be written by then."""
    n = 0
    while _OPEN:
        spark, path = _OPEN.pop()
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        n += bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))
    return n


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have in any case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def doc_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, as ``doc_id`` and ``text`` (other columns cannot clash)."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def staged_rows(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a row id ``rid``, fixed by one write (equal rows get different ids)."""
    return stage(spark, docs.withColumn("rid", F.monotonically_increasing_id()), name)


def text_bytes(df: DataFrame) -> int:
    """Total UTF-8 bytes of ``text`` (one number reaches the driver)."""
    return int(df.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of about ``limit`` bytes of ``column``, whole rows only."""
    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        ends, start = np.cumsum(size), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The column's UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in one array, and where each text starts (one more entry: the end)."""
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    return np.frombuffer(b"".join(texts), np.uint8), off


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (an invertible finaliser), so that all bits depend on all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any slices of a 64-bit sequence from one running sum (modulo 2**64)."""

    def __init__(self, values: np.ndarray, base: int):
        n = len(values)
        inverse = pow(base, -1, 1 << 64)
        with np.errstate(over="ignore"):
            up = _powers(base, n)
            self.down = _powers(inverse, n)
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(values.astype(np.uint64, copy=False) * up, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * self.down[np.minimum(start, len(self.down) - 1)]

    def every(self, size: int) -> np.ndarray:
        """The hash of ``size`` values from each place on."""
        n = len(self.sums) - size
        with np.errstate(over="ignore"):
            return (self.sums[size:] - self.sums[:n]) * self.down[:n]


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n + 1:
        with np.errstate(over="ignore"):
            have = np.full(max(n + 1, 1 << 16), base, np.uint64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        if n <= 2 * BLOCK_BYTES:
            _POWERS[base] = have
    return have[:n] if n else have[:1]
