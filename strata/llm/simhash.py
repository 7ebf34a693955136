"""SimHash near-duplicates by covering locality-sensitive hashing.

Each bit position gets one of the non-zero vectors of ``radius + 1`` bits. For
every non-zero vector v there is a table whose mask keeps the positions with an
odd product with v. The vectors of at most ``radius`` differing positions always
leave a v orthogonal to all of them, so every pair within the radius is equal
under some mask and meets in that table: no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import blocks, doc_text, fresh, stage, staged_rows, utf8
from strata.llm.components import components

BITS = 64
#: Buckets with more different fingerprints are linked by shared neighbours, not inside one row.
SMALL_BUCKET = 256


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the lower-cased (A-Z) words' shingles; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.r_[0, ends[:-1]][:len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], 42) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    h = np.array(hashes, ">u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 65536):
        ones += np.unpackbits(h[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """All columns but the text, and ``fp`` (signed 64-bit); null and empty texts have 0."""
    others = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, text_col):
            fp = np.array([fingerprint(t, shingle) for t in utf8(b.column(text_col))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in others], pa.array(fp)], names=[*others, "fp"])

    from pyspark.sql.types import LongType, StructField, StructType
    return docs.mapInArrow(run, StructType([*[docs.schema[c] for c in others], StructField("fp", LongType())]))


def masks(radius: int) -> list[int]:
    """One mask per table, 2 ** (radius + 1) - 1 of them, as signed 64-bit numbers."""
    vectors = (1 << (radius + 1)) - 1
    out = []
    for v in range(1, vectors + 1):
        m = sum(1 << i for i in range(BITS) if ((i % vectors + 1) & v).bit_count() % 2)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def links(spark: SparkSession, distinct: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) between different fingerprints ``fp`` that connect exactly those
    that pairs within ``radius`` bits connect (a spanning part of the pairs)."""
    tables = stage(spark, distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks(radius))
    ])).alias("x")).select("x.t", "x.key", "fp"), "simhash-tables")
    # staged: beside an aggregate Spark cannot split a key that many fingerprints share
    sizes = stage(spark, tables.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-sizes")
    shared = stage(spark, tables.join(sizes, ["t", "key"]), "simhash-buckets")

    small = (shared.where(F.col("n") <= SMALL_BUCKET).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
             .select("fps").mapInArrow(_linker(radius), "a long, b long"))

    # Large buckets, whatever their size: two fingerprints within the radius have a
    # common neighbour z, at most the larger half of the radius from one and the
    # smaller half from the other. All that have z as a neighbour are hung on the
    # smallest of the closer ones, which lies within the radius of each.
    big = shared.where(F.col("n") > SMALL_BUCKET).select("fp").distinct()
    close, far = (big.select("fp", F.explode(F.transform(_flips(h), lambda f: F.col("fp").bitwiseXOR(f))).alias("z"))
                  for h in (radius // 2, radius - radius // 2))
    hub = close.groupBy("z").agg(F.min("fp").alias("a"))
    large = far.join(hub, "z").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    return small.unionByName(large)


def _flips(most: int) -> Column:
    """All 64-bit numbers with at most ``most`` bits set."""
    flips = {0}
    for _ in range(most):
        flips |= {f ^ (1 << i) for f in flips for i in range(BITS)}
    return F.array(*[F.lit(f - (1 << 64) if f >> 63 else f) for f in sorted(flips)])


def _linker(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for fps in batch.column(0).to_pylist():
                x = np.array(fps, np.int64)
                d = np.bitwise_count((x[:, None] ^ x[None, :]).view(np.uint64)) <= radius
                left = np.ones(len(x), bool)
                for i in range(len(x)):        # a spanning forest of the bucket, breadth first
                    if not left[i]:
                        continue
                    left[i], front = False, [i]
                    while front:
                        k = front.pop()
                        new = np.flatnonzero(d[k] & left)
                        left[new] = False
                        front.extend(new.tolist())
                        a.extend([fps[k]] * len(new))
                        b.extend(x[new].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` and ``component_id``, the smallest
    ``doc_id`` reachable over links of at most ``radius`` differing bits (its own included).

    Equal fingerprints are one class; links are between classes. Null, empty and
    blank texts have fingerprint 0 and link like any other. Null ids are kept and
    are never the smallest unless a component has no other. An empty table gives
    an empty table; extra columns are ignored.
    """
    prints = stage(spark, fingerprints(doc_text(docs, id_col, text_col), "text", shingle), "simhash-fp")
    labels = classes(spark, prints, "doc_id", radius)
    return prints.join(labels, "fp").select("doc_id", "fp", F.col("label").alias("component_id"))


def classes(spark: SparkSession, prints: DataFrame, id_col: str, radius: int) -> DataFrame:
    """``fp`` to ``label``: the smallest ``id_col`` of its component."""
    distinct = stage(spark, prints.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-classes")
    parts = components(spark, links(spark, distinct.select("fp"), radius))
    named = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = stage(spark, named.groupBy("root").agg(F.min("least").alias("label")), "simhash-least")
    return stage(spark, named.join(least, "root").select("fp", "label"), "simhash-labels")


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (then of the
    smallest row id), all columns unchanged.

    Null, empty and blank texts share fingerprint 0, so one of them stays (with
    what links to it); null ids come last; no rows give no rows.
    """
    rid = fresh(docs, "rid_")
    base = stage(spark, docs.withColumn(rid, F.monotonically_increasing_id()), "simhash-docs")
    order = F.struct(base[id_col].isNull().alias("n"), base[id_col].cast("long").alias("i"), base[rid].alias("r"))
    prints = stage(spark, fingerprints(base.select(order.alias("o"), base[text_col].cast("string").alias("text")), "text", shingle), "simhash-fp")
    chosen = classes(spark, prints, "o", radius).select(F.col("label.r").alias(rid)).distinct()
    return base.join(chosen, rid, "left_semi").drop(rid)
