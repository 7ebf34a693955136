"""Exact top-k by tiled matrix products.

Vectors are packed into shards and the queries into blocks, one row each, with
a bounded number of vectors. Every (shard, block) tile is one matrix product;
a partial selection keeps the best k of each query in the tile. The tiles'
lists meet in a tree: within a task as they come, then before the shuffle
(Spark's grouped limit), then after it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.llm.common import stage

SHARD_ROWS = 4096
BLOCK_ROWS = 1024
#: Products of doubles are exact below this; larger tiles are summed as Python integers.
_EXACT = float(1 << 53)


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``vec_id`` and ``q`` = floor(scale * x) per component, as doubles (whole
    numbers). Vectors that are null or hold a null or non-finite component go."""
    v = F.transform(df[vec_col], lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    finite = ~F.exists(df[vec_col], lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return df.where(df[vec_col].isNotNull() & finite).select(df[id_col].cast("long").alias("vec_id"), v.alias("q"))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows (rid, vec_id, q) packed into binary matrices of at most ``size`` vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                b = batch.slice(at, size)
                ids = b.column(1)
                q = b.column(2)
                dims = np.asarray(pc.list_value_length(q)).astype(np.int32)
                width = int(dims.max(initial=0))
                m = np.zeros((b.num_rows, width))
                m[np.arange(width) < dims[:, None]] = np.asarray(q.flatten(), float)
                yield pa.RecordBatch.from_arrays([
                    pa.array([np.asarray(b.column(0)).astype("<i8").tobytes()], pa.binary()),
                    pa.array([np.asarray(ids.fill_null(0)).astype("<i8").tobytes()], pa.binary()),
                    pa.array([np.asarray(ids.is_null()).astype(np.uint8).tobytes()], pa.binary()),
                    pa.array([m.astype("<f8").tobytes()], pa.binary()), pa.array([width], pa.int32())],
                    names=["rids", "ids", "nulls", "m", "width"])

    return rows.mapInArrow(run, "rids binary, ids binary, nulls binary, m binary, width int")


def _matrix(row: dict, n: int) -> np.ndarray:
    return np.frombuffer(row["m"], "<f8").reshape(n, row["width"])


def _products(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    w = max(q.shape[1], m.shape[1], 1)
    q, m = (np.pad(x, ((0, 0), (0, w - x.shape[1]))) for x in (q, m))
    bound = np.abs(q).max(initial=0) * np.abs(m).max(initial=0) * w
    if bound < _EXACT:
        return (q @ m.T).astype(np.int64)
    whole = lambda x: np.array([[int(v) for v in r] for r in x], object)
    return whole(q) @ whole(m).T


def _best(score: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best of one list: highest score, then smallest id (null last)."""
    if len(score) > k:
        cut = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= cut)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], nulls[at], -score[at]))][:k]


def top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int,
          shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` best vectors of every query by inner product, a query's own row apart.

    ``vectors`` and ``queries`` hold ``rid`` (a row's identity), ``vec_id`` and ``q``
    (doubles that are whole numbers). Returns ``query_rid, query_id, rank, vec_id,
    score``; ties go to the smaller ``vec_id`` (null ids last, then the smaller
    row id). Missing components of shorter vectors count as zero; repeated rows
    are separate candidates and separate queries. No vectors or no queries: no rows.
    """
    tiles = _packed(vectors, shard_rows).crossJoin(
        _packed(queries, block_rows).select(*[F.col(c).alias(f"q_{c}") for c in ("rids", "ids", "nulls", "m", "width")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, list] = {}
        for batch in batches:
            for row in (r for at in range(batch.num_rows) for r in batch.slice(at, 1).to_pylist()):
                rids, ids, nulls = (np.frombuffer(row[c], t) for c, t in (("rids", "<i8"), ("ids", "<i8"), ("nulls", np.uint8)))
                q_rids, q_ids, q_nulls = (np.frombuffer(row[c], t) for c, t in (("q_rids", "<i8"), ("q_ids", "<i8"), ("q_nulls", np.uint8)))
                q = _matrix({"m": row["q_m"], "width": row["q_width"]}, len(q_rids))
                score = _products(q, _matrix(row, len(rids)))
                for i in range(len(q_rids)):
                    others = np.flatnonzero(rids != q_rids[i])
                    s = score[i][others]
                    at = others[_best(s, ids[others], nulls[others], k)]
                    new = [(-int(score[i][j]), int(nulls[j]), int(ids[j]), int(rids[j])) for j in at]
                    key = (int(q_rids[i]), None if q_nulls[i] else int(q_ids[i]))
                    best[key] = sorted(best.get(key, []) + new)[:k]
            if len(best) > 200_000:
                yield from _rows(best)
                best = {}
        yield from _rows(best)

    found = tiles.mapInArrow(run, "query_rid long, query_id long, vec_id long, rid long, score long")
    w = Window.partitionBy("query_rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_rid", "query_id", "rank", "vec_id", "score"))


def _rows(best: dict) -> Iterator[pa.RecordBatch]:
    flat = [(a, b, None if null else i, rid, -s) for (a, b), top in best.items() for s, null, i, rid in top]
    for at in range(0, len(flat), 50_000):
        cols = list(zip(*flat[at:at + 50_000]))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                         names=["query_rid", "query_id", "vec_id", "rid", "score"])


def search(spark: SparkSession, embeddings: DataFrame, k: int = 5, every: int = 50, scale: int = 256,
           id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows whose id is divisible by ``every`` against all rows of the table."""
    v = stage(spark, quantised(embeddings, id_col, vec_col, scale).withColumn("rid", F.monotonically_increasing_id())
              .select("rid", "vec_id", "q"), "vectors")
    return top_k(spark, v, v.where(F.col("vec_id") % every == 0), k)
