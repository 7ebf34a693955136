"""Asking which hashes of a document block occur elsewhere.

Documents are dealt into chunks of a few MB. A chunk sends its different hashes,
sorted, to buckets of the hash range (one binary value for each bucket, with a
bit for those that the chunk has several times). A bucket answers one bit per
hash: does it occur more than once over all chunks? The chunk works out the same
sorted hashes again and reads the bits. A hash that a third of all rows have
reaches its bucket once for each chunk only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BLOCK_BYTES, doc_text, joined, staged_rows, text_bytes, utf8

ANSWER = "chunk long, kind int, bucket int, payload binary"
_ANSWER = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])


def chunked(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, name: str,
            chunk_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(rid, doc_id, text, chunk), written once, and its text bytes. Chunks hold about ``chunk_bytes`` (one document at least)."""
    base = staged_rows(spark, doc_text(docs, id_col, text_col), name)
    total = text_bytes(base)
    return base.withColumn("chunk", F.pmod(F.xxhash64("rid"), F.lit(max(1, -(-total // chunk_bytes))))), total


def load(table: pa.Table) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """A chunk in document order (id, null last, then row id): row ids, doc ids, all text bytes, where each text starts."""
    ids = table.column("doc_id")
    table = table.take(np.lexsort((np.asarray(table.column("rid")), np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()))))
    buf, off = joined(utf8(table.column("text")))
    return np.asarray(table.column("rid")), table.column("doc_id"), buf, off


def question(chunk: int, parts: tuple[np.ndarray, ...], again: np.ndarray, buckets: int, times: np.ndarray | None = None) -> pa.Table:
    """One row per bucket: count, the sorted hashes (one or two 64-bit parts) and the bits of those the chunk has again
    (with ``times``, how often it has each of those follows)."""
    cut = np.searchsorted(bucket_of(parts[0], buckets), np.arange(buckets + 1))
    full = np.flatnonzero(cut[1:] > cut[:-1])
    payload = [len(again[a:z]).to_bytes(8, "little") + b"".join(p[a:z].tobytes() for p in parts) + np.packbits(again[a:z]).tobytes()
               + (b"" if times is None else times[a:z][again[a:z]].astype("<u4").tobytes())
               for a, z in zip(cut[full], cut[full + 1])]
    return pa.table({"chunk": pa.array(np.full(len(full), chunk), pa.int64()), "kind": pa.array(np.full(len(full), len(parts)), pa.int32()),
                     "bucket": pa.array(full, pa.int32()), "payload": pa.array(payload, pa.binary())}, schema=_ANSWER)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _read(payload: bytes, parts: int) -> tuple[list[np.ndarray], np.ndarray]:
    n = int.from_bytes(payload[:8], "little")
    hashes = [np.frombuffer(payload, np.uint64, n, 8 + 8 * n * k) for k in range(parts)]
    return hashes, np.unpackbits(np.frombuffer(payload, np.uint8, offset=8 + 8 * n * parts), count=n).astype(bool)


def answer(table):
    """For one bucket: a bit for each hash asked, set if it occurs more than once over all."""
    table = table.select(["chunk", "kind", "bucket", "payload"])
    kind = table.column("kind")[0].as_py()
    read = [_read(p, kind) for p in table.column("payload").to_pylist()]
    parts = [np.concatenate([r[0][k] for r in read]) for k in range(kind)]
    again = np.concatenate([r[1] for r in read])
    by = np.argsort(parts[0], kind="stable") if kind == 1 else np.lexsort(parts[::-1])
    new = np.zeros(len(by), bool)
    for p in parts:
        s = p[by]
        new[1:] |= s[1:] != s[:-1]
    group = np.cumsum(new)
    many = np.bincount(group, weights=1 + again[by]) > 1
    out = np.empty(len(by), bool)
    out[by] = many[group]
    ends = np.cumsum([len(r[1]) for r in read])
    bits = [np.packbits(out[z - len(r[1]):z]).tobytes() for r, z in zip(read, ends)]
    return pa.table([table.column("chunk"), table.column("kind"), table.column("bucket"), pa.array(bits, pa.binary())], schema=_ANSWER)


def tally(table, bound: int):
    """``answer`` to questions with ``times`` (one part); a second row of bits is set for hashes that occur more than ``bound`` times."""
    payloads = table.column("payload").to_pylist()
    read = [_read(p, 1) for p in payloads]
    h = np.concatenate([r[0][0] for r in read])
    times = []
    for p, (_, again) in zip(payloads, read):
        n = np.ones(len(again), np.int64)
        n[again] = np.frombuffer(p, "<u4", int(again.sum()), 8 + 8 * len(again) + -(-len(again) // 8))
        times.append(n)
    _, group = np.unique(h, return_inverse=True)
    total = np.bincount(group, weights=np.concatenate(times))[group]
    ends = np.cumsum([len(n) for n in times])
    bits = [np.packbits(total[z - len(n):z] > 1).tobytes() + np.packbits(total[z - len(n):z] > bound).tobytes() for n, z in zip(times, ends)]
    return pa.table([table.column("chunk"), table.column("kind"), table.column("bucket"), pa.array(bits, pa.binary())], schema=_ANSWER)


def ask(questions: DataFrame, bound: int | None = None) -> DataFrame:
    return questions.groupBy("bucket").applyInArrow(answer if bound is None else lambda t: tally(t, bound), ANSWER)


def answered(answers: pa.Table, kind: int, parts: tuple[np.ndarray, ...], buckets: int, row: int = 0) -> np.ndarray:
    """The bits of a chunk's sorted hashes, from the rows that came back to it (``row`` 1: the second row of bits)."""
    out = np.zeros(len(parts[0]), bool)
    cut = np.searchsorted(bucket_of(parts[0], buckets), np.arange(buckets + 1))
    for k, b, p in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "payload"))):
        if k == kind:
            out[cut[b]:cut[b + 1]] = np.unpackbits(np.frombuffer(p, np.uint8, offset=row * -(-int(cut[b + 1] - cut[b]) // 8)), count=cut[b + 1] - cut[b])
    return out
