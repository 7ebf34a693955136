"""Byte-level BPE by monoid tree reduction.

A text is halved until a piece is at most ``LEAF`` characters; a leaf is
encoded directly. Two neighbours are joined by encoding again only a window
around their border. The window grows on each side until it reaches a place
where the splitting pattern starts a new match whatever stands around it (a
single space between two letters): everything outside is then the same in the
parts and in the whole, so its tokens stay. The join is associative and the
empty text is its unit, hence any tree over the pieces gives the ids of the
whole text. Decoding concatenates token bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import blocks

LEAF = 512

#: A match of the pattern always starts at the space between two letters.
_SYNC = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")


class Codec:
    """Encoder and decoder for one rank file and splitting pattern."""

    def __init__(self, ranks: bytes, pattern: str, leaf: int = LEAF):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) }
        self.leaf = leaf
        self.bytes_of = [b""] * (max(table.values(), default=-1) + 1)
        for token, rank in table.items():
            self.bytes_of[rank] = token
        self._leaf = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text; an empty text has none."""
        if len(text) <= self.leaf:
            return self._leaf(text)
        half = len(text) // 2
        left, right = text[:half], text[half:]
        return self.join(left, self.encode(left), right, self.encode(right))

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """Ids of ``left + right`` from the ids of both."""
        if not left or not right:
            return left_ids or right_ids
        a, b = _last_sync(left), _first_sync(right)
        tail, head = left[a:], right[:b]
        keep = len(left_ids) - len(self._part(tail))
        skip = len(self._part(head))
        return left_ids[:keep] + self._part(tail + head) + right_ids[skip:]

    def _part(self, text: str) -> list[int]:
        return self._leaf(text)

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        """Bytes of the ids, concatenated up a tree."""
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _last_sync(text: str) -> int:
    """The last place in ``text`` where a match starts in any context; 0 if there is none."""
    width = 64
    while True:
        start = max(0, len(text) - width)
        at = -1
        for m in _SYNC.finditer(text, start):
            at = m.start()
        if at >= 0 or start == 0:
            return max(at, 0)
        width *= 2


def _first_sync(text: str) -> int:
    """The first such place; the length if there is none."""
    m = _SYNC.search(text)
    return m.start() if m else len(text)


_CODECS: dict[str, Codec] = {}


def codec(ranks: bytes, pattern: str, leaf: int = LEAF) -> Codec:
    """The codec of these ranks, built once a Python process."""
    key = hashlib.sha256(ranks + pattern.encode() + b"%d" % leaf).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(ranks, pattern, leaf)
    return _CODECS[key]


#: Largest rank file that is sent to the executors.
MAX_RANK_BYTES = 64 << 20


def encode_decode(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str,
                  id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """One row per document: ``doc_id``, ``ids`` (binary, little-endian unsigned
    32-bit), ``n_tokens``, ``decoded`` (binary).

    Null and empty texts have no ids and decode to no bytes; a null id and
    repeated rows are kept as they are; an empty table gives an empty table;
    other columns are ignored. The rank file is read on the driver (a file above
    ``MAX_RANK_BYTES`` is refused) and broadcast.
    """
    with open(ranks_path, "rb") as f:
        ranks = f.read(MAX_RANK_BYTES + 1)
    if len(ranks) > MAX_RANK_BYTES:
        raise ValueError(f"{ranks_path} is larger than {MAX_RANK_BYTES} bytes")
    sent = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(sent.value, pattern, leaf)
        for b in blocks(batches):
            ids = [c.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([np.asarray(x, "<u4").tobytes() for x in ids], pa.binary()),
                pa.array([len(x) for x in ids], pa.int64()), pa.array([c.decode(x) for x in ids], pa.binary())],
                names=["doc_id", "ids", "n_tokens", "decoded"])

    return (docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, ids binary, n_tokens long, decoded binary"))
