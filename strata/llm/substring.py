"""Substring dedup over words by difference-cover anchors.

A difference cover modulo v holds residues such that any two places i, j have an
offset d < v with i + d and j + d both in the cover. So two equal windows of L
words share an anchor, L - v + 1 words long and v - 1 words into the windows at
most, that begins at a cover position in both. Only these anchors are hashed and
compared over the corpus. Where an anchor occurs elsewhere, the match is
extended: the full windows that hold it are compared by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strata.llm import exchange as ex
from strata.llm.common import BLOCK_BYTES, Rolling, mix

WINDOW = 35
_BYTE = 0x9E3779B97F4A7C15
_WORD = (0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def cover(v: int) -> list[int]:
    """The smallest difference cover modulo ``v`` that holds 0 (and 1)."""
    if v < 3:
        return list(range(v))
    for size in range(2, v + 1):
        for rest in combinations(range(2, v), size - 2):
            c = (0, 1, *rest)
            if len({(a - b) % v for a in c for b in c}) == v:
                return list(c)
    raise AssertionError


def modulus(window: int) -> int:
    """The modulus for a window: the largest with a perfect cover that leaves anchors of 2/5 of it."""
    return max(v for v in (1, 3, 7, 13, 21, 31) if v == 1 or 5 * (window - v + 1) >= 2 * window)


class Words:
    """The words of a chunk: places, hashes, and which windows stay inside a document."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        blank = _BLANK[buf]
        edge = np.zeros(len(buf) + 1, bool)
        edge[off] = True
        word = ~blank
        prev = np.r_[True, blank[:-1]] if len(buf) else blank
        after = np.r_[blank[1:], True] if len(buf) else blank
        self.start = np.flatnonzero(word & (prev | edge[:-1]))
        self.end = np.flatnonzero(word & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, off)      # a document's first word; the next one's ends it
        n = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(n)), n)
        self.local = np.arange(len(self.start)) - self.first[self.doc] if len(n) else np.zeros(0, np.int64)
        self.left = self.first[self.doc + 1] - np.arange(len(self.start)) if len(n) else self.local
        self.rolls = [Rolling(h, base) for h, base in zip(self._hashes(buf[word]), _WORD)]

    def _hashes(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each word: sums of scrambled (byte, place in the word) pairs.

        A polynomial modulo 2**64 would not do: long words of two letters can be made
        (and occur) whose polynomials agree in every base.
        """
        if not len(self.start):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        length = self.end - self.start
        first = np.cumsum(length) - length
        place = (np.arange(len(chars)) - np.repeat(first, length)).astype(np.uint64)
        a = mix((place << np.uint64(8) | chars) + np.uint64(_BYTE))
        sums = []
        for x in (a, (a ^ (a >> np.uint64(31))) * np.uint64(_WORD[0])):
            sums.append(mix(np.add.reduceat(x, first) ^ mix(length.astype(np.uint64))))
        return sums[0], sums[1]

    def windows(self, at: np.ndarray, size: int, part: int) -> np.ndarray:
        return mix(self.rolls[part].of(at, at + size))


def _anchors(w: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cover places, the index of each one's hash among the chunk's different hashes, those, and whether they repeat."""
    v = modulus(window)
    inside = np.zeros(v, bool)
    inside[cover(v)] = True
    size = window - v + 1
    at = np.flatnonzero(inside[w.local % v] & (w.left >= size))
    h, index, n = np.unique(w.windows(at, size, 0), return_inverse=True, return_counts=True)
    return at, index, h, n > 1


def _candidates(w: Words, window: int, shared: np.ndarray) -> tuple:
    """Windows that hold a shared anchor, with the index of each one's hash pair, the pairs, and whether they repeat."""
    v = modulus(window)
    upto = np.r_[0, np.cumsum(shared)]
    at = np.flatnonzero(w.left >= window)
    at = at[upto[at + v] > upto[at]]
    a, b = w.windows(at, window, 0), w.windows(at, window, 1)
    by = np.lexsort((b, a))
    new = np.ones(len(by), bool)
    new[1:] = (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])
    index = np.empty(len(by), np.int64)
    index[by] = np.cumsum(new) - 1
    keep = by[new]
    return at, index, (a[keep], b[keep]), np.bincount(index, minlength=len(keep)) > 1


def _shared(w: Words, at: np.ndarray, index: np.ndarray, bits: np.ndarray) -> np.ndarray:
    out = np.zeros(len(w.start), bool)
    out[at] = bits[index]
    return out


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   chunk_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``rid, doc_id, n_words, n_removed, kept`` (the words left,
    joined by single spaces) and the merged word ranges removed, ``span_start, span_end``.

    A word goes if a window of ``window`` words that covers it starts anywhere else
    too, in this or another document; every copy counts, none is spared, and windows
    are judged on the input. Words end at ASCII white space and are compared
    byte by byte, through 64-bit hashes of words and 128-bit hashes of windows. Null
    and empty texts have no words; documents shorter than the window stay whole;
    equal rows are documents of their own (so their windows repeat); null ids are
    kept; no rows give no rows; other columns are ignored.
    """
    base, total = ex.chunked(spark, docs, id_col, text_col, "substring", chunk_bytes)
    # about 0.3 bytes of anchors for a byte of text: buckets of 8 MB
    buckets = max(32, -(-total * 3 // 10 // (8 << 20)))

    def anchors(key, table):
        _, _, buf, off = ex.load(table)
        _, _, h, again = _anchors(Words(buf, off), window)
        return ex.question(key[0].as_py(), (h,), again, buckets)

    def windows(key, table, answers):
        if not table.num_rows:
            return ex._ANSWER.empty_table()
        _, _, buf, off = ex.load(table)
        w = Words(buf, off)
        at, index, h, _ = _anchors(w, window)
        shared = _shared(w, at, index, ex.answered(answers, 1, (h,), buckets))
        _, _, pairs, again = _candidates(w, window, shared)
        return ex.question(key[0].as_py(), pairs, again, buckets)

    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept", pa.binary()), ("span_start", pa.list_(pa.int32())), ("span_end", pa.list_(pa.int32()))])

    def cut(key, table, answers):
        if not table.num_rows:
            return schema.empty_table()
        rids, ids, buf, off = ex.load(table)
        w = Words(buf, off)
        at, index, h, _ = _anchors(w, window)
        shared = _shared(w, at, index, ex.answered(answers, 1, (h,), buckets))
        at, index, pairs, _ = _candidates(w, window, shared)
        at = at[ex.answered(answers, 2, pairs, buckets)[index]]
        edge = np.zeros(len(w.start) + 1, np.int32)
        edge[at] += 1
        np.add.at(edge, at + window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        raw = buf.tobytes()
        n, removed, kept, starts, ends = [], [], [], [], []
        for a, z in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
            g = gone[a:z]
            stay = np.flatnonzero(~g) + a
            step = np.diff(np.r_[0, g.astype(np.int8), 0])
            n.append(z - a), removed.append(z - a - len(stay))
            kept.append(b" ".join([raw[s:e] for s, e in zip(w.start[stay].tolist(), w.end[stay].tolist())]))
            starts.append(np.flatnonzero(step == 1)), ends.append(np.flatnonzero(step == -1))
        return pa.table([pa.array(rids), ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()),
                         pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))], schema=schema)

    hashes = ex.ask(base.groupBy("chunk").applyInArrow(anchors, ex.ANSWER))
    full = ex.ask(base.groupBy("chunk").cogroup(hashes.groupBy("chunk")).applyInArrow(windows, ex.ANSWER))
    return base.groupBy("chunk").cogroup(hashes.unionByName(full).groupBy("chunk")).applyInArrow(
        cut, "rid long, doc_id long, n_words long, n_removed long, kept binary, span_start array<int>, span_end array<int>")


def digest(kept: bytes) -> str:
    return hashlib.sha256(kept).hexdigest()
