"""Benchmark decontamination with an FM-index per training shard.

A shard is a block of whole documents held by one task. Its words become the
numbers of the benchmark's words; any other word separates, and stretches of
numbered words too short for any window are left out (no window can occur
there). Over the rest a suffix array is built by prefix doubling (each
separator smaller than all words and different from every other one), then the
last column of the sorted rotations with wavelet ranks. Every window is
searched backwards; the rows found walk back to a sampled suffix position,
which gives document and word. Overlapping occurrences merge into spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BLOCK_BYTES, blocks, fresh, stage, utf8

#: Word bytes after lower-casing: 0-9, a-z and all bytes of non-ASCII characters.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else 32
              for b in range(256))
#: Bytes of benchmark text that are sent to the executors at a time.
ITEM_BLOCK_BYTES = 16 << 20
SAMPLE = 16


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Windows:
    """The distinct windows of a block of items, as word numbers from 1 (0 pads)."""

    number: dict[bytes, int]
    rows: np.ndarray            # (windows, longest), right-aligned
    length: np.ndarray
    items: list[list[str]]      # item ids per window


def windows_of(items: list[tuple[str, bytes]], size: int) -> Windows:
    number: dict[bytes, int] = {}
    found: dict[tuple, set] = {}
    for item, text in items:
        seq = [number.setdefault(w, len(number) + 1) for w in words(text)]
        for at in range(max(1, len(seq) - size + 1) if seq else 0):
            found.setdefault(tuple(seq[at:at + size]), set()).add(item)
    rows = np.zeros((len(found), size), np.int64)
    for i, w in enumerate(found):
        rows[i, size - len(w):] = w
    return Windows(number, rows, np.array([len(w) for w in found], np.int64), [sorted(x) for x in found.values()])


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Positions in suffix order; every 0 is a separator of its own, earlier ones smaller."""
    n = len(seq)
    zero = seq == 0
    rank = np.where(zero, np.cumsum(zero) - 1, seq + int(zero.sum())).astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    sorted_rank = rank[order]
    first = np.r_[True, sorted_rank[1:] != sorted_rank[:-1]]
    rank[order] = np.flatnonzero(first)[np.cumsum(first) - 1]
    while True:
        # only suffixes that still share their rank are sorted again
        tied = ~(first & np.r_[first[1:], True])
        if not tied.any():
            return order
        slots = np.flatnonzero(tied)
        at = order[slots]
        # a tie never reaches past its separator, so at + step stays inside
        second = rank[np.minimum(at + step, n - 1)]
        by = np.lexsort((second, rank[at]))
        at, second = at[by], second[by]
        group = rank[at]
        order[slots] = at
        new = np.r_[True, (group[1:] != group[:-1]) | (second[1:] != second[:-1])]
        first[slots] = new
        rank[at] = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
        step *= 2


class Wavelet:
    """Wavelet matrix over a sequence of numbers: symbol at a place, and its count before a place."""

    def __init__(self, seq: np.ndarray, top: int):
        self.levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            b = (seq >> bit) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(b, out=ones[1:])
            zeros = int(len(seq) - ones[-1])
            self.levels.append((bit, ones, zeros))
            seq = np.concatenate((seq[b == 0], seq[b == 1]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start = np.zeros_like(place)
        for bit, ones, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            start = np.where(one, zeros + ones[start], start - ones[start])
            place = np.where(one, zeros + ones[place], place - ones[place])
        return place - start

    def at(self, place: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(place)
        for bit, ones, zeros in self.levels:
            b = ones[place + 1] - ones[place]
            symbol |= b.astype(symbol.dtype) << bit
            place = np.where(b == 1, zeros + ones[place], place - ones[place])
        return symbol


class FMIndex:
    """FM-index of a number sequence in which 0 separates; it must end in 0."""

    def __init__(self, seq: np.ndarray, top: int, sample: int = SAMPLE):
        order = suffix_array(seq)
        n = len(seq)
        last = seq[order - 1]                      # order == 0: the final separator
        self.wavelet = Wavelet(last, top)
        self.before = np.zeros(top + 2, np.int64)  # symbols smaller than c
        np.cumsum(np.bincount(seq, minlength=top + 1), out=self.before[1:])
        # sampled: every SAMPLE-th position, and each that follows a separator (a walk back ends there)
        keep = (order % sample == 0) | (last == 0)
        self.kept = np.zeros(n + 1, np.int64)
        np.cumsum(keep, out=self.kept[1:])
        self.position = order[keep]

    def find(self, rows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all windows at once: the interval of each."""
        lo = np.zeros(len(rows), np.int64)
        hi = np.full(len(rows), self.kept.size - 1, np.int64)
        live = np.arange(len(rows))
        for k in range(rows.shape[1]):
            live = live[(length[live] > k) & (lo[live] < hi[live])]
            c = rows[live, rows.shape[1] - 1 - k]
            lo[live] = self.before[c] + self.wavelet.rank(c, lo[live])
            hi[live] = self.before[c] + self.wavelet.rank(c, hi[live])
        return lo, hi

    def locate(self, place: np.ndarray) -> np.ndarray:
        """Text positions of suffix-order places."""
        out = np.zeros(len(place), np.int64)
        todo, walked, place = np.arange(len(place)), 0, place.copy()
        while len(todo):
            sampled = self.kept[place + 1] > self.kept[place]
            out[todo[sampled]] = self.position[self.kept[place[sampled]]] + walked
            todo, place = todo[~sampled], place[~sampled]
            if len(todo):
                c = self.wavelet.at(place)
                place = self.before[c] + self.wavelet.rank(c, place)
            walked += 1
        return out


def search_shard(docs: list[list[bytes]], w: Windows, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All occurrences in a shard: document, first word, window."""
    none = (np.zeros(0, np.int64),) * 3
    if not len(w.rows):
        return none
    get = w.number.get
    seq = np.fromiter((x for d in docs for x in (*[get(t, 0) for t in d], 0)), np.int64, sum(len(d) + 1 for d in docs))
    # stretches of benchmark words that a window fits into
    cuts = np.flatnonzero(seq == 0)
    starts = np.r_[0, cuts[:-1] + 1]
    fits = cuts - starts >= int(w.length.min())
    if not fits.any():
        return none
    size = (cuts - starts + 1)[fits]
    new = np.r_[0, np.cumsum(size)]
    origin = np.repeat(starts[fits] - new[:-1], size)   # add to a place in the kept sequence
    kept = seq[np.arange(new[-1]) + origin]
    index = FMIndex(kept, len(w.number), sample)
    lo, hi = index.find(w.rows, w.length)
    count = np.maximum(hi - lo, 0)
    window = np.repeat(np.arange(len(count)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    at = index.locate(place)
    at = at + origin[at]
    begin = np.cumsum([0] + [len(d) + 1 for d in docs])
    doc = np.searchsorted(begin, at, "right") - 1
    return doc, at - begin[doc], window


def merged(n: int, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered word ranges of one document of ``n`` words."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    on = np.r_[0, (np.cumsum(edge) > 0).astype(np.int8)]
    step = np.diff(on)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _item_blocks(spark: SparkSession, benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[list]:
    """The items with words, in blocks of about ``limit`` bytes; one block is on the driver at a time."""
    items = benchmark.where(F.col(text_col).isNotNull()).select(
        benchmark[item_col].cast("string").alias("item"), benchmark[text_col].cast("string").alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-int(total) // limit))
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        yield n, [(r["item"] if r["item"] is not None else "", r["text"].encode()) for r in part.toLocalIterator()]


def find_spans(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = 10,
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               block_bytes: int = BLOCK_BYTES, item_bytes: int = ITEM_BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``span_start``, ``span_end`` (merged word
    ranges that lie in occurrences of a window) and ``items`` (sorted ids of items
    with an occurring window) added as ``NAMES``, with more underscores where ``docs``
    has such a column in any case (``added``).

    A window is ``size`` consecutive words of an item; a shorter item with any
    word is one window. Null and empty texts have no words. A null item id counts
    as "". Repeated rows are searched each; an empty benchmark gives no spans.
    The benchmark goes out in blocks of ``item_bytes``, one pass over the documents
    for each block, so its size is not limited.
    """
    names = added(docs)
    parts: list[DataFrame] = []
    base, rid = docs, fresh(docs, "rid_")
    for n, items in _item_blocks(spark, benchmark, item_col, item_text_col, item_bytes):
        if n > 1 and not parts:
            base = stage(spark, docs.withColumn(rid, F.monotonically_increasing_id()), "decontaminate")
        parts.append(_pass(spark, base, windows_of(items, size), names, text_col, block_bytes))
    if len(parts) == 1:
        return parts[0]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    every = union.select(F.col(rid).alias("rid"), *[F.col(f"`{c}`").alias(k) for c, k in zip(names, NAMES)]).groupBy("rid").agg(
        F.first("n_words_").alias("n_words_"), F.flatten(F.collect_list(F.arrays_zip("span_start_", "span_end_"))).alias("s"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items_")))).alias("items_"))
    # merge the blocks' ranges: sort, then extend or open
    acc = F.aggregate(F.array_sort("s"), F.expr("cast(array() as array<struct<span_start_:int,span_end_:int>>)"), lambda a, x: F.when(
        (F.size(a) > 0) & (F.get(a, F.size(a) - 1)["span_end_"] >= x["span_start_"]),
        F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(
            F.get(a, F.size(a) - 1)["span_start_"].alias("span_start_"),
            F.greatest(F.get(a, F.size(a) - 1)["span_end_"], x["span_end_"]).alias("span_end_")))))
        .otherwise(F.concat(a, F.array(x))))
    every = every.withColumn("s", acc).select(F.col("rid").alias(rid), *[F.col(c).alias(k) for c, k in zip(
        ("n_words_", "s.span_start_", "s.span_end_", "items_"), names)])
    return base.join(every, rid).drop(rid)


#: Columns that ``find_spans`` adds.
NAMES = ("n_words_", "span_start_", "span_end_", "items_")


def added(docs: DataFrame) -> list[str]:
    """The names of the columns that ``find_spans`` adds to ``docs``."""
    return [fresh(docs, c) for c in NAMES]


def _pass(spark: SparkSession, docs: DataFrame, w: Windows, names: list[str], text_col: str, block_bytes: int) -> DataFrame:
    sent = spark.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        win: Windows = sent.value
        for b in blocks(batches, text_col, block_bytes):
            lists = [words(t) for t in utf8(b.column(text_col))]
            doc, at, window = search_shard(lists, win)
            by = np.argsort(doc, kind="stable")
            doc, at, window = doc[by], at[by], window[by]
            edges = np.searchsorted(doc, np.arange(len(lists) + 1))
            starts, ends, items = [], [], []
            for i, d in enumerate(lists):
                a, z = edges[i], edges[i + 1]
                if a == z:
                    starts.append([]), ends.append([]), items.append([])
                    continue
                s, e = merged(len(d), at[a:z], win.length[window[a:z]])
                starts.append(s.tolist()), ends.append(e.tolist())
                items.append(sorted({x for k in np.unique(window[a:z]) for x in win.items[k]}))
            cols = [pa.array([len(d) for d in lists], pa.int64()), pa.array(starts, pa.list_(pa.int32())),
                    pa.array(ends, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *names])

    from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
    types = [LongType(), ArrayType(IntegerType()), ArrayType(IntegerType()), ArrayType(StringType())]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *map(StructField, names, types)]))


def cut_spans(text: bytes, starts: list[int], ends: list[int]) -> bytes:
    """``text`` without the words of the ranges (from a range's first to its last byte)."""
    folded = np.frombuffer(text.translate(_FOLD), np.uint8) != 32
    step = np.diff(np.r_[0, folded.astype(np.int8), 0])
    first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    out, at = [], 0
    for s, e in zip(starts, ends):
        out.append(text[at:first[s]])
        at = last[e - 1]
    return b"".join([*out, text[at:]])


def remove_spans(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = 10, text_col: str = "text",
                 **options) -> DataFrame:
    """``docs`` with every merged span cut out of the text; other rows and columns stay as they are.

    Null and empty texts stay, repeated rows are cut alike, a text whose words all
    go keeps what stands before the first and after the last; no rows give no rows.
    """
    found = find_spans(spark, docs, benchmark, size, text_col, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.schema.get_field_index(text_col)
            texts = b.column(i).to_pylist()
            for k, (s, e) in enumerate(zip(b.column(b.num_columns - 3).to_pylist(), b.column(b.num_columns - 2).to_pylist())):
                if s:
                    texts[k] = cut_spans(texts[k].encode(), s, e).decode()
            cols = list(b.columns[:-len(NAMES)])
            cols[i] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-len(NAMES)])

    return found.mapInArrow(run, docs.schema)
