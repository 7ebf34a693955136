"""Ranked lexical search by an Aho-Corasick scan of the documents.

The distinct terms of the items become one automaton; every pattern is guarded
by a boundary on both sides, so a match is a whole term. Documents are scanned
as they are, no index of them is built: a first scan gathers document
frequencies and lengths, a second one scores. What the automaton finds is a term
number; the term's list of items turns it into scores, and each task keeps the
best of every item.

Items go in blocks of bounded size. A block is collected, broadcast and scanned for by itself.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import blocks, stage, utf8

#: Largest block of items that is broadcast, in bytes of text.
ITEM_BYTES = 8 << 20
#: Scores (documents times items) computed at once.
_CELLS = 1 << 20
_TERM_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
#: A-Z lower-cased, every other byte that is in no term a blank.
_TABLE = bytes(c if c in _TERM_BYTES else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def guarded(text: bytes) -> bytes:
    """The text's terms between boundaries (blanks)."""
    return b" " + text.translate(_TABLE) + b" "


def n_terms(text: bytes) -> int:
    blank = np.frombuffer(text, np.uint8) == 32
    return int(np.count_nonzero(blank[:-1] & ~blank[1:]))


_MACHINES: dict[str, ahocorasick.Automaton] = {}


def machine(terms: list[str], name: str) -> ahocorasick.Automaton:
    """The automaton of these terms, built once a Python process (the last one stays)."""
    if name not in _MACHINES:
        _MACHINES.clear()
        made = ahocorasick.Automaton()
        for i, t in enumerate(terms):
            made.add_word(f" {t} ", i)
        made.make_automaton()
        _MACHINES[name] = made
    return _MACHINES[name]


def count_terms(found: ahocorasick.Automaton, text: bytes) -> Counter:
    """How often each term of the automaton stands in a guarded text."""
    return Counter(map(itemgetter(1), found.iter(text.decode()))) if len(found) else Counter()


def _frequencies(sent: Broadcast):
    """Rows (term, n): documents that hold each term; -1: documents with a term; -2: their terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, terms = sent.value
        automaton = machine(terms, name)
        df: Counter = Counter()
        for batch in blocks(batches):
            for text in map(guarded, utf8(batch.column("text"))):
                n = n_terms(text)
                df[-1] += n > 0
                df[-2] += n
                df.update(count_terms(automaton, text).keys())
        yield pa.RecordBatch.from_arrays([pa.array(list(df.keys()), pa.int64()), pa.array(list(df.values()), pa.int64())], names=["term", "n"])
    return run


class _Best:
    """The ``k`` best documents of each item: highest score, then smallest id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.top: list[list[tuple]] = [[] for _ in range(items)]

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        if len(ids) >= self.k:  # these documents alone already reach this score k times
            self.least = np.maximum(self.least, np.partition(scores, len(ids) - self.k, axis=0)[len(ids) - self.k])
        for d, i in zip(*np.nonzero(scores >= self.least)):
            top = self.top[i]
            top.append((-int(scores[d, i]), ids[d] is None, ids[d] or 0))
            if len(top) >= 8 * self.k:
                self._cut(i)

    def _cut(self, i: int) -> None:
        top = self.top[i] = sorted(self.top[i])[:self.k]
        if len(top) == self.k:
            self.least[i] = max(self.least[i], -top[-1][0])

    def rows(self) -> Iterator[tuple]:
        for i in range(len(self.top)):
            self._cut(i)
            for score, null, doc in self.top[i]:
                yield i, None if null else doc, -score


def _scores(sent: Broadcast, weights: Broadcast, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, terms = sent.value
        weight, n_docs, n_all, starts, items, times, rids = weights.value
        n_items = len(rids)
        automaton = machine(terms, name)
        best = _Best(n_items, k)
        rows = max(1, _CELLS // max(n_items, 1))
        scores = np.zeros((rows, n_items), np.int64)
        ids: list[int | None] = []

        def flush() -> None:
            best.add(scores[:len(ids)], ids)
            scores[:len(ids)] = 0
            ids.clear()

        for batch in blocks(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), map(guarded, utf8(batch.column("text")))):
                tf = count_terms(automaton, text)
                if not tf:
                    continue
                norm = 100 - 75 + 75 * n_terms(text) * n_docs // n_all
                term = np.fromiter(tf.keys(), np.int64, len(tf))
                often = np.fromiter(tf.values(), np.int64, len(tf))
                gain = weight[term] * (1_000_000_000 * often // (1000 * often + 8 * norm))
                # each term's items lie between starts[term] and starts[term + 1]
                size = starts[term + 1] - starts[term]
                at = np.repeat(starts[term] - np.cumsum(size) + size, size) + np.arange(size.sum())
                np.add.at(scores[len(ids)], items[at], np.repeat(gain, size) * times[at])
                ids.append(doc)
                if len(ids) == rows:
                    flush()
        flush()
        out = [(int(rids[i]), doc, score) for i, doc, score in best.rows()]
        for at in range(0, len(out), 50_000):
            cols = list(zip(*out[at:at + 50_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["rid", "doc_id", "score"])
    return run


def _item_blocks(spark: SparkSession, items: DataFrame, id_col: str, text_col: str, limit: int) -> tuple[DataFrame, int]:
    """Items (row id, id, text) dealt into blocks, none with more than ``limit`` bytes unless one item alone has them."""
    rows = stage(spark, items.select(items[id_col].alias("item_id"), F.coalesce(items[text_col].cast("string"), F.lit("")).alias("text"))
                 .withColumn("rid", F.monotonically_increasing_id()), "items")
    total, count = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    n = 1 + int(total or 0) // limit
    while True:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(n)))
        sizes = dealt.groupBy("block").agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n"))
        if not count or n > 64 * count or not sizes.where((F.col("b") > limit) & (F.col("n") > 1)).count():
            return dealt, n
        n *= 2


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 10, doc_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``k`` documents of highest score for each item: ``item_id, rank, doc_id, score``.

    Terms are runs of digits, letters A-Z (lower-cased) and non-ASCII characters. A
    term counts with its inverse document frequency and a saturated term frequency
    normed by the document's length (whole-number arithmetic but for the logarithm).

    Null and empty texts have no terms: such documents are found by no item, such
    items find nothing. Only scores above 0 are listed. Equal scores go by ascending
    document id, null ids last. Repeated documents are candidates of their own,
    repeated items queries of their own (both lists under the same id). Empty tables
    give no rows; other columns are ignored. Ids of documents are read as long.
    """
    texts = docs.select(docs[doc_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    dealt, n_blocks = _item_blocks(spark, items, item_col, item_text_col, item_bytes)
    found = [_block(spark, texts, dealt.where(F.col("block") == b), k) for b in range(n_blocks)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    best = Window.partitionBy("rid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = dealt.select(F.col("rid").alias("of"), "item_id")
    return ranked.join(names, F.col("rid") == F.col("of")).select("item_id", "rank", "doc_id", "score")


def _block(spark: SparkSession, texts: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Rows (rid, doc_id, score): every task's best documents for each item of one block."""
    rows = items.select("rid", "text").collect()  # one block, bounded by ITEM_BYTES
    counts = [Counter(guarded(r.text.encode()).decode().split(" ")) for r in rows]
    terms = sorted({t for c in counts for t in c if t})
    number = {t: i for i, t in enumerate(terms)}
    use = sorted((number[t], i, n) for i, c in enumerate(counts) for t, n in c.items() if t)
    sent = spark.sparkContext.broadcast((uuid.uuid4().hex, terms))
    df = {r.term: r.n for r in texts.select("text").mapInArrow(_frequencies(sent), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n_docs, n_all = df.get(-1, 0), df.get(-2, 0)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(terms))], np.int64)
    owner, item, times = (np.array(x, np.int64) for x in (zip(*use) if use else ((), (), ())))
    starts = np.searchsorted(owner, np.arange(len(terms) + 1))
    rids = np.array([r.rid for r in rows], np.int64)
    weights = spark.sparkContext.broadcast((weight, n_docs, n_all, starts, item, times, rids))
    return texts.mapInArrow(_scores(sent, weights, k), "rid long, doc_id long, score long")
