"""Token counts through a cache of digests.

A text is normalised in ways that provably keep its number of tokens, and
digested; the tokenizer file and the library's version give a second digest.
Both together are the key of the cache, a Parquet table that only grows. Texts
whose key is not in the cache are encoded once each, however many documents
share them, and their counts are appended.

Only texts that miss are shuffled, after copies within a task have met; hits
move as digests alone.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import blocks, stage

#: Digests of misses that are broadcast to the scan of the texts at most (32 bytes each); more are joined by a shuffle.
BROADCAST_MISSES = 200_000
#: Longer texts are encoded in pieces cut at blanks.
PIECE_CHARS = 1 << 16
#: Words that a Python process remembers, and the longest of them.
MEMO_WORDS = 800_000
MEMO_CHARS = 64
#: Part of the key: a change of ``normalised`` needs another number.
NORMALISER = 1
MAX_FILE_BYTES = 64 << 20
_CACHE = "content binary, n_tokens long, tokenizer string"


def normalised(text: Column) -> Column:
    """The text with runs of ASCII white space as one blank, none at its ends, and A-Z lower-cased where that is safe.

    For tokenizers that lower-case and drop white space. Lower-casing is left to the
    tokenizer where composed characters might differ (any non-ASCII text) or a
    special token's spelling might appear (any text with ``<|``).
    """
    flat = F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0B]+", " "))
    plain = (F.octet_length(flat) == F.char_length(flat)) & ~flat.contains("<|")
    return F.when(plain, F.lower(flat)).otherwise(flat)


def tokenizer_digest(data: bytes) -> str:
    """Digest of the tokenizer's file, the library's version and the normaliser."""
    return hashlib.sha256(data + f"\n{tokenizers.__version__}\n{NORMALISER}".encode()).hexdigest()


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text cut at blanks into pieces of about ``size`` characters; a longer run without blanks stays whole."""
    at = 0
    while len(text) - at > size:
        cut = text.rfind(" ", at, at + size)
        if cut < 0:
            cut = text.find(" ", at + size)
            if cut < 0:
                break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


class Counter:
    """Counts tokens word by word, each word encoded once while it is remembered.

    No token of such a tokenizer reaches across a blank, no special token's spelling
    holds one and no character composes with one: a text's count is the sum of its words'.
    """

    def __init__(self, encoder: tokenizers.Tokenizer):
        self.encoder = encoder
        self.known: dict[str, int] = {"": 0}

    def count(self, text: str) -> int:
        return sum(self._piece(p) for p in pieces(text))

    def _piece(self, piece: str) -> int:
        words = piece.split(" ")
        new = [w for w in set(words) if w not in self.known]
        if new:
            if len(self.known) > MEMO_WORDS:
                self.known = {"": 0}
                new = list(set(words) - {""})
            self.known.update(zip(new, map(len, self.encoder.encode_batch_fast(new, add_special_tokens=False))))
        total = sum(map(self.known.__getitem__, words))
        for w in new:
            if len(w) > MEMO_CHARS:
                del self.known[w]
        return total


_LOADED: dict[str, Counter] = {}


def loaded(data: bytes, name: str) -> Counter:
    """The counter of this tokenizer file, without truncation and padding, made once a Python process."""
    if name not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        made = tokenizers.Tokenizer.from_str(data.decode())
        made.no_truncation()
        made.no_padding()
        _LOADED[name] = Counter(made)
    return _LOADED[name]


def cached(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Digests (``content``) that the cache holds for this tokenizer, with ``n_tokens``; none if there is no cache yet."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return spark.createDataFrame([], "content binary, n_tokens long")
    return spark.read.schema(_CACHE).parquet(path).where(F.col("tokenizer") == tokenizer).select("content", "n_tokens")


def token_counts(spark: SparkSession, docs: DataFrame, tokenizer_path: str, cache: str,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, content`` (digest of the normalised text), ``n_tokens``.

    ``cache`` is a folder that driver and executors share; it is made at the first
    use, read by later ones and only ever appended to, by a tokenizer's digest. A
    job that dies leaves no half-written rows in it, and runs at the same time may
    append the same digests with the same counts, which does no harm.

    Null and empty texts have no bytes and no tokens; null ids and repeated rows are
    kept; an empty table gives an empty table; other columns are ignored. Special
    tokens' spellings inside texts count as the library has them by default. The
    tokenizer must lower-case and drop white space (see ``normalised``); its file is
    read on the driver (above ``MAX_FILE_BYTES`` it is refused) and broadcast.
    """
    with open(tokenizer_path, "rb") as f:
        data = f.read(MAX_FILE_BYTES + 1)
    if len(data) > MAX_FILE_BYTES:
        raise ValueError(f"{tokenizer_path} is larger than {MAX_FILE_BYTES} bytes")
    name = tokenizer_digest(data)
    sent = spark.sparkContext.broadcast(data)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    digest = F.unhex(F.sha2("norm", 256)).alias("content")
    texts = docs.select(normalised(text).alias("norm")).select(digest, "norm")
    keys = stage(spark, docs.select(docs[id_col].cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), normalised(text).alias("norm"))
                 .select("doc_id", "n_bytes", digest), "token-keys")
    known = cached(spark, cache, name).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    asked = stage(spark, keys.select("content").distinct().join(known, "content", "left"), "token-asked")
    misses = asked.where(F.col("n_tokens").isNull()).select("content")
    n = misses.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(sent.value, name)
        for b in blocks(batches, "norm"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(counter.count, b.column(1).to_pylist()), pa.int64())], names=["content", "n_tokens"])

    if n:
        wanted = texts.join(F.broadcast(misses), "content", "left_semi") if n <= BROADCAST_MISSES else texts
        one_each = wanted.groupBy("content").agg(F.first("norm").alias("norm"))
        if n > BROADCAST_MISSES:
            one_each = one_each.join(misses, "content", "left_semi")
        new = stage(spark, one_each.select("content", "norm").mapInArrow(run, "content binary, n_tokens long"), "token-new")
        new.withColumn("tokenizer", F.lit(name)).write.mode("append").partitionBy("tokenizer").parquet(cache)
        found = stage(spark, asked.where(F.col("n_tokens").isNotNull()).unionByName(new), "token-found")
    else:
        found = asked
    return keys.join(found, "content").select("doc_id", "n_bytes", "content", "n_tokens")
