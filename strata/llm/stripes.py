"""Source divergence audit by in-mapper stripes.

Each task folds whole documents into one hash stripe a term, (document
frequency, occurrences by source), and spills its stripes as rows whenever it
holds ``SPILL_ENTRIES``. A shuffle by term brings a term's stripes together in
order, and they merge as they stream by. The merged stripes that enough
documents share go in buckets of bounded size, each beside the list of its
language's sources, and emit the divergences: per term directly, per pair of
sources as sums over the bucket's terms.

A pair sums over all kept terms, but only terms that both sources use are
visited pair by pair. A source that lacks a term gives it the same share as any
other term it lacks, so the rest follows from each source's own shares.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import blocks, stage, utf8

_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
#: Stripes and their entries that a task holds before it spills them.
SPILL_ENTRIES = 600_000
#: Entries of merged stripes in one bucket, on average over all languages at worst.
BUCKET_ENTRIES = 200_000
#: Sources whose divergences from all others one bucket computes at a time.
SOURCE_BLOCK = 2048
#: Cells of one numpy step.
_CELLS = 1 << 20
UNIT = 1_000_000_000

_STRIPE = "lang string, term string, df long, sources array<string>, counts array<long>"
_ARROW = pa.schema([("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()),
                    ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


def _spilled(stripes: dict[str, dict[bytes, list]]) -> Iterator[pa.RecordBatch]:
    for lang, terms in stripes.items():
        items = list(terms.items())
        for at in range(0, len(items), 50_000):
            part = items[at:at + 50_000]
            offsets = pa.array(np.cumsum([0] + [len(c) for _, (_, c) in part]), pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(part), pa.string()), pa.array([t for t, _ in part], pa.binary()).cast(pa.string()),
                pa.array([df for _, (df, _) in part], pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array([s for _, (_, c) in part for s in c], pa.string())),
                pa.ListArray.from_arrays(offsets, pa.array([n for _, (_, c) in part for n in c.values()], pa.int64()))], schema=_ARROW)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stripes: dict[str, dict[bytes, list]] = {}
    held = 0
    for batch in blocks(batches):
        for text, lang, source in zip(utf8(batch.column("text")), batch.column("lang").to_pylist(), batch.column("source").to_pylist()):
            mine = stripes.setdefault(lang, {})
            for term, n in Counter(_TERM.findall(text.lower())).items():
                stripe = mine.get(term)
                if stripe is None:
                    mine[term] = [1, {source: n}]
                    held += 2
                    continue
                stripe[0] += 1
                counts = stripe[1]
                if source in counts:
                    counts[source] += n
                else:
                    counts[source] = n
                    held += 1
            if held > SPILL_ENTRIES:
                yield from _spilled(stripes)
                stripes, held = {}, 0
    yield from _spilled(stripes)


def _starts(batch: pa.RecordBatch) -> np.ndarray:
    """The row where each run of one (lang, term) begins."""
    n = batch.num_rows
    differs = np.zeros(n, bool)
    differs[0] = True
    for i in (0, 1):
        col = batch.column(i)
        differs[1:] |= np.asarray(pc.not_equal(col.slice(1), col.slice(0, n - 1)))
    return np.flatnonzero(differs)


def _merged(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
    """One stripe for each run."""
    runs = len(starts)
    run = np.repeat(np.arange(runs), np.diff(np.append(starts, batch.num_rows)))
    source = batch.column(3).flatten().dictionary_encode()
    code = np.repeat(run, np.asarray(pc.list_value_length(batch.column(3)))) * len(source.dictionary) + np.asarray(source.indices)
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.diff(code, prepend=-1))
    counts = np.add.reduceat(np.asarray(batch.column(4).flatten())[order], first)
    owner, which = np.divmod(code[first], len(source.dictionary))
    offsets = pa.array(np.searchsorted(owner, np.arange(runs + 1)), pa.int32())
    at = pa.array(starts)
    return pa.RecordBatch.from_arrays([
        batch.column(0).take(at), batch.column(1).take(at), pa.array(np.add.reduceat(np.asarray(batch.column(2)), starts)),
        pa.ListArray.from_arrays(offsets, source.dictionary.take(pa.array(which))),
        pa.ListArray.from_arrays(offsets, pa.array(counts))], schema=_ARROW)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge stripes that come in order of (lang, term); the last term waits for the next batch."""
    rest: pa.RecordBatch | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        # Arrow batches of string columns may come with other offset widths
        batch = batch.cast(_ARROW)
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        starts = _starts(batch)
        if len(starts) > 1:
            yield _merged(batch.slice(0, starts[-1]), starts[:-1])
        rest = batch.slice(starts[-1])
        if rest.num_rows > 1:
            rest = _merged(rest, np.zeros(1, np.int64))
    if rest is not None:
        yield rest


def stripes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Merged stripes of ``docs`` (text, lang, source without nulls): lang, term, df, sources, counts; one row a term."""
    parts = docs.select("text", "lang", "source").mapInArrow(_fold, _STRIPE)
    return parts.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(_merge, _STRIPE)


def share(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / (total + terms)) by long division, three digits at a time."""
    of = total + terms
    whole, rest = np.divmod(count + 1, of)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, of)
        whole = whole * 1000 + digits
    return whole + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _pairs(source: np.ndarray, p: np.ndarray, sizes: np.ndarray, zero: np.ndarray, low: int, high: int) -> np.ndarray:
    """Sums of divergences over a bucket's terms, of sources ``low`` to ``high`` from every source.

    Entries (source, share p) lie term by term, ``sizes`` entries a term; ``zero``
    holds each source's share of a term that it lacks.
    """
    n, rows = len(zero), high - low
    uses = np.bincount(source, minlength=n)
    base = divergence(zero[low:high, None], zero[None, :])
    sums = base * (len(sizes) - uses[low:high, None] - uses[None, :])
    ends = np.cumsum(uses)
    by_source = p[np.argsort(source, kind="stable")]
    step = max(1, _CELLS // max(n, 1))
    for s in range(n):
        shares, times = np.unique(by_source[ends[s] - uses[s]:ends[s]], return_counts=True)
        for at in range(0, len(shares), step):
            x, k = shares[at:at + step, None], times[at:at + step, None]
            sums[:, s] += (divergence(zero[None, low:high], x) * k).sum(0)
            if low <= s < high:
                sums[s - low] += (divergence(x, zero[None, :]) * k).sum(0)
    # terms that both use: put the true value in place of the two above
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    partners = np.repeat(sizes, sizes)
    mine = np.flatnonzero((source >= low) & (source < high))
    upto = np.cumsum(partners[mine])
    flat, at = sums.reshape(-1), 0
    while at < len(mine):
        done = upto[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(upto, done + _CELLS, "right")))
        e = mine[at:stop]
        k = partners[e]
        a = np.repeat(e, k)
        b = np.repeat(starts[e], k) + np.arange(len(a)) - np.repeat(np.cumsum(k) - k, k)
        sa, sb = source[a], source[b]
        gain = divergence(p[a], p[b]) - divergence(p[a], zero[sb]) - divergence(zero[sa], p[b]) + base[sa - low, sb]
        np.add.at(flat, (sa - low) * n + sb, gain)
        at = stop
    return flat.reshape(rows, n)


def _emit(limit: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        lang, block = key[0].as_py(), key[2].as_py()
        right = right.sort_by("source")
        names = right.column("source").combine_chunks()
        n = right.num_rows
        low, high = block * SOURCE_BLOCK, min(n, (block + 1) * SOURCE_BLOCK)
        columns: list[list] = [[], [], [], []]
        sums = np.zeros((max(high - low, 0), n), np.int64)
        if left.num_rows and high > low:
            left = left.sort_by("term")  # byte order
            totals, terms = np.asarray(right.column("n")), int(right.column("v")[0].as_py())
            sources = left.column("sources").combine_chunks()
            sizes = np.asarray(pc.list_value_length(sources)).astype(np.int64)
            source = np.asarray(pc.index_in(sources.flatten(), value_set=names)).astype(np.int64)
            count = np.asarray(left.column("counts").combine_chunks().flatten())
            p = share(count, totals[source], terms)
            sums = _pairs(source, p, sizes, share(np.zeros(n, np.int64), totals, terms), low, high)
            term = np.repeat(np.arange(len(sizes)), sizes)
            q = share(np.asarray(left.column("total")), np.int64(right.column("n_lang")[0].as_py()), terms)[term]
            at = np.flatnonzero((p > q) & (source >= low) & (source < high))
            value = divergence(p[at], q[at])
            order = np.lexsort((term[at], -value, source[at]))
            owner = source[at][order]
            order = order[np.arange(len(order)) - np.searchsorted(owner, owner) < limit]
            at, value = at[order], value[order]
            columns[0].append(names.take(pa.array(source[at])))
            columns[1].append(pa.array(["term"] * len(at), pa.string()))
            columns[2].append(left.column("term").combine_chunks().take(pa.array(term[at])))
            columns[3].append(pa.array(value))
        a, b = np.nonzero(np.arange(low, max(high, low))[:, None] != np.arange(n)[None, :])
        columns[0].append(names.take(pa.array(a + low)))
        columns[1].append(pa.array(["pair"] * len(a), pa.string()))
        columns[2].append(names.take(pa.array(b)))
        columns[3].append(pa.array(sums[a, b]))
        cols = [pa.chunked_array(c) for c in columns]
        return pa.Table.from_arrays([pa.chunked_array([pa.array([lang] * len(cols[0]), pa.string())]), *cols], names=["lang", "source", "part", "item", "value"])
    return run


def audit(spark: SparkSession, docs: DataFrame, min_docs: int = 3, terms: int = 200,
          text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """How far each source of a language is from its other sources and from the language.

    Returns ``lang, source, part, item, value, rank``: part ``pair`` has one row for
    each other source of the language, part ``term`` the ``terms`` terms that set the
    source apart most. Terms are runs of letters A-Z (lower-cased) and non-ASCII
    characters, kept per language if ``min_docs`` of its documents hold them.

    Null texts, languages and sources are read as empty; a group without any term
    has its pair rows (value 0 where its language keeps no term) and no term rows;
    repeated rows are documents of their own; equal values rank by the item's
    bytes; an empty table gives no rows; other columns are ignored. A task holds
    one document's terms, a bounded number of stripes, or a bucket of merged
    stripes with the source list of one language.
    """
    empty = F.lit("")
    docs = docs.select(*[F.coalesce(docs[c].cast("string"), empty).alias(a) for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    kept = stage(spark, stripes(spark, docs).where(F.col("df") >= min_docs).select("lang", "term", total.alias("total"), "sources", "counts"), "stripes")
    entries = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e")).select("lang", "e.sources", "e.counts")
    per_source = entries.groupBy("lang", F.col("sources").alias("source")).agg(F.sum("counts").alias("n"))
    per_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    zero = F.lit(0).cast("long")
    groups = stage(spark, docs.select("lang", "source").distinct().join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left")
                   .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "v", "n_lang")]), "groups")
    # two numbers reach the driver
    n_entries = kept.agg(F.sum(F.size("counts"))).first()[0] or 0
    widest = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    buckets, source_blocks = 1 + n_entries // BUCKET_ENTRIES, 1 + (widest - 1) // SOURCE_BLOCK if widest else 1
    block = F.explode(F.sequence(F.lit(0), F.lit(source_blocks - 1))).alias("block")
    left = kept.select("*", F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"), block)
    right = groups.withColumn("bucket", F.explode(F.sequence(zero, F.lit(buckets - 1).cast("long")))).select("*", block)
    key = ("lang", "bucket", "block")
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_emit(terms), "lang string, source string, part string, item string, value long")
    found = stage(spark, found, "divergences")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pair = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(best))
    term = found.where("part = 'term'").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= terms)
    return pair.unionByName(term)
