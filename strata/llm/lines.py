"""Line dedup: repeated runs of lines by a suffix array over line ids.

Every line of every document is a symbol; a suffix begins at each line and ends
with its document. Distributed prefix doubling ranks the suffixes by their first
1, 2, 4 … lines: a pair of ranks gets a new rank by one range-partitioned sort
of the different pairs. Suffixes that share no rank with another stand alone in
the suffix array for good and leave after each round. Doubling ends when the
depth is that of the shortest run that counts: a rank that several suffixes have
is then a longest-common-prefix interval of at least that many lines. All but
the first of an interval start a repeated run; neighbouring starts make up the
maximal runs, whose lines go. A line with enough content can count as a run by
itself: it goes wherever it was seen before, whatever stands around it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import blocks, fresh, stage

MIN_LINES = 2
LONE_WORDS = 10        # a line of so many words, or of so many bytes, is a passage by itself
LONE_BYTES = 100


def _ranks(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """(rid, place, n, r) of the suffixes whose pair (a, b) occurs more than once; ``r`` keeps the pairs' order."""
    repeated = pairs.groupBy("a", "b").agg(F.count("*").alias("c")).where("c > 1").select("a", "b")
    # partitions hold ascending ranges, so the id rises with (a, b); fixed by the write
    named = stage(spark, repeated.repartitionByRange("a", "b").sortWithinPartitions("a", "b")
                  .withColumn("r", F.monotonically_increasing_id()), "line-ranks")
    return pairs.join(named, ["a", "b"]).select("rid", "place", "n", "r")


def _later(spark: SparkSession, pairs: DataFrame, name: str) -> DataFrame:
    """(rid, n): rows whose pair (a, b) an earlier place has too."""
    pairs = pairs.select("rid", "n", "a", "b", F.struct("place", "rid", "n").alias("at"))
    # staged: beside an aggregate Spark cannot split the commonest pair's rows
    first = stage(spark, pairs.groupBy("a", "b").agg(F.min("at").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c"), name)
    return pairs.join(first, ["a", "b"]).where("at > first").select("rid", "n")


def repeated_starts(spark: SparkSession, lines: DataFrame, min_lines: int) -> DataFrame:
    """(rid, n): lines that start a run of ``min_lines`` lines that starts at an earlier place too.

    ``lines`` has ``rid``, ``place`` (a document's place in the order), ``n`` (line number) and
    the line's two hashes ``a`` and ``b``. The last doubling only pairs the ranks: the first
    place of each pair is all that is asked of it.
    """
    pairs = lines.select("rid", "place", "n", "a", "b")
    depth = 1
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        after = Window.partitionBy("rid").orderBy("n").rangeBetween(step, step)
        ranked = _ranks(spark, pairs).select("rid", "place", "n", F.col("r").alias("a"), F.max("r").over(after).alias("b"))
        pairs = stage(spark, ranked.where("b IS NOT NULL"), "line-pairs")
        depth += step
    return _later(spark, pairs, "line-first")


def repeated_alone(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """(rid, n): lines marked ``lone`` that an earlier place has too."""
    return _later(spark, lines.where("lone"), "line-alone")


def added(docs: DataFrame) -> list[str]:
    """The names of the columns that ``remove_repeats`` adds to ``docs``."""
    return [fresh(docs, c) for c in ("n_lines_", "n_removed_", "run_start_", "run_lines_")]


def remove_repeats(spark: SparkSession, docs: DataFrame, min_lines: int = MIN_LINES, id_col: str = "doc_id",
                   text_col: str = "text", lone_words: int | None = None, lone_bytes: int | None = None) -> DataFrame:
    """``docs`` with the later copies of repeated line runs cut from the text, and
    ``n_lines_``, ``n_removed_``, ``run_start_``, ``run_lines_`` (the maximal runs cut;
    with more underscores where ``docs`` has such a column in any case: ``added``).

    Lines end at "\\n" and are compared byte by byte. A line goes if it lies in
    ``min_lines`` or more consecutive lines of its document that also start
    earlier (a smaller id, null ids last, then input order; or above in the same
    document; overlaps count), judged on the input. So does a single line that
    starts earlier if it has ``lone_words`` words (parted by ASCII blanks) or
    ``lone_bytes`` bytes (None: not judged). Kept lines are joined by "\\n".
    A null text stays null with no lines, an empty text is one empty line; a text
    that loses all lines is empty. Repeated rows are documents of their own; no
    rows give no rows; other columns stay.
    """
    rid = fresh(docs, "rid_")
    base = stage(spark, docs.withColumn(rid, F.monotonically_increasing_id()), "line-docs")
    place = F.struct(F.col(f"`{id_col}`").isNull().alias("n"), F.col(f"`{id_col}`").alias("i"))
    lone = F.lit(False)
    if lone_words is not None:
        lone |= F.size(F.filter(F.split("line", r"[\x20\x09-\x0D]+"), lambda w: w != "")) >= lone_words
    if lone_bytes is not None:
        lone |= F.octet_length("line") >= lone_bytes
    lines = stage(spark, base.where(F.col(f"`{text_col}`").isNotNull()).select(
        F.col(rid).alias("rid"), place.alias("place"), F.posexplode(F.split(F.col(f"`{text_col}`"), "\n", -1)).alias("n", "line"))
        .select("rid", "place", "n", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), F.reverse("line")).alias("b"), lone.alias("lone")), "lines")
    starts = repeated_starts(spark, lines, min_lines).withColumn("alone", F.lit(False))
    if lone_words is not None or lone_bytes is not None:
        starts = starts.union(repeated_alone(spark, lines).withColumn("alone", F.lit(True)))
    starts = starts.groupBy("rid").agg(F.collect_list(F.when(~F.col("alone"), F.col("n"))).alias(fresh(docs, "starts_")),
                                       F.collect_list(F.when(F.col("alone"), F.col("n"))).alias(fresh(docs, "alone_")))
    found = base.join(starts.withColumnRenamed("rid", rid), rid, "left").drop(rid)
    names = added(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, text_col):
            i = b.schema.get_field_index(text_col)
            texts = b.column(i).to_pylist()
            counts, removed, run_start, run_lines = [], [], [], []
            for k, (starts, alone) in enumerate(zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist())):
                cut = texts[k].split("\n") if texts[k] is not None else []
                counts.append(len(cut))
                edge = np.zeros(len(cut) + 1, np.int64)
                if starts:
                    edge[starts] += 1
                    np.add.at(edge, np.array(starts) + min_lines, -1)
                gone = np.cumsum(edge[:-1]) > 0
                gone[alone or []] = True
                step = np.diff(np.r_[0, gone.astype(np.int8), 0])
                first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                run_start.append(first.tolist()), run_lines.append((last - first).tolist())
                removed.append(int(gone.sum()))
                if removed[-1]:
                    texts[k] = "\n".join(x for x, g in zip(cut, gone.tolist()) if not g)
            cols = list(b.columns[:-2])
            cols[i] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(run_start, pa.list_(pa.int32())),
                 pa.array(run_lines, pa.list_(pa.int32()))], names=[*b.schema.names[:-2], *names])

    from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
    types = [LongType(), LongType(), ArrayType(IntegerType()), ArrayType(IntegerType())]
    return found.mapInArrow(run, StructType([*docs.schema.fields, *map(StructField, names, types)]))
