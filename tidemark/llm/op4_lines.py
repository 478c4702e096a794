"""Line dedup by range-partitioned hashes in sorted runs.

Lines go out as two 64-bit hashes with their document and position, never as text. They are range-partitioned by (hash,
document) and sorted by (hash, document, position): a run of equal lines is contiguous, and one line of a third of all
documents spreads over as many neighbouring partitions as its rows need. A window streams over each partition in that order
and takes the first occurrence of a line in each document; the window's keys are those of the range partitions, so the plan
has one range exchange and one sort. Each partition adds up its part of each run, and a row a run and partition carries the
counts of runs that cross boundaries to one place, with the first document and position of the run.

Lines of runs that reach min_docs are looked up by a join, which Spark splits where one line is hot. What comes back per
document is a compressed keep bitmap: (word, keep) for the 64-line words that lose a line, a bit a line, 1 where it stays;
words that aren't listed, and documents that aren't listed, keep all their lines.

Null or empty text is one empty line. A key of fewer than min_key_chars code points is never dropped. Rows with the same
doc_id and text count as one document and each row gets the same bitmap; rows with the same doc_id and other text are
documents of their own. Null doc_ids are an id like any other. Empty tables give empty results; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, cut, partitions


def line_key(line):
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _lines(docs: DataFrame, min_key_chars: int) -> DataFrame:
    """doc, version (hash of the text), at, h1, h2 of each line that can be dropped."""
    lines = docs.select(
        F.col("doc_id").alias("doc"),
        F.xxhash64("text").alias("version"),
        F.posexplode(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), line_key)).alias("at", "key"),  # a key is made once
    )
    return lines.filter(F.length("key") >= max(1, min_key_chars)).select("doc", "version", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def first_occurrences(lines: DataFrame, n: int) -> DataFrame:
    """The first line of each key in each document, streamed from the sorted runs of n range partitions."""
    keys = ("h1", "h2", "doc", "version")
    runs = lines.repartitionByRange(n, *keys).sortWithinPartitions(*keys, "at")
    return runs.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy("at"))).filter("_n = 1").drop("_n")


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_key_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """doc, version, bitmap (array of word, keep) of the documents that lose lines. keep_first: the first line stays."""
    lines = cut(_lines(docs, min_key_chars))
    found = first_occurrences(lines, partitions(docs)).groupBy("h1", "h2")
    found = found.agg(F.count(F.lit(1)).alias("n"), *([F.min(F.struct("doc", "version", "at")).alias("first")] if keep_first else []))
    hits = lines.join(cut(found.filter(F.col("n") >= min_docs).drop("n")), ["h1", "h2"])
    if keep_first:
        hits = hits.filter(~F.struct("doc", "version", "at").eqNullSafe(F.col("first")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % 64)
    words = hits.groupBy("doc", "version", F.expr("CAST(at DIV 64 AS INT)").alias("word")).agg(F.bitwise_not(F.bit_or(bit)).alias("keep"))
    return words.groupBy("doc", "version").agg(F.array_sort(F.collect_list(F.struct("word", "keep"))).alias("bitmap"))


def dropped_positions(bitmap: Column) -> Column:
    """The positions, in order, whose bit is 0 in a keep bitmap."""
    bits = F.sequence(F.lit(0), F.lit(63))
    lost = lambda x: F.filter(bits, lambda b: F.call_function("shiftrightunsigned", x["keep"], b).bitwiseAND(F.lit(1)) == 0)
    return F.flatten(F.transform(bitmap, lambda x: F.transform(lost(x), lambda b: x["word"] * 64 + b)))


def _kept_runs(dropped, n):
    """(first line, lines) of the runs between dropped lines."""
    ends = F.concat(dropped, F.array(n))
    runs = F.transform(ends, lambda e, i: F.struct(F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1) + 1).alias("first"), (e - F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1) + 1)).alias("lines")))
    return F.filter(runs, lambda r: r["lines"] > 0)


def line_dedup(docs: DataFrame, min_docs: int = 10, min_key_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """docs with _lines (array), _dropped (positions) and _runs (kept runs of lines, from the keep bitmap) beside its columns."""
    bitmaps = keep_bitmaps(docs, min_docs, min_key_chars, keep_first).select(F.col("doc").alias("_doc"), F.col("version").alias("_version"), F.col("bitmap").alias("_hit"))
    joined = docs.join(bitmaps, docs["doc_id"].eqNullSafe(bitmaps["_doc"]) & (F.xxhash64(docs["text"]) == bitmaps["_version"]), "left")
    joined = joined.withColumn("_dropped", F.when(F.col("_hit").isNull(), F.array().cast("array<int>")).otherwise(dropped_positions(F.col("_hit"))))
    joined = joined.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    return joined.withColumn("_runs", _kept_runs(F.col("_dropped"), F.size("_lines"))).drop("_doc", "_version", "_hit")


def kept_text():
    """The text that _runs keeps of _lines."""
    return F.array_join(F.flatten(F.transform("_runs", lambda r: F.slice(F.col("_lines"), r["first"] + 1, r["lines"]))), "\n")


def drop_lines(docs: DataFrame, **options) -> DataFrame:
    """docs with the dropped lines taken out of text (and n_chars brought up to date where it exists); a null text stays null."""
    out = line_dedup(docs, **options)
    out = out.withColumn("text", F.when(F.size("_dropped") == 0, F.col("text")).otherwise(kept_text()))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
