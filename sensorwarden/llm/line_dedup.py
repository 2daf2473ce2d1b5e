"""Line deduplication over hashed lines, with keep bitmaps per document.

Every line is known by a 128-bit hash of its key. Hashes are first counted per shard of documents, combined before they
are shuffled, so a line that a third of all documents hold is a handful of rows. Those are dealt to hash ranges, sorted by
first document and position within each hash, and one window pass streams the first occurrence and the total count of each
line. Only lines that lose something travel back, as run-length coded bitmaps per document; texts are never shuffled for
the decision. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, partitions, utf8_sha256, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Characters outside A-Z that lower() changes; only lines with one need the slower per-character mapping.
OTHER_UPPER = r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"

#: Document shards in which a hash is counted before its totals meet.
SHARDS = 16


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    stripped = F.btrim(line, F.lit(SPACES))
    return F.when(stripped.rlike(OTHER_UPPER), F.translate(stripped, UPPER, LOWER)).otherwise(F.lower(stripped))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(documents: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per document and distinct line: doc, text_hash, h1, h2, positions. Keys below min_chars are left out."""
    rows = documents.select(
        F.col(id_col).alias("doc"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
        F.posexplode(lines_of(F.col(text_col))).alias("pos", "line"),
    ).withColumn("key", line_key(F.col("line")))
    rows = rows.filter(F.length("key") >= min_chars)
    return rows.select(
        "doc",
        "text_hash",
        "pos",
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("second"), F.col("key")).alias("h2"),
    )


def line_statistics(hashed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per line hash: n_docs, n_lines, first_doc, first_pos (order: document id, nulls first, then position).

    Rows of one document id count as one document.
    """
    spark = hashed.sparkSession
    per_doc = hashed.groupBy("h1", "h2", "doc").agg(F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n"))
    shard = F.pmod(F.xxhash64("doc"), F.lit(shards))
    partial = per_doc.groupBy("h1", "h2", shard.alias("shard")).agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum("n").alias("lines"),
        F.min(F.struct("doc", "pos")).alias("first"),
    )
    ranged = partial.repartitionByRange(partitions(spark), "h1", "h2")
    line = Window.partitionBy("h1", "h2")
    order = line.orderBy("first.doc", "first.pos")
    return (
        ranged.withColumn("rank", F.row_number().over(order))
        .withColumn("n_docs", F.sum("docs").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("n_lines", F.sum("lines").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .filter("rank = 1")
        .select("h1", "h2", "n_docs", "n_lines", F.col("first.doc").alias("first_doc"), F.col("first.pos").alias("first_pos"))
    )


def _runs(dropped: Column) -> Column:
    """Sorted positions as runs [start, end): the run-length coded bitmap."""
    last = F.size(dropped) - 1
    starts = F.filter(dropped, lambda x, i: (i == 0) | (dropped[F.greatest(i - 1, F.lit(0))] != x - 1))
    ends = F.filter(dropped, lambda x, i: (i == last) | (dropped[F.least(i + 1, last)] != x + 1))
    return F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda r: F.struct(r["a"].alias("start"), (r["b"] + 1).alias("end"))
    )


def keep_bitmaps(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
) -> DataFrame:
    """Documents that lose lines: doc, text_hash, n_dropped, dropped (runs of line numbers, start and end exclusive).

    A line goes when its key has at least ``min_chars`` code points and is in at least ``min_docs`` documents; with
    ``keep_first`` its first occurrence stays. A document is an id; rows that repeat an id with another text get a bitmap
    each (``text_hash``).
    """
    hashed = written(line_hashes(documents, id_col, text_col, min_chars), "line-hashes")
    frequent = line_statistics(hashed).filter(F.col("n_docs") >= min_docs)
    hit = hashed.join(frequent, ["h1", "h2"])
    if keep_first:
        hit = hit.filter(~(F.col("doc").eqNullSafe(F.col("first_doc")) & (F.col("pos") == F.col("first_pos"))))
    grouped = hit.groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    return grouped.select("doc", "text_hash", F.size("dropped").cast("bigint").alias("n_dropped"), _runs(F.col("dropped")).alias("dropped"))


def apply_bitmaps(documents: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with n_lines, n_dropped and the kept text.

    Null or empty text is one empty line; a text whose lines all go becomes empty. Null ids are matched as one document.
    """
    rows = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    rows = rows.withColumn("hash", F.xxhash64("body"))
    joined = rows.join(bitmaps, F.col("id").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("text_hash")), "left")
    lines = F.split("body", "\n", -1)

    def between_runs(split: Column) -> Column:
        """The lines outside the runs, a slice for every gap: the text is split once, however many lines there are."""
        starts = F.concat(F.array(F.lit(0)), F.col("dropped.end"))
        ends = F.concat(F.col("dropped.start"), F.array(F.size(split)))
        gaps = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), (b - a).alias("size")))
        return F.flatten(F.transform(gaps, lambda gap: F.slice(split, gap["a"] + 1, gap["size"])))

    kept = F.array_join(F.element_at(F.transform(F.array(lines), between_runs), 1), "\n")
    return joined.select(
        F.col("id").alias(id_col),
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("bigint")).alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("body")).otherwise(kept).alias("kept"),
    )


def line_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """keep_bitmaps and apply_bitmaps in one; per row id, n_lines, n_dropped, kept_sha256. An empty table gives no rows."""
    result = apply_bitmaps(documents, keep_bitmaps(documents, id_col, text_col, **options), id_col, text_col)
    return result.select(id_col, "n_lines", "n_dropped", utf8_sha256(F.col("kept")).alias("kept_sha256"))
