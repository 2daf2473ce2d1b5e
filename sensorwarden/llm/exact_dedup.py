"""Exact deduplication by sorting contents.

Normalised texts are dealt to ranges by splitters that Spark samples, each range is sorted externally, and one pass per
range compares neighbours in full. A range key is (first bytes, SHA-256, rank inside the group), so equal texts lie next
to each other, a group of any size spreads over many ranges, and the sampled splitters stay small however long texts are.
Groups that cross a range border are joined again through the border texts, at most two per range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import HEAVY_ROWS, gathered, let_go, partitions, ship, utf8_sha256, without_spaces, written

#: Code points of the normalised text that lead the sort key.
HEAD = 16

RESULT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("sha", T.StringType()),
        T.StructField("first", T.BooleanType()),
        T.StructField("keep", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("edge", T.LongType()),
        T.StructField("content", T.StringType()),
    ]
)


class _Runs:
    """Runs of equal neighbours in one sorted range; rows of the current run are held as ids only."""

    def __init__(self, part: int):
        self.part, self.runs = part, 0
        self.content = self.sha = None
        self.ids: list = []
        self.out: dict[str, list] = {name: [] for name in RESULT.names}

    def _close(self, last: bool) -> None:
        if not self.ids:
            return
        # a first or last run may go on in the next range
        edge = self.part * 2 if self.runs == 0 else self.part * 2 + 1 if last else None
        n, out = len(self.ids), self.out
        out["id"] += self.ids
        out["sha"] += [self.sha] * n
        out["first"] += [True] + [False] * (n - 1)
        out["keep"] += [self.ids[0]] * n
        out["size"] += [n] * n
        out["edge"] += [edge] * n
        out["content"] += [None if edge is None else self.content] + [None] * (n - 1)
        self.runs += 1

    def add(self, ident, sha: str, content: str) -> None:
        if self.ids and self.sha == sha and self.content == content:
            self.ids.append(ident)
            return
        self._close(False)
        self.ids, self.sha, self.content = [ident], sha, content

    def taken(self, last: bool = False) -> pa.RecordBatch:
        if last:
            self._close(True)
            self.ids = []
        out, self.out = self.out, {name: [] for name in RESULT.names}
        types = [pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(out[name], kind) for name, kind in zip(RESULT.names, types, strict=True)], names=RESULT.names
        )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    let_go()
    runs = _Runs(TaskContext.get().partitionId())
    for batch in batches:
        for row in zip(batch["id"].to_pylist(), batch["sha"].to_pylist(), batch["content"].to_pylist(), strict=True):
            runs.add(*row)
        yield runs.taken()
    yield runs.taken(last=True)


def _ranged(documents: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """Rows with id, content and sha in content order, dealt to ranges by sampled splitters."""
    ship(documents.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = documents.select(
        F.col(id_col).cast("bigint").alias("id"),
        without_spaces(text).alias("content"),
        (-F.length(text)).alias("shorter"),
        *more,
    ).withColumn("sha", utf8_sha256(F.col("content")))
    key = [F.substring("content", 1, HEAD), F.col("sha"), F.col("shorter"), F.col("id").asc_nulls_last()]
    return rows.repartitionByRange(partitions(documents.sparkSession), *key).sortWithinPartitions(*key)


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each run, with the range's even edge if the run opens the range; at last an odd edge without a row."""
    let_go()
    sha = content = kind = part = None
    runs = 0
    for batch in batches:
        part = batch["range"][0].as_py() if len(batch) else part
        rows, shas, contents = batch["row"], batch["sha"].to_pylist(), batch["content"]
        kind, take, edges, opening = rows.type, [], [], []
        for i, now in enumerate(shas):
            text = contents[i].as_py()
            if runs and now == sha and text == content:
                continue
            take.append(i)
            edges.append(None if runs else part * 2)
            opening.append(None if runs else text)
            sha, content, runs = now, text, runs + 1
        columns = [rows.take(pa.array(take, pa.int64())), pa.array(edges, pa.int64()), pa.array(opening, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "edge", "content"])
    if runs:
        columns = [pa.nulls(1, kind), pa.array([part * 2 + 1], pa.int64()), pa.array([content], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "edge", "content"])


def distinct_rows(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int | None = None) -> DataFrame:
    """The rows that ``exact_dedup`` keeps, with all their columns; texts are shuffled once.

    ``rows``: how many documents there are, where it is known; then few of them are not a file of each range.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    # several ranges may be one task below, so every row names its range
    ranged = _ranged(documents, id_col, text_col, row.alias("row"))
    ranged = ranged.select("row", "sha", "content", F.spark_partition_id().alias("range"))
    schema = T.StructType([ranged.schema["row"], T.StructField("edge", T.LongType()), T.StructField("content", T.StringType())])
    schema["row"].nullable = True
    firsts = ranged.mapInArrow(_firsts, schema)
    found = written(firsts if rows is None else gathered(firsts, rows, HEAVY_ROWS), "exact-firsts")
    # at most two rows per range
    first = found.filter("edge is not null").groupBy("content").agg(F.min("edge").alias("first_edge"), F.collect_set("edge").alias("edges"))
    again = first.select(F.explode("edges").alias("edge"), "first_edge").filter("edge > first_edge").select("edge")
    kept = found.filter(F.col("row").isNotNull()).join(F.broadcast(again), "edge", "left_anti")
    return kept.select("row.*")


def exact_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; null counts as empty. Of equal texts the longest original stays,
    then the smallest id; a null id comes after all others. Of rows repeated with one id and text exactly one is kept. An
    empty table gives no rows; other columns of the input are not read.
    """
    ranged = _ranged(documents, id_col, text_col)
    found = written(ranged.select("id", "sha", "content").mapInArrow(_neighbours, RESULT), "exact-runs")

    # at most two runs per range: first and last; equal border texts are one group
    border = found.filter("first and edge is not null").select("edge", "keep", "size", "content")
    whole = border.groupBy("content").agg(
        F.sum("size").alias("all_size"),
        F.min_by("keep", "edge").alias("all_keep"),
        F.min("edge").alias("first_edge"),
        F.collect_list("edge").alias("edges"),
    )
    whole = whole.select(F.explode("edges").alias("edge"), "all_size", "all_keep", "first_edge")
    # bounded by twice the number of ranges, four numbers each
    joined = found.drop("content").join(F.broadcast(whole), "edge", "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("all_size").isNotNull(), F.col("all_keep")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("all_size", "size").alias("group_size"),
        (F.col("first") & F.coalesce(F.col("first_edge") == F.col("edge"), F.lit(True))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
