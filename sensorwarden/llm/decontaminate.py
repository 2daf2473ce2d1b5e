"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so their Jaccard similarity says nothing; the share of an item's shingles that a
document holds does. Items are partitioned by their number of shingles. An item's MinHash sketch is its k smallest shingle
hashes with k = n - ceil(t n) + 1: a document with at least t of the item's n shingles lacks fewer than k of them, so it
holds one of the sketch, and the search loses nothing. Per partition only the document hashes below the partition's largest
sketch value are probed. Candidates are verified by exact containment of all shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, let_go, ship, written
from .words import shingle_set, words_of

#: Shingles of the items that are held in memory and searched for at once; more items take more passes.
BLOCK_SHINGLES = 1_000_000


def needed(n: int, percent: int) -> int:
    """Shingles of an item of n that must be found."""
    return -(-n * percent // 100)


@dataclass(frozen=True)
class SizePartition:
    least: int  # shingles that any hit of the partition has in common with its item
    bound: np.uint64
    values: np.ndarray  # sketch values, sorted
    owners: np.ndarray  # the item of each value


class ItemIndex:
    """Items (id, sorted shingles) of one block, by size partition."""

    def __init__(self, items: list[tuple[int, np.ndarray]], percent: int):
        self.percent = percent
        self.items = [(ident, shingles) for ident, shingles in items if len(shingles)]
        by_size: dict[int, list[int]] = {}
        for place, (_, shingles) in enumerate(self.items):
            by_size.setdefault(len(shingles).bit_length(), []).append(place)
        self.partitions = []
        for places in by_size.values():
            sketches = []
            for place in places:
                shingles = self.items[place][1]
                sketches.append(shingles[: len(shingles) - needed(len(shingles), percent) + 1])
            values = np.concatenate(sketches)
            owners = np.repeat(places, [len(s) for s in sketches])
            order = np.argsort(values, kind="stable")
            least = min(needed(len(self.items[p][1]), percent) for p in places)
            self.partitions.append(SizePartition(least, values.max(), values[order], owners[order]))

    def search(self, document: np.ndarray) -> list[tuple[int, int, int]]:
        """(item id, shingles of the item, shingles found) of every contained item; document: sorted shingles."""
        found = []
        for part in self.partitions:
            if len(document) < part.least:
                continue
            probes = document[: np.searchsorted(document, part.bound, "right")]
            first = np.searchsorted(part.values, probes, "left")
            last = np.searchsorted(part.values, probes, "right")
            hit = np.flatnonzero(last > first)
            for place in {int(p) for i in hit for p in part.owners[first[i] : last[i]]}:
                ident, shingles = self.items[place]
                at = np.searchsorted(document, shingles)
                shared = int((document[np.minimum(at, len(document) - 1)] == shingles).sum())
                if shared >= needed(len(shingles), self.percent):
                    found.append((ident, len(shingles), shared))
        return sorted(found, key=lambda hit: (hit[0] is None, hit[0] or 0))


HITS = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("item_shingles", T.LongType()),
        T.StructField("shared_shingles", T.LongType()),
    ]
)
ARROW_HITS = pa.list_(pa.struct([(name, pa.int64()) for name in HITS.names]))


def item_blocks(benchmark: DataFrame, percent: int, words: int) -> Iterator[ItemIndex]:
    """Indexes over the items, each of about BLOCK_SHINGLES shingles: what is sent to tasks has a fixed bound."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(words_of(t.as_py(), lower=True), words).view(np.int64) for t in batch.column(1)]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(sets, pa.list_(pa.int64()))], names=["item_id", "n", "shingles"]
            )

    ship(benchmark.sparkSession)
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    items = written(items.mapInArrow(shingled, "item_id long, n long, shingles array<long>"), "items")
    total = items.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_SHINGLES))
    block = F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks))
    for number in range(blocks):
        rows = items.filter(block == number).select("item_id", "shingles").collect()
        yield ItemIndex([(i, np.array(s, np.int64).view(np.uint64)) for i, s in rows], percent)


def with_hits(documents: DataFrame, index: ItemIndex, words: int, text_col: str, hits_col: str) -> DataFrame:
    """The rows with an array of the block's items that they contain."""
    sent = documents.sparkSession.sparkContext.broadcast(index)
    schema = T.StructType([*documents.schema.fields, T.StructField(hits_col, T.ArrayType(HITS))])
    place = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        index = sent.value
        for batch in batches:
            hits = []
            for text in batch.column(place):
                found = index.search(shingle_set(words_of(text.as_py(), lower=True), words))
                hits.append([dict(zip(HITS.names, hit, strict=True)) for hit in found])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, ARROW_HITS)], names=schema.names)

    return documents.mapInArrow(run, schema)


def contained_items(
    documents: DataFrame, benchmark: DataFrame, percent: int = 80, words: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document and item of which it holds at least ``percent`` of the distinct shingles.

    Result: id, item_id, item_shingles, shared_shingles. A-Z count as a-z. A text with fewer words than a shingle is one
    shingle, on both sides; null and empty texts have none and take no part. Repeated rows give repeated results.
    """
    rows = documents.select(F.col(id_col), F.col(text_col))
    result = None
    for index in item_blocks(benchmark, percent, words):
        hits = with_hits(rows, index, words, text_col, "_hits").select(id_col, F.inline("_hits"))
        result = hits if result is None else result.unionByName(hits)
    return result


def decontaminated(
    documents: DataFrame, benchmark: DataFrame, percent: int = 80, words: int = 5, text_col: str = "text"
) -> DataFrame:
    """The rows that contain no item, with all their columns."""
    for index in item_blocks(benchmark, percent, words):
        hits = free_name(documents, "item_hits")
        documents = with_hits(documents, index, words, text_col, hits).filter(F.size(F.col(hits)) == 0).drop(hits)
    return documents
