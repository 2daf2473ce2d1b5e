"""Documents packed into chunks, and questions of chunks to hash buckets.

Corpus-wide counts of billions of hashes are not shuffled as rows. Each chunk of documents sends every bucket one array of
its distinct hash values; the bucket counts over all chunks and answers each of them with one array in the same order. A
hash that is frequent anywhere is one value per chunk, so no bucket is hot, and the number of buckets follows the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, let_go, ship, written

#: Text bytes of a chunk, about; a longer document is a chunk of its own.
CHUNK_BYTES = 4 << 20

#: Values that meet in one bucket, about.
BUCKET_VALUES = 2_000_000

CHUNK = "chunk long, ids array<long>, sizes array<long>, blob binary"


def squeezed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unsqueezed(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Chunks of documents, written to the shared folder: chunk, ids, sizes (bytes of each text), blob."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        let_go()
        number = TaskContext.get().partitionId() << 32
        ids, texts, total = [], [], 0

        def chunk() -> pa.RecordBatch:
            nonlocal number, ids, texts, total
            blob = squeezed(b"".join(texts))
            columns = [
                pa.array([number], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                pa.array([blob], pa.binary()),
            ]
            number, ids, texts, total = number + 1, [], [], 0
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "sizes", "blob"])

        for batch in batches:
            for ident, text in zip(batch.column(0), batch.column(1), strict=True):
                data = (text.as_py() or "").encode()
                if texts and total + len(data) > CHUNK_BYTES:
                    yield chunk()
                ids.append(ident.as_py())
                texts.append(data)
                total += len(data)
        if texts:
            yield chunk()

    ship(documents.sparkSession)
    rows = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(run, CHUNK), "chunks", codec="none")


def buckets_for(chunks: DataFrame) -> int:
    """Buckets for about one value per word."""
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b))).first()[0] or 0
    return max(16, -(-total // (7 * BUCKET_VALUES)))


def texts_of(sizes: list[int], blob: bytes) -> Iterator[bytes]:
    data, at = unsqueezed(blob), 0
    for size in sizes:
        yield data[at : at + size]
        at += size


def rows_by_bucket(chunk: int, bucket: np.ndarray, columns: list[np.ndarray], encode: list[Callable]) -> Iterator[tuple]:
    """(bucket, chunk, encoded slice of each column) for values sorted by bucket."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for low, high in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
        if high > low:
            yield (int(bucket[low]), chunk, *(f(c[low:high]) for f, c in zip(encode, columns, strict=True)))


def packed_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def answered(questions: DataFrame, answer: Callable[[list[tuple]], list[bytes]]) -> DataFrame:
    """Answers per chunk: chunk, answers (bucket and data), written to the shared folder.

    ``answer`` gets all question rows of a bucket and returns one answer for each. Answers do not depend on their order.
    """
    names = questions.columns

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        let_go()
        given = list(rows[names].itertuples(index=False, name=None))
        return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "data": answer(given)})

    found = questions.groupBy("bucket").applyInPandas(run, "chunk long, bucket int, data binary")
    return written(found.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "data")).alias("answers")), "answers", codec="none")
