"""Removal of word sequences that occur more than once, by fixed-block anchors.

Every document is cut into non-overlapping blocks of half a window, so that any window holds a whole block of its own
document. The blocks are indexed and probed with the rolling block-long windows of all documents; an anchor is a block that
another place repeats. Only windows over an anchor of their document can be repeats: those are compared in full length by
two 64-bit hashes of independent seeds, and overlapping repeats grow into maximal spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunks import answered, bits, buckets_for, pack, packed_bits, rows_by_bucket, texts_of
from .words import mixed, rolling, word_hashes

LOW = np.uint64(0xFFFFFFFF)


class Layout:
    """The words of a chunk in a row, with each word's place in its document."""

    def __init__(self, sizes: list[int], blob: bytes):
        self.words = [text.split() for text in texts_of(sizes, blob)]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.hashes = np.concatenate([word_hashes(w) for w in self.words]) if self.words else np.empty(0, np.uint64)
        self.ends = np.cumsum(self.lengths)
        begins = self.ends - self.lengths
        self.place = np.arange(len(self.hashes)) - np.repeat(begins, self.lengths)
        self.left = np.repeat(self.ends, self.lengths) - np.arange(len(self.hashes))

    def second_hashes(self) -> np.ndarray:
        """Hashes of the words that are independent of the first."""
        return np.concatenate([word_hashes(w, seed=1) for w in self.words])

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every window of n words that lies within a document."""
        found = rolling(self.hashes, n)
        start = np.flatnonzero(self.left[: len(found)] >= n)
        return start, found[start]


def block_keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32-bit fingerprint in one number."""
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | (hashes & LOW)


def window_buckets(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return mixed(pairs[:, 1] ^ LOW) % np.uint64(buckets)


def distinct_pairs(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows of two numbers, the place of every row among them, and how often each occurs."""
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    ordered = pairs[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(1)
    group = np.cumsum(new) - 1
    place = np.empty(len(pairs), np.int64)
    place[order] = group
    return ordered[new], place, np.bincount(group, minlength=int(new.sum()))


def anchor_answer(rows: list[tuple]) -> list[bytes]:
    """For (bucket, chunk, values, several, block): which values are an indexed block and occur twice or more."""
    sets = [np.frombuffer(row[2], np.uint32) for row in rows]
    several = np.concatenate([bits(row[3], len(s)) for row, s in zip(rows, sets, strict=True)])
    block = np.concatenate([bits(row[4], len(s)) for row, s in zip(rows, sets, strict=True)])
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    anchor = (np.bincount(place, 1 + several) >= 2) & (np.bincount(place, block) > 0)
    return [packed_bits(part) for part in np.split(anchor[place], np.cumsum([len(s) for s in sets])[:-1])]


def repeat_answer(rows: list[tuple]) -> list[bytes]:
    """For (bucket, chunk, values, several): which values, pairs of hashes, occur twice or more."""
    sets = [np.frombuffer(row[2], np.uint64).reshape(-1, 2) for row in rows]
    several = np.concatenate([bits(row[3], len(s)) for row, s in zip(rows, sets, strict=True)])
    _, place, _ = distinct_pairs(np.concatenate(sets))
    repeat = np.bincount(place, 1 + several) >= 2
    return [packed_bits(part) for part in np.split(repeat[place], np.cumsum([len(s) for s in sets])[:-1])]


def chosen(values: np.ndarray, bucket: np.ndarray, answers: list[dict] | None) -> np.ndarray:
    """The values, sorted by bucket, whose bit is set in the answers."""
    if answers is None:
        return values[:0]
    by_bucket = {a["bucket"]: a["data"] for a in answers}
    sizes = np.bincount(bucket.astype(np.int64)) if len(bucket) else []
    flags = [bits(by_bucket[b], n) for b, n in enumerate(sizes) if n]
    return values[np.concatenate(flags)] if flags else values[:0]


def has(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


class Anchors:
    """Anchor questions of a chunk."""

    def __init__(self, layout: Layout, block: int, buckets: int):
        self.start, hashes = layout.windows(block)
        self.keys = block_keys(hashes, buckets)
        self.own = layout.place[self.start] % block == 0
        self.values, self.counts = np.unique(self.keys, return_counts=True)
        self.bucket = self.values >> np.uint64(32)

    def questions(self, chunk: int) -> Iterator[tuple]:
        block = has(np.unique(self.keys[self.own]), self.values)
        columns = [(self.values & LOW).astype(np.uint32), self.counts > 1, block]
        return rows_by_bucket(chunk, self.bucket, columns, [np.ndarray.tobytes, packed_bits, packed_bits])

    def found(self, answers: list[dict] | None, n_words: int) -> np.ndarray:
        """For every word whether an anchor block of its document starts there."""
        flags = np.zeros(n_words, bool)
        hit = has(chosen(self.values, self.bucket, answers), self.keys[self.own])
        flags[self.start[self.own][hit]] = True
        return flags


class Repeats:
    """Full-length questions of a chunk: windows over an anchor."""

    def __init__(self, layout: Layout, anchors: np.ndarray, window: int, block: int, buckets: int):
        start, hashes = layout.windows(window)
        first_block = start + -layout.place[start] % block  # the first own block in the window
        use = anchors[first_block] if len(start) else np.zeros(0, bool)
        self.start = start[use]
        second = rolling(layout.second_hashes(), window)[self.start] if len(self.start) else hashes[:0]
        values, self.place, counts = distinct_pairs(np.column_stack((hashes[use], second)))
        bucket = window_buckets(values, buckets)
        self.order = np.argsort(bucket, kind="stable")
        self.values, self.counts, self.bucket = values[self.order], counts[self.order], bucket[self.order]

    def questions(self, chunk: int) -> Iterator[tuple]:
        return rows_by_bucket(chunk, self.bucket, [self.values, self.counts > 1], [np.ndarray.tobytes, packed_bits])

    def covered(self, answers: list[dict] | None, window: int, n_words: int) -> np.ndarray:
        repeated = np.zeros(len(self.values), bool)
        repeated[chosen(self.order, self.bucket, answers)] = True
        start = self.start[repeated[self.place]]
        steps = np.bincount(start, minlength=n_words + 1) - np.bincount(start + window, minlength=n_words + 1)
        return np.cumsum(steps)[:n_words] > 0


def _table(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


ASK = [("bucket", pa.int32()), ("chunk", pa.int64()), ("values", pa.binary()), ("several", pa.binary()), ("block", pa.binary())]


def substring_dedup(
    documents: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256, spans (removed runs of words: start, end); with_text adds kept.

    A word goes when a window of ``window`` words over it has the same words as a window that starts anywhere else, in the
    same document or another. Windows are judged on the input. Kept words are joined by one space. Null, empty and short
    texts lose nothing; of repeated rows every window is a repeat, so both lose them; an empty table gives no rows.
    """
    block = (window + 1) // 2
    chunks = pack(documents, id_col, text_col)
    buckets = buckets_for(chunks)

    def ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                layout = Layout(row["sizes"], row["blob"])
                yield _table(list(Anchors(layout, block, buckets).questions(row["chunk"])), ASK)

    def ask_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                layout = Layout(row["sizes"], row["blob"])
                anchors = Anchors(layout, block, buckets).found(row["answers"], len(layout.hashes))
                yield _table(list(Repeats(layout, anchors, window, block, buckets).questions(row["chunk"])), ASK[:4])

    fields = [
        (id_col, pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
    fields += [("kept", pa.string())] * with_text

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                layout = Layout(row["sizes"], row["blob"])
                total = len(layout.hashes)
                anchors = Anchors(layout, block, buckets).found(row["answers"], total)
                gone = Repeats(layout, anchors, window, block, buckets).covered(row["repeats"], window, total)
                out, at = [], 0
                for ident, words in zip(row["ids"], layout.words, strict=True):
                    mine = gone[at : at + len(words)]
                    at += len(words)
                    edges = np.flatnonzero(np.diff(mine, prepend=False, append=False)).tolist()
                    kept, last = [], 0
                    for start, end in zip(edges[::2], edges[1::2], strict=True):
                        kept += words[last:start]
                        last = end
                    data = b" ".join(kept + words[last:])
                    spans = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                    result = (ident, len(words), int(mine.sum()), hashlib.sha256(data).hexdigest(), spans)
                    out.append((*result, data.decode()) if with_text else result)
                yield _table(out, fields)

    asked = chunks.select("chunk", "sizes", "blob").mapInArrow(
        ask_anchors, "bucket int, chunk long, values binary, several binary, block binary"
    )
    anchors = answered(asked, anchor_answer)
    with_anchors = chunks.join(anchors, "chunk", "left")
    asked = with_anchors.mapInArrow(ask_repeats, "bucket int, chunk long, values binary, several binary")
    repeats = answered(asked, repeat_answer).withColumnRenamed("answers", "repeats")
    schema = f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    schema += ", kept string" * with_text
    # three tables of one row per chunk; only the chunks' texts are large
    return with_anchors.join(repeats, "chunk", "left").mapInArrow(remove, schema)
