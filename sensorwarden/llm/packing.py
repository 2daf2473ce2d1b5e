"""Best-fit packing of tokenised documents into sequences of fixed capacity, with exact complements first.

Documents are tokenised and cut into pieces of at most the capacity; what is planned are only the counts of the piece
lengths, of which there are no more than the capacity. From the longest length down, a gap is filled exactly by one, two or
three further lengths, looked up in tables of single, pair and triple sums; a combination is used as often as all its
lengths are there. Each use empties a length, so there are no more combinations than lengths. The rest is packed by best
fit, again whole groups of equal sequences at a time. Pieces are then ranked within their length by many tasks, and a rank
decides sequence and offset.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions, ship, worker_table, written

#: Bytes of text that are tokenised at once; longer texts are cut at white space, where no token goes across.
SEGMENT = 1 << 20

#: Bytes of words and ids that a worker remembers, with what Python needs for each; longer words are not remembered.
CACHE_BYTES, ENTRY_BYTES, LONG_WORD = 256 << 20, 180, 64

#: What stands between words that are tokenised as one text, and how many these are.
MARK, JOINED = "|", 64

BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]")


class WordTokenizer:
    """Ids of a tokenizer that drops white space and never joins what white space separates.

    Words between ASCII white space are tokenised once and remembered, up to a bound in bytes.
    """

    def __init__(self, content: str, cache_bytes: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark owns the cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.known: dict[bytes, bytes] = {}
        self.bytes, self.cache_bytes = 0, cache_bytes
        self.mark = self._ids([MARK])[0]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _remember(self, word: bytes, ids: bytes) -> None:
        self.known[word] = ids
        self.bytes += len(word) + len(ids) + ENTRY_BYTES

    def _learn(self, words: list[bytes]) -> None:
        """Many words are one text with a mark between them; words with a mark are texts of their own."""
        mark = MARK.encode()
        joined = [w for w in words if mark not in w] if len(self.mark) == 1 else []
        alone = [w for w in words if mark in w] if joined else words
        for at in range(0, len(joined), 64 * JOINED):
            parts = [joined[i : i + JOINED] for i in range(at, min(at + 64 * JOINED, len(joined)), JOINED)]
            texts = [(b" %b " % mark).join(part).decode(errors="replace") for part in parts]
            for part, ids in zip(parts, self._ids(texts), strict=True):
                if ids.count(self.mark[0]) != len(part) - 1:  # a word that the tokenizer turns into a mark
                    alone = [*alone, *part]
                    continue
                data, low = struct.pack(f"<{len(ids)}I", *ids), 0
                for word in part[:-1]:
                    high = ids.index(self.mark[0], low)
                    self._remember(word, data[4 * low : 4 * high])
                    low = high + 1
                self._remember(part[-1], data[4 * low :])
        for at in range(0, len(alone), 4096):
            part = alone[at : at + 4096]
            for word, ids in zip(part, self._ids([w.decode(errors="replace") for w in part]), strict=True):
                self._remember(word, struct.pack(f"<{len(ids)}I", *ids))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self.bytes > self.cache_bytes:
            self.known.clear()
            self.bytes = 0
        lists = [text.split() for text in texts]
        known = self.known
        missing = list(set().union(*lists).difference(known))
        self._learn(missing)
        out = [b"".join(map(known.__getitem__, words)) for words in lists]
        for word in missing:
            if len(word) > LONG_WORD:
                ids = known.pop(word)
                self.bytes -= len(word) + len(ids) + ENTRY_BYTES
        return out


def segments(text: bytes, size: int = SEGMENT) -> Iterator[bytes]:
    """Parts of a text that end before white space; a part without white space is as long as it is."""
    at = 0
    while len(text) - at > size:
        found = BLANK.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def encoded_texts(tokenizer: WordTokenizer, texts: list[bytes]) -> Iterator[bytes]:
    """Ids of every text, tokenised in blocks of about a segment."""
    block, held = [], 0
    for text in texts:
        if len(text) > SEGMENT:
            yield from tokenizer.encode(block)
            block, held = [], 0
            yield b"".join(tokenizer.encode([part])[0] for part in segments(text))
            continue
        block.append(text)
        held += len(text)
        if held > SEGMENT:
            yield from tokenizer.encode(block)
            block, held = [], 0
    yield from tokenizer.encode(block)


def _tokenizer_of(content: str) -> WordTokenizer:
    return worker_table(("word_tokenizer", zlib.crc32(content.encode())), lambda: WordTokenizer(content))


def pieces_of(
    documents: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Per piece of a document: id, piece (from 0), start, length, ids_crc32; with_ids adds ids (little-endian uint32).

    A document is its ids and ``end_id``; only longer ones than ``capacity`` are cut, the last piece may be shorter. Null
    text is empty and gives the end id alone. The tokenizer file is read by the driver (its size does not depend on the
    data) and sent to the workers.
    """
    ship(documents.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as file:
        sent = documents.sparkSession.sparkContext.broadcast(file.read())
    id_type = documents.schema[id_col].dataType
    names = ["piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [T.IntegerType(), T.LongType(), T.LongType(), T.LongType(), T.BinaryType()]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    schema = T.StructType([T.StructField(id_col, id_type)] + [T.StructField(n, k) for n, k in zip(names, kinds, strict=False)])
    end = np.array([end_id], "<u4").tobytes()

    def rows(data: bytes) -> Iterator[tuple]:
        for piece, at in enumerate(range(0, len(data), 4 * capacity)):
            part = data[at : at + 4 * capacity]
            row = (piece, at // 4, len(part) // 4, zlib.crc32(part))
            yield (*row, part) if with_ids else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer_of(sent.value)
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            of, found = [], []
            for i, ids in enumerate(encoded_texts(tokenizer, texts)):
                new = list(rows(ids + end))
                found += new
                of += [i] * len(new)
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, types, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *arrays], names=[id_col, *names])

    return documents.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


class Complements:
    """Lengths that are left, and the combinations of one, two or three of them that fill a gap.

    Which lengths are left is kept as the bits of a number and of its mirror image, so one shift and one "and" compare all
    lengths with what they lack. The sums of two are a table that may be old: counts only fall, so a sum that is not in it
    never comes back, and one that is in it is looked up in the bits before it is used.
    """

    #: Old sums that a search meets in vain before the table is made anew.
    VAIN = 64

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left, self.bits, self.mirror = capacity, [0] * (capacity + 1), 0, 0
        for length, n in counts.items():
            self.take(length, -n)
        self._sums()

    def take(self, length: int, n: int) -> None:
        """Takes n of a length away; a negative n gives them back."""
        before = self.left[length]
        self.left[length] = before - n
        if (before > 0) != (before > n):
            self.bits ^= 1 << length
            self.mirror ^= 1 << (self.capacity - length)

    def _sums(self) -> None:
        """Sums of two lengths, as the bits of a mirror image."""
        pairs, rest, kept = 0, self.bits, (2 << self.capacity) - 1
        while rest:
            low = rest & -rest
            pairs |= self.bits << (low.bit_length() - 1)
            rest ^= low
        self.mirrored_pairs = int(f"{pairs & kept:0{self.capacity + 1}b}"[::-1], 2)

    def _pair(self, gap: int) -> tuple[int, ...] | None:
        """Two lengths with this sum, as unequal as possible."""
        both = self.bits & (self.mirror >> (self.capacity - gap))
        x = (both & -both).bit_length() - 1
        if x < 0 or 2 * x == gap and self.left[x] < 2:
            return None
        return gap - x, x

    def filling(self, gap: int) -> tuple[int, ...] | None:
        """At most three lengths that fill a gap exactly, the fewest and longest first."""
        if gap == 0:
            return ()
        if self.left[gap]:
            return (gap,)
        if found := self._pair(gap):
            return found
        vain, rest = 0, self.bits & (self.mirrored_pairs >> (self.capacity - gap))
        while rest:
            z = rest.bit_length() - 1
            self.take(z, 1)
            found = self._pair(gap - z)
            self.take(z, -1)
            if found:
                return (z, *found)
            rest ^= 1 << z
            vain += 1
            if vain % self.VAIN == 0:
                self._sums()
                rest &= self.mirrored_pairs >> (self.capacity - gap)
        return None


Pattern = tuple[tuple[tuple[int, int], ...], int]  # (length, copies) of a sequence, and how many sequences


def packing_plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Sequences as patterns with their number: exact complements, then best fit from the longest length down."""
    plan: list[Pattern] = []
    table = Complements(counts, capacity)
    left = table.left
    for length in sorted(counts, reverse=True):
        while left[length] > 0:
            table.take(length, 1)
            filling = table.filling(capacity - length)
            table.take(length, -1)
            if filling is None:
                break
            pattern = Counter((length, *filling))
            times = min(left[x] // k for x, k in pattern.items())
            for x, k in pattern.items():
                table.take(x, times * k)
            plan.append((tuple(pattern.items()), times))

    open_gaps: list[int] = []
    by_gap: dict[int, list[Pattern]] = defaultdict(list)

    def put(gap: int, pattern: tuple[tuple[int, int], ...], times: int) -> None:
        if gap == 0:
            plan.append((pattern, times))
            return
        if not by_gap[gap]:
            insort(open_gaps, gap)
        by_gap[gap].append((pattern, times))

    for length in [x for x in sorted(counts, reverse=True) if left[x]]:
        count = left[length]
        while count:
            at = bisect_left(open_gaps, length)
            if at < len(open_gaps):
                gap = open_gaps[at]
                pattern, times = by_gap[gap].pop()
                if not by_gap[gap]:
                    open_gaps.pop(at)
            else:
                gap, pattern, times = capacity, (), count
            # best fit returns to the same sequence as long as another copy fits
            copies = min(gap // length, count)
            filled = min(times, count // copies)
            if times > filled and pattern:
                put(gap, pattern, times - filled)
            put(gap - copies * length, (*pattern, (length, copies)), filled)
            count -= filled * copies
    for gap in open_gaps:
        plan += by_gap[gap]
    return plan


SLOTS = ("length", "first", "times", "base", "offset")


def slots_of(plan: list[Pattern]) -> dict[str, np.ndarray]:
    """Ranks of each length in order: from ``first`` on they go to ``times`` sequences from ``base`` on, at ``offset``.

    After ``times`` ranks the next copy comes, one length further. A pattern has fewer than sqrt(2 * capacity) different
    lengths, so the table is bounded by the capacity, not by the data.
    """
    rows, base, used = [], 0, defaultdict(int)
    for pattern, times in plan:
        offset = 0
        for length, copies in pattern:
            rows.append((length, used[length], times, base, offset))
            used[length] += times * copies
            offset += length * copies
        base += times
    rows.sort()
    return {name: np.array([row[i] for row in rows], np.int64) for i, name in enumerate(SLOTS)}


def placed(slots: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these lengths and ranks within their length."""
    order = np.lexsort((rank, length))
    at = np.empty(len(order), np.int64)
    keys = np.rec.fromarrays([np.concatenate([slots["length"], length]), np.concatenate([slots["first"], rank])])
    place = np.lexsort((np.arange(len(keys)) >= len(slots["first"]), keys["f1"], keys["f0"]))
    is_slot = place < len(slots["first"])
    current = np.cumsum(is_slot) - 1
    at[place[~is_slot] - len(slots["first"])] = current[~is_slot]
    step = rank - slots["first"][at]
    copy, number = np.divmod(step, slots["times"][at])
    return slots["base"][at] + number, slots["offset"][at] + copy * length


def pack_pieces(pieces: DataFrame, capacity: int = 4096, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Adds sequence_id (from 0) and offset to pieces with a ``length`` from 1 to the capacity.

    ``order`` names columns that tell rows apart; rows that agree in them and in length may change places. Ranks are
    numbered within (length, shard) by many tasks and moved by the counts of earlier shards; the driver only sees the
    counts per length.
    """
    spark = pieces.sparkSession
    shards = partitions(spark)
    rows = written(pieces.withColumn("_shard", F.pmod(F.xxhash64(*order), F.lit(shards)).cast("int")), "pieces")
    counts = written(rows.groupBy("length", "_shard").agg(F.count(F.lit(1)).alias("_n")), "piece-counts")
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    if any(not 0 < length <= capacity for length in by_length):
        raise ValueError(f"piece lengths are from 1 to {capacity}")
    sent = spark.sparkContext.broadcast(slots_of(packing_plan(by_length, capacity)))
    earlier = Window.partitionBy("length").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_shard").orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(inside)).join(offsets, ["length", "_shard"])
    ranked = ranked.select(*pieces.columns, (F.col("_before") + F.col("_rank") - 1).alias("_rank"))
    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "_rank"))
            sequence, offset = placed(sent.value, length, rank)
            columns = [*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return ranked.mapInArrow(run, schema)


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their place: id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Offsets within a sequence are gapless from 0. Null and empty texts are pieces of one token; repeated rows and null ids
    are packed like any other; an empty table gives no rows.
    """
    pieces = pieces_of(documents, tokenizer_path, capacity, end_id, id_col, text_col, with_ids)
    return pack_pieces(pieces, capacity, (id_col, "piece", "ids_crc32"))


def assembled(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: whole sequences of pieces packed with their ids; a sequence has at most the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return grouped.select("sequence_id", ids.alias("ids"))
