"""Fill-in-middle transformation over a compressed set of code point boundaries.

The byte offsets at which the code points of a text begin, and its end, are kept as a Roaring-style set: containers of
65,536 offsets, each an array, a bitmap or runs, whichever is smallest (plain ASCII is one run), with the cumulative
cardinalities of the containers. A cut after k code points is the k-th offset: its container is searched for in the
cardinalities and the offset selected inside. Texts are cut as UTF-8 bytes and never decoded.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

#: Offsets of a container, and the bytes of its bitmap.
CONTAINER, BITMAP_BYTES = 1 << 16, 1 << 13


class Array:
    """Sorted offsets, two bytes each."""

    def __init__(self, mask: np.ndarray):
        self.values = np.flatnonzero(mask).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.values[k])


class Runs:
    """Begin of every run of consecutive offsets, and the offsets in earlier runs."""

    def __init__(self, mask: np.ndarray, begins: np.ndarray):
        ends = np.flatnonzero(mask & ~np.append(mask[1:], False))
        self.begins = begins.astype(np.uint16)
        self.before = (np.cumsum(ends - begins + 1) - (ends - begins + 1)).astype(np.uint32)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.begins[run]) + k - int(self.before[run])


class Bitmap:
    """One bit per offset, in words of 64 bits, with the bits set in earlier words."""

    def __init__(self, mask: np.ndarray):
        packed = np.zeros(BITMAP_BYTES, np.uint8)
        packed[: -(-len(mask) // 8)] = np.packbits(mask, bitorder="little")
        self.words = packed.view("<u8")
        counts = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.cumsum(counts, dtype=np.uint32) - counts

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - int(self.before[word])])


def container_of(mask: np.ndarray) -> Array | Runs | Bitmap:
    begins = np.flatnonzero(mask & ~np.concatenate([[False], mask[:-1]]))
    cost = {Runs: 4 * len(begins), Array: 2 * int(np.count_nonzero(mask)), Bitmap: BITMAP_BYTES}
    kind = min(cost, key=cost.get)
    return Runs(mask, begins) if kind is Runs else kind(mask)


class BoundarySet:
    """The byte offsets of all code point boundaries of a UTF-8 text, its end included."""

    def __init__(self, text: bytes):
        data = np.frombuffer(text, np.uint8)
        self.containers, self.cardinalities, total = [], [], 0
        for base in range(0, len(data) + 1, CONTAINER):
            part = data[base : base + CONTAINER]
            mask = (part & 0xC0) != 0x80
            if len(part) < CONTAINER:
                mask = np.append(mask, True)  # the end of the text
            self.containers.append(container_of(mask))
            total += int(np.count_nonzero(mask))
            self.cardinalities.append(total)

    def __len__(self) -> int:
        return self.cardinalities[-1]

    def select(self, k: int) -> int:
        """The offset after k code points."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = bisect_right(self.cardinalities, k)
        before = self.cardinalities[at - 1] if at else 0
        return at * CONTAINER + self.containers[at].select(k - before)


@dataclass(frozen=True)
class Infill:
    """Markers, shares and seed of the transformation. Markers differ and none can overlap itself or another."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: str = "1"
    infilled_percent: int = 90
    spm_percent: int = 20

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        if len(set(marks)) < 3 or not all(len(m) > 2 and m[0] == "<" and m[-1] == ">" and m.count("<") == m.count(">") == 1 for m in marks):
            raise ValueError(f"three different markers of the form <...> are needed: {marks}")

    def drawn(self, ident) -> tuple[int, int, int, int]:
        """Four numbers that depend on the id alone; a null id counts as an empty string."""
        digest = hashlib.sha256(f"{self.seed}:{'' if ident is None else ident}".encode()).hexdigest()
        return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))


def transformed(text: bytes, ident, rule: Infill = Infill()) -> tuple[int, str, int | None, int | None, bytes]:
    """Code points, form, code points of prefix and of middle (None if plain), output."""
    p, s, m = rule.prefix.encode(), rule.suffix.encode(), rule.middle.encode()
    boundaries = BoundarySet(text)
    n = len(boundaries) - 1
    h1, h2, h3, h4 = rule.drawn(ident)
    if not text or p in text or s in text or m in text or h3 % 100 >= rule.infilled_percent:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    i, j = boundaries.select(a), boundaries.select(b)
    if h4 % 100 < rule.spm_percent:
        return n, "spm", a, b - a, b"".join([s, text[j:], p, text[:i], m, text[i:j]])
    return n, "psm", a, b - a, b"".join([p, text[:i], s, text[j:], m, text[i:j]])


def restored(output: bytes, form: str, rule: Infill = Infill()) -> bytes:
    """The text, from output and form alone: infilled texts hold no marker, so each is found where it was put."""
    if form == "plain":
        return output
    p, s, m = rule.prefix.encode(), rule.suffix.encode(), rule.middle.encode()
    first, second = (s, p) if form == "spm" else (p, s)
    head, _, rest = output[len(first) :].partition(second)
    tail, _, middle = rest.partition(m)
    prefix, suffix = (tail, head) if form == "spm" else (head, tail)
    return prefix + middle + suffix


def fill_in_middle(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Infill = Infill(), with_output: bool = False
) -> DataFrame:
    """Per row: id, n (code points), form (plain, psm or spm), prefix_chars, middle_chars, output_sha256, restored_sha256.

    ``with_output`` adds the output itself. Null text is empty and plain; the cuts depend on id and length only, so
    repeated rows give repeated results; a null id draws its cuts as an empty one. No shuffle, one pass, memory for one
    text. An empty table gives no rows.
    """
    ship(documents.sparkSession)
    names = ["n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"] + ["output"] * with_output
    kinds = [T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType(), T.StringType(), T.StringType()]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    id_field = T.StructField(id_col, documents.schema[id_col].dataType)
    schema = T.StructType([id_field] + [T.StructField(n, k) for n, k in zip(names, kinds, strict=False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                n, form, prefix, middle, output = transformed(text.as_py() or b"", ident, rule)
                back = restored(output, form, rule)
                row = (n, form, prefix, middle, hashlib.sha256(output).hexdigest(), hashlib.sha256(back).hexdigest())
                rows.append((*row, output) if with_output else row)
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            arrays = [pa.array(c, pa.binary() if n == "output" else k).cast(k) for n, c, k in zip(names, columns, types, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[id_col, *names])

    return documents.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
