"""Byte-level BPE encoding and decoding.

The merges are compiled into a finite-state transducer over bytes that is determinised on demand. BPE gives every prefix
of a piece exactly one encoding, and a token may follow another one exactly when merging the bytes of both never crosses
their border. A state therefore holds, for each position where a token may have begun, the open bytes since then and the
tokens before it that are not emitted yet. What all open positions agree on is emitted, so no decision waits longer than
the longest token. States and transitions are kept as they are met, up to a bound, and then built anew.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, worker_table

#: Bytes that a Python worker keeps in tables of its own, about; a table beyond its share starts anew. The transducer takes
#: half of them, remembered pieces and pairs of tokens a quarter each.
TABLE_BYTES = 512 << 20

#: What Python needs for an entry of a table besides its bytes; code points of a piece that is not worth remembering.
ENTRY_BYTES, LONG_PIECE = 200, 64

#: A rank beyond all others.
NEVER = 1 << 60

#: Every single byte; a single id as it is written.
BYTES, ONE = [bytes([b]) for b in range(256)], struct.Struct("<I").pack

#: Pieces of a text, and tokens, that are handled at once.
BLOCK = 50_000


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


#: A state is the last emitted token, and for each position a token may have begun at the open bytes since then and the
#: tokens before it that are not emitted.
START = (None, ((b"", ()),))


class Transducer:
    def __init__(self, ranks: dict[bytes, int], table_bytes: int = TABLE_BYTES):
        self.max_bytes = table_bytes // 2
        self.max_pairs = table_bytes // 8 // ENTRY_BYTES  # of each of the two tables
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has every single byte")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longer: dict[bytes, list[int]] = {}  # proper prefixes, with the tokens that go on from them
        self.joins: dict[bytes, dict[bytes, int]] = {}  # left part of a token, its right parts, and the token's rank
        for token, rank in ranks.items():
            for n in range(1, len(token)):
                self.longer.setdefault(token[:n], []).append(rank)
                if token[:n] in ranks and token[n:] in ranks:
                    self.joins.setdefault(token[:n], {})[token[n:]] = rank
        self.live: dict[tuple[int | None, bytes], bool] = {}
        self.pairs: dict[int, bool] = {}
        self.left_edges: dict[int, list[tuple[bytes, int]]] = {}
        self.right_edges: dict[int, list[tuple[dict[bytes, int], int]]] = {}
        self._restart()

    def _restart(self) -> None:
        self.states, self.numbers, self.moves, self.bytes = [], {}, [], 0
        self._number(START)

    def _number(self, state: tuple) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            self.bytes += 2 * ENTRY_BYTES + sum(150 + len(seen) + 8 * len(waiting) for seen, waiting in state[1])
        return number

    def _halves(self, token: bytes) -> tuple[bytes, bytes]:
        """The two tokens whose merge is this one: plain merging, lowest rank first, leftmost among equals."""
        parts = [token[i : i + 1] for i in range(len(token))]
        ranks = self.ranks
        while len(parts) > 2:
            i = min(range(len(parts) - 1), key=lambda k: ranks.get(parts[k] + parts[k + 1], NEVER))
            merged = parts[i] + parts[i + 1]
            if merged not in ranks:
                raise ValueError(f"merges never make the token {token!r}")
            parts[i : i + 2] = [merged]
        return parts[0], parts[1]

    def _edge(self, token: bytes, right: bool) -> list[tuple[bytes, int]]:
        """What stands at one end of a token while its bytes are merged, shortest first, with the rank of the merge that
        takes it.
        """
        found = [(token, NEVER)]
        while len(token) > 1:
            inner = self._halves(token)[right]
            found.append((inner, self.ranks[token]))
            token = inner
        return found[::-1]

    def _ends(self, left: int) -> list[tuple[dict[bytes, int], int]]:
        """The right edge of a token, as far as something in it begins another token."""
        found = self.right_edges.get(left)
        if found is None:
            edge = self._edge(self.tokens[left], True)
            found = self.right_edges[left] = [(self.joins[x], taken) for x, taken in edge if x in self.joins]
        return found

    def _fits(self, ends: list[tuple[dict[bytes, int], int]], right: int) -> bool:
        """Whether no merge crosses the border to a right token.

        Ranks of performed merges never decrease, as a merge only makes room for later ones. So a border merge of rank m
        happens if it comes before the merge that takes its left side, and not after the one that takes its right side.
        """
        firsts = self.left_edges.get(right)
        if firsts is None:
            firsts = self.left_edges[right] = self._edge(self.tokens[right], False)
        for joins, x_taken in ends:
            for y, y_taken in firsts:
                m = joins.get(y)
                if m is not None and m < x_taken and m <= y_taken:
                    return False
        return True

    def follows(self, left: int | None, right: int) -> bool:
        """Whether merging the bytes of both tokens never crosses the border between them."""
        if left is None:
            return True
        known = self.pairs.get(left << 32 | right)
        if known is None:
            if len(self.pairs) >= self.max_pairs:
                self.pairs.clear()
            known = self.pairs[left << 32 | right] = self._fits(self._ends(left), right)
        return known

    def alive(self, last: int | None, seen: bytes) -> bool:
        """Whether some token that goes on from the open bytes may follow the last one."""
        longer = self.longer.get(seen)
        if longer is None or last is None:
            return longer is not None
        known = self.live.get((last, seen))
        if known is None:
            if len(self.live) >= self.max_pairs:
                self.live.clear()
            ends, known = self._ends(last), False
            for token in longer:
                if self._fits(ends, token):
                    known = True
                    break
            self.live[last, seen] = known
        return known

    def _move(self, number: int, byte: int) -> tuple[bytes, int]:
        """Builds the transition: what it emits, and the state it leads to."""
        last, places = self.states[number]
        step, left, closed = BYTES[byte], [], None
        for seen, waiting in places:
            now = seen + step
            token = self.ranks.get(now)
            before = waiting[-1] if waiting else last
            if closed is None and token is not None and self.follows(before, token):
                closed = (*waiting, token)
            if self.alive(before, now):
                left.append((now, waiting))
        left.append((b"", closed))
        agreed = left[0][1]
        for _, waiting in left[1:]:
            n = 0
            while n < min(len(agreed), len(waiting)) and agreed[n] == waiting[n]:
                n += 1
            agreed = agreed[:n]
        state = (agreed[-1] if agreed else last, tuple((seen, waiting[len(agreed) :]) for seen, waiting in left))
        move = self.moves[number][byte] = (_packed(agreed), self._number(state))
        return move

    def _end(self, number: int, byte: int) -> bytes:
        """What the last byte of a piece emits: no later byte can change it, so no state comes of it."""
        last, places = self.states[number]
        step, ranks = BYTES[byte], self.ranks
        for seen, waiting in places:
            token = ranks.get(seen + step)
            if token is not None and self.follows(waiting[-1] if waiting else last, token):
                return _packed((*waiting, token)) if waiting else ONE(token)
        raise AssertionError("every prefix of a piece has an encoding")

    def encode_piece(self, piece: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. When the tables are full they start anew, inside a piece too."""
        out, number, moves = [], 0, self.moves
        for byte in piece[:-1]:
            move = moves[number].get(byte)
            if move is None:
                if self.bytes > self.max_bytes:
                    state = self.states[number]
                    self._restart()
                    number, moves = self._number(state), self.moves
                move = self._move(number, byte)
            emitted, number = move
            if emitted:
                out.append(emitted)
        if not out:
            return self._end(number, piece[-1]) if piece else b""
        out.append(self._end(number, piece[-1]))
        return b"".join(out)


def _packed(ids: tuple[int, ...]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder(dict):
    """Text to ids: each match of the pattern on its own; seen pieces are remembered up to a bound in bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, table_bytes: int = TABLE_BYTES):
        import regex

        super().__init__()
        self.pattern, self.transducer = regex.compile(pattern), Transducer(ranks, table_bytes)
        self.bytes, self.max_bytes = 0, table_bytes // 4

    def __missing__(self, piece: str) -> bytes:
        found = self.transducer.encode_piece(piece.encode())
        if len(piece) <= LONG_PIECE:
            if self.bytes > self.max_bytes:
                self.clear()
                self.bytes = 0
            self[piece] = found
            self.bytes += ENTRY_BYTES + len(piece) + len(found)
        return found

    def encode(self, text: str) -> bytes:
        if len(text) < BLOCK:
            return b"".join(map(self.__getitem__, self.pattern.findall(text)))
        matches, out = self.pattern.finditer(text), []
        while block := [self[m[0]] for m in islice(matches, BLOCK)]:
            out.append(b"".join(block))
        return b"".join(out)


class Utf8Stream:
    """Incremental UTF-8 decoding: the only state is a sequence that has begun and lacks bytes."""

    def __init__(self, errors: str = "replace"):
        self.errors, self.begun = errors, b""

    @staticmethod
    def _complete(data: bytes) -> int:
        """How many bytes end before a sequence that may still go on."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:  # a lead byte, or ASCII
                need = 2 if byte & 0xE0 == 0xC0 else 3 if byte & 0xF0 == 0xE0 else 4 if byte & 0xF8 == 0xF0 else 1
                return len(data) - back if need > back else len(data)
        return len(data)

    def feed(self, data: bytes) -> str:
        data = self.begun + data
        n = self._complete(data)
        self.begun = data[n:]
        return data[:n].decode(errors=self.errors)

    def close(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode(errors=self.errors)


def decode_stream(packed: bytes, tokens: dict[int, bytes], block: int = BLOCK) -> Iterator[str]:
    """Ids back to text, a block of tokens at a time; a character may span blocks."""
    stream = Utf8Stream()
    for at in range(0, len(packed), 4 * block):
        part = packed[at : at + 4 * block]
        yield stream.feed(b"".join(map(tokens.__getitem__, struct.unpack(f"<{len(part) // 4}I", part))))
    yield stream.close()


def encoder_of(content: bytes, pattern: str, table_bytes: int) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = "byte_bpe", hashlib.sha256(content).hexdigest(), pattern, table_bytes
    return worker_table(key, lambda: Encoder(read_ranks(content), pattern, table_bytes))


def encode_documents(
    documents: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256; with_ids adds ids (binary, little-endian uint32).

    ``table_bytes`` bounds what a worker remembers besides the vocabulary, about; less costs time, never a result.

    The vocabulary file is read by the driver (its size does not depend on the data) and sent to the workers. Null text is
    empty; ids and repeated rows are passed on as they are; an empty table gives no rows.
    """
    ship(documents.sparkSession)
    with open(ranks_path, "rb") as file:
        sent = documents.sparkSession.sparkContext.broadcast(file.read())
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    id_type = documents.schema[id_col].dataType
    kinds = [T.LongType(), T.StringType(), T.StringType(), T.BinaryType()]
    schema = T.StructType([T.StructField(id_col, id_type)] + [T.StructField(n, k) for n, k in zip(names, kinds, strict=False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(sent.value, pattern, table_bytes)
        tokens = encoder.transducer.tokens
        for batch in batches:
            rows = []
            for text in batch.column(1):
                packed = encoder.encode(text.as_py() or "")
                back = hashlib.sha256()
                for piece in decode_stream(packed, tokens):
                    back.update(piece.encode())
                row = (len(packed) // 4, hashlib.sha256(packed).hexdigest(), back.hexdigest())
                rows.append((*row, packed) if with_ids else row)
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            types = [pa.int64(), pa.string(), pa.string(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, types, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[id_col, *names])

    return documents.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
