"""Phrase collocation mining by marginalising the counts of the longest windows.

Only the longest windows are counted: every word begins one, made of it and its next words (the lead columns), padded where
its piece of text ends. One ROLLUP over the window's columns sums them to the counts of all shorter phrases and of all words
of a language, so no n-gram but the longest is ever made.

A window is also padded behind its first rare pair or triple of words: no phrase across it can be frequent. Pairs, then
triples of frequent pairs, are counted by chunks of documents and hash buckets (chunks.py); equal hashes only make them
look more frequent, so this loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunks import CHUNK_BYTES, answered, bits, packed_bits, rows_by_bucket, squeezed, unsqueezed
from .common import partitions, ship, written
from .substring_dedup import LOW, block_keys, chosen, has
from .words import MULTIPLIER, mixed, word_hashes

#: Pairs that meet in one bucket, about.
BUCKET_PAIRS = 2_000_000

#: Characters that end a piece, and what every byte becomes: A-Z lower-cased, ends of pieces a line feed, tabs blanks.
ENDS = b".,;:!?\n\x0b\x0c\r"
BYTES = bytes.maketrans(bytes(range(65, 91)) + ENDS + b"\t", bytes(range(97, 123)) + b"\n" * len(ENDS) + b" ")


def chunked(documents: DataFrame, lang_col: str, text_col: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Texts of a language, ready to be split, in chunks: chunk, lang, size, blob. Null languages are ``und``.

    Texts are joined by an end of piece; longer ones than a chunk are cut at one.
    """

    def parts(text: bytes) -> Iterator[bytes]:
        at = 0
        while len(text) - at > chunk_bytes:
            cut = text.rfind(b"\n", at, at + chunk_bytes)
            cut = cut if cut > at else text.find(b"\n", at + chunk_bytes)
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held, total = {}, 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held, total
            blobs = {lang: b"\n".join(texts) for lang, texts in held.items()}
            columns = [
                pa.array(range(number, number + len(blobs)), pa.int64()),
                pa.array(list(blobs), pa.string()),
                pa.array([len(b) for b in blobs.values()], pa.int64()),
                pa.array([squeezed(b) for b in blobs.values()], pa.binary()),
            ]
            number, held, total = number + len(blobs), {}, 0
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "lang", "size", "blob"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                for part in parts((text.as_py() or b"").translate(BYTES)):
                    if held and total + len(part) > chunk_bytes:
                        yield flush()
                    held.setdefault(lang, []).append(part)
                    total += len(part)
        if held:
            yield flush()

    ship(documents.sparkSession)
    rows = documents.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(run, "chunk long, lang string, size long, blob binary"), "phrase-chunks", codec="none")


class Pieces:
    """The words of a chunk in a row, numbered; -1 stands between pieces."""

    def __init__(self, lang: str, blob: bytes):
        tokens = [w for w in unsqueezed(blob).replace(b"\n", b" \n ").split(b" ") if w]
        self.vocabulary = list(dict.fromkeys(tokens))
        number = {word: i for i, word in enumerate(self.vocabulary)}
        number[b"\n"] = -1
        self.ids = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
        self.hashes = word_hashes(self.vocabulary)
        self.seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))

    def runs(self, size: int, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every run of so many words within a piece; ``inside`` tells where shorter runs go on."""
        ids, count = self.ids, max(0, len(self.ids) - size + 1)
        fits = np.ones(count, bool) if inside is None else inside[:count] & inside[1 : count + 1]
        for k in range(size):
            fits &= ids[k : k + count] >= 0
        start = np.flatnonzero(fits)
        found = np.full(len(start), np.uint64(size))
        for k in range(size):
            found = found * MULTIPLIER + self.hashes[ids[start + k]]
        return start, mixed(found ^ self.seed)

    def marked(self, start: np.ndarray, often: np.ndarray) -> np.ndarray:
        """For every word whether a frequent run starts there."""
        marks = np.zeros(len(self.ids) + 4, bool)
        marks[start[often]] = True
        return marks

    def windows(self, pairs: np.ndarray, triples: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct windows as rows of word numbers, -1 for padding, and how often each occurs.

        A window goes on while its pairs and triples are frequent.
        """
        begin = np.flatnonzero(self.ids >= 0)
        columns, goes_on = [self.ids[begin]], np.ones(len(begin), bool)
        padded, on = np.append(self.ids, np.full(width, -1)), np.append(pairs, np.zeros(width, bool))
        further = np.append(triples, np.zeros(width, bool))
        for k in range(1, width):
            goes_on &= on[begin + k - 1]
            if k > 1:
                goes_on &= further[begin + k - 2]
            columns.append(np.where(goes_on, padded[begin + k], -1))
        # two columns at a time are renumbered, so that codes never leave 64 bits
        code = columns[-1] + 1
        for column in columns[-2::-1]:
            _, code = np.unique(code, return_inverse=True)
            code = (column + 1) * (len(code) + 1) + code
        _, at, counts = np.unique(code, return_index=True, return_counts=True)
        return np.stack([column[at] for column in columns], axis=1), counts


def frequency_answer(min_count: int):
    """For (bucket, chunk, values, counts): which values occur often enough over all chunks."""

    def answer(rows: list[tuple]) -> list[bytes]:
        sets = [np.frombuffer(row[2], np.uint32) for row in rows]
        counts = np.concatenate([np.frombuffer(unsqueezed(row[3]), np.uint32) for row in rows])
        _, place = np.unique(np.concatenate(sets), return_inverse=True)
        often = np.bincount(place, counts) >= min_count
        return [packed_bits(part) for part in np.split(often[place], np.cumsum([len(s) for s in sets])[:-1])]

    return answer


def window_counts(
    documents: DataFrame, min_count: int, width: int, lang_col: str = "lang", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """lang, w1 to w<width> (null where padded) and how often: one window for every word of the corpus."""
    chunks = chunked(documents, lang_col, text_col, chunk_bytes)
    total = chunks.agg(F.sum("size")).first()[0] or 0
    buckets = max(16, -(-total // (7 * BUCKET_PAIRS)))
    names = [f"w{k + 1}" for k in range(width)]
    texts = chunks.select("chunk", "lang", "blob")

    def often(hashes: np.ndarray, answers: list[dict] | None) -> np.ndarray:
        keys = block_keys(hashes, buckets)
        values = np.unique(keys)
        return has(chosen(values, values >> np.uint64(32), answers), keys)

    def frequent_pairs(pieces: Pieces, row: dict) -> np.ndarray:
        start, hashes = pieces.runs(2)
        return pieces.marked(start, often(hashes, row["pairs"]))

    def asking(hashes_of: Callable[[Pieces, dict], np.ndarray]):
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            columns, kinds = ["bucket", "chunk", "values", "counts"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            for batch in batches:
                for row in batch.to_pylist():
                    hashes = hashes_of(Pieces(row["lang"], row["blob"]), row)
                    values, counts = np.unique(block_keys(hashes, buckets), return_counts=True)
                    given = [(values & LOW).astype(np.uint32), np.minimum(counts, min_count).astype(np.uint32)]
                    encode = [np.ndarray.tobytes, lambda c: squeezed(c.tobytes())]
                    rows = list(rows_by_bucket(row["chunk"], values >> np.uint64(32), given, encode))
                    lists = list(zip(*rows, strict=True)) or [()] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(lists, kinds, strict=True)], names=columns)

        return ask

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pieces = Pieces(row["lang"], row["blob"])
                pairs = frequent_pairs(pieces, row)
                start, hashes = pieces.runs(3, pairs)
                found, counts = pieces.windows(pairs, pieces.marked(start, often(hashes, row["triples"])), width)
                vocabulary = pa.array(pieces.vocabulary, pa.binary()).cast(pa.string())
                words = [vocabulary.take(pa.array(c, pa.int64(), mask=c < 0)) for c in found.T]
                lang = pa.array([row["lang"]] * len(counts), pa.string())
                table = pa.RecordBatch.from_arrays([lang, *words, pa.array(counts, pa.int64())], names=["lang", *names, "n"])
                for at in range(0, len(counts), 50_000):
                    yield table.slice(at, 50_000)

    questions = "bucket int, chunk long, values binary, counts binary"
    answer = frequency_answer(min_count)
    pairs = answered(texts.mapInArrow(asking(lambda pieces, row: pieces.runs(2)[1]), questions), answer)
    known = texts.join(pairs.withColumnRenamed("answers", "pairs"), "chunk", "left")
    third = asking(lambda pieces, row: pieces.runs(3, frequent_pairs(pieces, row))[1])
    triples = answered(known.mapInArrow(third, questions), answer)
    known = known.join(triples.withColumnRenamed("answers", "triples"), "chunk", "left")
    counted = known.mapInArrow(count, "lang string, " + ", ".join(f"{n} string" for n in names) + ", n long")
    return written(counted.groupBy("lang", *names).agg(F.sum("n").alias("n")), "windows")


def phrase_counts(windows: DataFrame, min_count: int, width: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all phrases of up to ``width`` words with f >= min_count, and (lang, n) of all words."""
    names = [f"w{k + 1}" for k in range(width)]
    # a rare longest window is no phrase: only its prefixes count
    longest = F.when(F.col("n") >= min_count, F.col(names[-1])).alias(names[-1])
    summed = windows.select("lang", *names[:-1], longest, "n").rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    k = F.lit(width) - F.floor(F.log2(F.col("rolled") + 1)).cast("int")  # words that are not summed over
    last = F.element_at(F.array(*names), F.greatest(F.col("k"), F.lit(1)))
    leveled = summed.withColumn("k", k).filter("k >= 0").withColumn("last", last)
    kept = leveled.filter((F.col("k") == 0) | (F.col("last").isNotNull() & (F.col("f") >= min_count)))
    kept = written(kept.select("lang", F.concat_ws(" ", *names).alias("phrase"), "k", "f"), "phrases")
    return kept.filter("k > 0"), kept.filter("k = 0").select("lang", F.col("f").alias("n"))


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def _run(words: str, first, size) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def collocations(
    documents: DataFrame,
    min_count: int = 30,
    width: int = 4,
    top: int = 2000,
    percent: int = 80,
    factor: int = 2_000_000,
    lang_col: str = "lang",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The best ``top`` phrases of 2 to ``width`` words of every language: lang, rank, phrase, a, l, r, n, score.

    A cut of a phrase scores floor(factor * a / (l + r)) from the counts of the phrase and both its parts; the lowest cut
    counts, the smallest first part among equals. Phrases inside a longer frequent one that has at least ``percent`` of
    their count are left out. Null languages are ``und``, null texts empty; repeated rows count as often as they are
    there; languages without a frequent phrase, and empty tables, give no rows. A text without any end of piece is handled
    by one task.
    """
    phrases, totals = phrase_counts(window_counts(documents, min_count, width, lang_col, text_col, chunk_bytes), min_count, width)
    candidates = phrases.filter("k > 1").withColumn("words", F.split("phrase", " "))
    one = F.lit(1)

    # phrases inside longer ones, with the largest count of those
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("k") - 1),
            lambda size: F.transform(F.sequence(one, F.col("k") - size + 1), lambda at: _run("words", at, size)),
        )
    )
    longer = candidates.filter("k > 2").select("lang", F.explode(inner).alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("outer"))
    free = candidates.join(longer, ["lang", "phrase"], "left")
    covered = _wide("outer") * 100 >= _wide("f") * percent
    free = free.filter(~F.coalesce(covered, F.lit(False)))

    # every cut once; its parts are frequent, so they are in the table
    cuts = free.select(
        "lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(one, F.col("k") - 1)).alias("cut"), "words", "k"
    ).select("lang", "phrase", "a", "cut", _run("words", one, F.col("cut")).alias("head"), _run("words", F.col("cut") + 1, F.col("k")).alias("tail"))
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    cuts = cuts.withColumn("score", F.expr(f"cast(({factor} * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r) as bigint)"))
    best = cuts.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("best")
    )
    scored = best.select("lang", "phrase", "a", "best.*")

    # the best of every shard first, so that no task sorts a whole language
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    shard = F.pmod(F.xxhash64("phrase"), F.lit(partitions(documents.sparkSession)))
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", shard).orderBy(*order))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
