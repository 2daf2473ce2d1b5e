"""Toxicity of documents behind a noisy channel.

Writers hide words by leetspeak, spacing and repetition. Every token with a doubled letter or anything but letters becomes a
lattice of the characters it may stand for, each with a channel cost, and Viterbi decoding under a character trigram model
finds the likeliest restoration.
The trigram model is counted over all documents. A linear model over hashed features of the restored words (the word and
its first four to six letters) scores the text; it is fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let_go, ship


# Symbols of the character model: a-z, any other letter, anything else (the border of words).
OTHER, SPACE, SYMBOLS = 26, 27, 28

#: What a character may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}

#: Channel costs (negative log probabilities): a substitution, a character that stands for itself though it is no letter,
#: a dropped separator, a dropped repeat in a run of two and in a longer one, a kept space between single letters.
SUBSTITUTED, LITERAL, SEPARATED, DOUBLED, REPEATED, KEPT_SPACE = 0.7, 6.0, 0.5, 5.0, 0.2, 1.0

EDGES = ".,;:?!\"'()[]{}<>%*&#~^=/\\|`…«»“”‘’-_"
SEPARATORS = frozenset(".-_*'/~^")
#: Edges that cannot be letters.
CLOSED = "".join(c for c in EDGES if c not in LEET)
SPACED = re.compile(r"(?:(?<=\s)|^)(?:\S\s++){2,}\S(?=\s|$)")
WIDE = re.compile(r"\s{2,}")
RUN = re.compile(r"(.)\1{2,}")
TWICE = re.compile(r"(.)\1")
PREFIXES = (4, 5, 6)

#: Tokens whose features a worker remembers.
MAX_TOKENS = 200_000


def _symbol(char: str) -> int:
    return ord(char) - 97 if "a" <= char <= "z" else OTHER if char.isalpha() else SPACE


def _byte_symbols() -> np.ndarray:
    table = np.full(256, SPACE, np.int64)
    table[97:123] = table[65:91] = np.arange(26)
    table[128:] = OTHER
    return table


def character_counts(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """Trigram counts of all texts: gram (one of 28**3), n. Every task sends its totals once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        table, totals = _byte_symbols(), np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for text in batch.column(0):
                data = (text.as_py() or "").encode()
                for at in range(0, len(data), 1 << 22):  # two bytes more, so that no trigram is lost between blocks
                    s = table[np.frombuffer(data, np.uint8)[at : at + (1 << 22) + 2]]
                    if len(s) > 2:
                        totals += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(totals[seen])], names=["gram", "n"])

    ship(documents.sparkSession)
    counts = documents.select(text_col).mapInArrow(count, "gram long, n long")
    return counts.groupBy("gram").agg(F.sum("n").alias("n"))


def character_costs(counts: DataFrame) -> np.ndarray:
    """Negative log probabilities [before, last, next], smoothed by the lower orders. At most 28**3 rows are fetched."""
    n = np.zeros(SYMBOLS**3)
    for gram, k in counts.collect():
        n[gram] = k
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    one = (n.sum((0, 1)) + 1) / (n.sum() + SYMBOLS)
    two = n.sum(0) + 5 * one
    two /= two.sum(1, keepdims=True)
    three = n + 5 * two[None]
    return -np.log(three / three.sum(2, keepdims=True))


class Restorer:
    """Viterbi decoding of one token, or of a run of single characters with spaces between them."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()

    @staticmethod
    def lattice(token: str, doubled: bool = True) -> list[list[tuple[str, float]]]:
        """For each character what it may be, "" for nothing, and the channel cost. Runs of two stay without doubled."""
        token = RUN.sub(lambda m: m[1] * 3, token)
        columns = []
        solid, i = "".join(token.split()), -1  # a letter may be repeated across blanks
        for char in token:
            if char.isspace():
                columns.append([("", 0.0), (" ", KEPT_SPACE)])
                continue
            i += 1
            options = [(char, 0.0 if char.isalpha() else LITERAL)]
            options += [(letter, SUBSTITUTED) for letter in LEET.get(char, "")]
            if char in SEPARATORS:
                options.append(("", SEPARATED))
            if i and solid[i - 1] == char:
                long_run = solid[i - 2 : i - 1] == char or solid[i + 1 : i + 2] == char
                options += [("", REPEATED if long_run else DOUBLED)] * (long_run or doubled)
            columns.append(options)
        return columns

    def restore(self, token: str, doubled: bool = True) -> str:
        costs, paths = self.costs, {(SPACE, SPACE): (0.0, None)}  # state: two symbols; path: linked from the end
        for options in self.lattice(token, doubled):
            reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, path) in paths.items():
                for char, price in options:
                    if char:
                        c = _symbol(char)
                        state, total, step = (b, c), cost + price + costs[a][b][c], (char, path)
                    else:
                        state, total, step = (a, b), cost + price, path
                    if state not in reached or total < reached[state][0]:
                        reached[state] = (total, step)
            paths = reached
        _, path = min(
            ((cost + costs[a][b][SPACE], path) for (a, b), (cost, path) in paths.items()), key=lambda end: end[0]
        )
        out = []
        while path:
            out.append(path[0])
            path = path[1]
        return "".join(reversed(out))


def _hashed(feature: str) -> int:
    return crc32(feature.encode())


def word_features(word: str) -> list[int]:
    return [_hashed(word)] + [_hashed(word[:k] + "*") for k in PREFIXES if len(word) > k]


def undoubled(word: str) -> Iterator[str]:
    """The word without one of its doubled letters, and without all. One by one: a long token has many."""
    at = [twice.start() for twice in TWICE.finditer(word)]
    for i in at:
        yield word[:i] + word[i + 1 :]
    if len(at) > 1:
        yield TWICE.sub(r"\1", word)


class Features(dict):
    """Token to its hashed features, of which only those in ``wanted`` count if given; remembered up to a bound.

    With ``wanted`` a word with a doubled letter also has the features of that word without it, however likely it is.
    """

    def __init__(self, costs: np.ndarray, wanted: dict[int, float] | None = None):
        super().__init__()
        self.restorer, self.wanted = Restorer(costs), wanted

    def _decoded(self, form: str) -> set[str]:
        """The likeliest restoration, and that with all runs of two: a doubled letter may belong to the word or hide it."""
        if not any(c.isalpha() or c in LEET for c in form):
            return set()
        twice = TWICE.search(form)
        if not twice and form.isalpha():
            return {form}
        words = set(self.restorer.restore(form).split())
        if twice and form.isalpha() and not RUN.search(form):
            words.add(form)
        elif twice:
            words.update(self.restorer.restore(form, doubled=False).split())
        return {w.strip(EDGES) for w in words}

    def _words(self, token: str) -> set[str]:
        bare, open_ended = token.strip(EDGES), token.strip(CLOSED)  # ! and | and ( at an edge may be letters
        words = self._decoded(bare)
        return words if open_ended == bare else words | self._decoded(open_ended)

    def _kept(self, words: set[str]) -> tuple[int, ...]:
        if self.wanted is None:
            return tuple(f for w in words if w for f in word_features(w))
        forms = (form for w in words if w for form in chain((w,), undoubled(w)))
        return tuple(f for form in forms for f in word_features(form) if f in self.wanted)

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= MAX_TOKENS:
            self.clear()
        found = self[token] = self._kept(self._words(token))
        return found

    def of(self, text: str) -> set[int]:
        """Features that a text has, each once."""
        text = text.lower()
        found: set[int] = set()
        for token in set(text.split()):
            if known := self[token]:
                found.update(known)
        for spaced in SPACED.finditer(text):
            words = self._decoded(" ".join(spaced[0].split()))
            for part in {spaced[0], *WIDE.split(spaced[0])}:  # one word, or words between wider gaps
                words |= self._decoded("".join(part.split()).strip(EDGES))
            found.update(self._kept(words))
        return found


def fit_weights(
    features: list[np.ndarray], labels: np.ndarray, min_docs: int, min_z: float, max_features: int, min_lift: float
):
    """(features, weights, bias): features whose share among toxic texts is clearly higher, then logistic regression."""
    n_toxic, n_clean = int(labels.sum()), int((1 - labels).sum())
    nothing = np.array([], np.int64), np.array([]), -3.0 if not n_toxic else 0.0 if n_clean else 3.0
    if not n_toxic or not n_clean:
        return nothing
    flat = np.concatenate(features) if features else np.array([], np.int64)
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    names, place = np.unique(flat, return_inverse=True)
    toxic = np.bincount(place, labels[row], len(names))
    clean = np.bincount(place, 1 - labels[row], len(names))
    share = (toxic + clean) / (n_toxic + n_clean)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n_toxic + 1 / n_clean))
    z = (toxic / n_toxic - clean / n_clean) / spread
    lift = (toxic / n_toxic) / ((clean + 0.5) / n_clean)
    chosen = np.flatnonzero((toxic + clean >= min_docs) & (z > min_z) & (lift > min_lift))
    chosen = np.sort(chosen[np.argsort(-z[chosen], kind="stable")][:max_features])
    at = np.full(len(names), -1)
    at[chosen] = np.arange(len(chosen))
    use = at[place] >= 0
    rows, cols = row[use], at[place[use]]
    weights, bias, rate = np.zeros(len(chosen)), 0.0, 4.0
    balance = np.where(labels == 1, 0.5 / n_toxic, 0.5 / n_clean)
    scale = np.sqrt(np.maximum(np.bincount(cols, balance[rows], len(chosen)), 1e-4))  # steps suit rare features too
    for _ in range(400):
        margin = np.bincount(rows, weights[cols], len(labels)) + bias
        gap = balance * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels)
        weights -= rate * (np.bincount(cols, gap[rows], len(chosen)) + 1e-4 * weights) / scale / np.sqrt(1 + len(chosen) / 50)
        bias -= rate * gap.sum()
    return names[chosen], weights, float(bias)


@dataclass(frozen=True)
class ToxicityModel:
    costs: np.ndarray
    weights: dict[int, float] = field(default_factory=dict)
    bias: float = 0.0


def held_out(id_col: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text is divisible by 5. A null id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_per_class: int = 4000,
    min_docs: int = 3,
    min_z: float = 4.0,
    max_features: int = 4096,
    min_lift: float = 8.0,
) -> ToxicityModel:
    """Character model from all documents, weights from labelled ones that are not held out.

    Of each class the ``max_per_class`` labelled ids with the smallest hash are used; this bounds the single task that
    fits. Null labels and ids are ignored. Without labels of both classes, or without documents, every score is the same.

    A feature counts if its share among toxic texts is more than ``min_lift`` times that among others: long texts, toxic
    or not, share words. With labels of which a share e of the clean ones is wrong, the lift of a toxic word is at most
    1 / e, so ``min_lift`` must be smaller than that: 8 suits up to a tenth, 2 up to a third.
    """
    costs = character_costs(character_counts(documents, text_col))
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    usable = usable.filter(F.col("label").isin(0, 1) & ~held_out(F.col("id"))).withColumn("order", F.xxhash64("id"))
    picked = None
    for label in (0, 1):
        part = usable.filter(F.col("label") == label).orderBy("order", "id").limit(max_per_class)
        picked = part if picked is None else picked.unionByName(part)
    # at most 2 * max_per_class ids
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked.select("id", "label")), "id"
    )
    sent = documents.sparkSession.sparkContext.broadcast(costs)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features(sent.value)
        for batch in batches:
            found = [sorted(known.of(text.as_py() or "")) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["label"], pa.array(found, pa.list_(pa.int64()))], names=["label", "features"]
            )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, seen = [], []
        for batch in batches:
            lists = batch["features"]
            flat, ends = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            features += np.split(flat, np.cumsum(ends)[:-1]) if len(ends) else []
            seen += batch["label"].to_pylist()
        names, weights, bias = fit_weights(features, np.array(seen, float), min_docs, min_z, max_features, min_lift)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*names.tolist(), -1], pa.int64()), pa.array([*weights.tolist(), bias], pa.float64())],
            names=["feature", "weight"],
        )

    sample = rows.mapInArrow(featured, "label int, features array<long>").repartition(1).sortWithinPartitions("label", "features")
    found = dict(map(tuple, sample.mapInArrow(fitted, "feature long, weight double").collect()))
    bias = found.pop(-1, -3.0)
    return ToxicityModel(costs, found, bias)


def score_toxicity(documents: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The input rows with a score from 0 to 1 after their columns; null text is empty and scored by the bias alone."""
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*documents.schema.fields, T.StructField(score_col, T.DoubleType())])
    place = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        model = sent.value
        known = Features(model.costs, model.weights)
        for batch in batches:
            scores = []
            for text in batch.column(place):
                margin = model.bias + sum(model.weights[f] for f in sorted(known.of(text.as_py() or "")))
                scores.append(1 / (1 + np.exp(-min(30.0, max(-30.0, margin)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=schema.names)

    return documents.mapInArrow(run, schema)
