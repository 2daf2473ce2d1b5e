"""Quality scores from weak labels.

Several rough heuristics vote good, bad or nothing on a document. Expectation-maximisation over the vote patterns of all
documents estimates how accurate each of them is and how likely each pattern is good; these posterior labels train a linear
scorer over hashed token shapes. No label is read.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

#: Hash buckets of the scorer's features.
BUCKETS = 4096

MAX_TOKENS = 400_000

#: Very common function words of the four languages.
COMMON = frozenset(
    "the of and to in is that was for on with are be as at an der die und in von zu das ist den mit ein eine "
    "le la les de des et un une est dans que pour du el los las y en por una con se del al".split()
)

BAD, NONE, GOOD = 0, 1, 2

#: Share of the document at which a heuristic votes, and the words it needs: (name, bad if above, good if below, words).
#: Most only know a fault.
HEURISTICS = (
    ("repeated neighbours", 0.20, -1.0, 4),
    ("symbols", 0.10, -1.0, 18),
    ("upper case", 0.35, -1.0, 4),
    ("few common words", 0.97, 0.90, 18),
    ("table cells", 0.10, -1.0, 4),
    ("odd word ends", 0.45, 0.25, 18),
    ("few distinct words", 0.80, -1.0, 18),
)


class Shapes(dict):
    """Token to bucket of its shape and, as bit 20, 21 and 22, whether it is common, a bare symbol or ends in a symbol."""

    def __missing__(self, token: str) -> int:
        if len(self) >= MAX_TOKENS:
            self.clear()
        shape = re.sub(r"(.)\1+", r"\1", "".join("X" if c.isupper() else "x" if c.isalpha() else "d" if c.isdigit() else c for c in token))
        bare = not any(map(str.isalnum, token))
        value = crc32(shape.encode()) % (BUCKETS - 1)
        value |= (token.lower().strip(".,") in COMMON) << 20 | bare << 21 | (not token[-1].isalnum()) << 22
        self[token] = value
        return value


def shares(text: str, shapes: Shapes) -> tuple[np.ndarray, np.ndarray, int]:
    """The heuristics' shares, the scorer's features (share of tokens by bucket), and the number of words."""
    tokens = text.split()
    n = len(tokens)
    codes = np.fromiter(map(shapes.__getitem__, tokens), np.int64, n)
    same = sum(map(operator.eq, tokens, tokens[1:]))
    counts = np.bincount(codes & 0xFFFFF, minlength=BUCKETS).astype(np.float64)
    counts[BUCKETS - 1] = same
    bytes_seen = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    upper, lower = bytes_seen[65:91].sum(), bytes_seen[97:123].sum()
    letters = upper + lower + bytes_seen[192:].sum()
    symbols = bytes_seen[33:127].sum() - upper - lower - bytes_seen[48:58].sum()
    some = max(n, 1)
    found = np.array(
        [
            same / some,
            symbols / max(letters + symbols, 1),
            upper / max(upper + lower, 1),
            1 - (codes >> 20 & 1).sum() / some,
            (codes >> 21 & 1).sum() / some,
            (codes >> 22 & 1).sum() / some,
            1 - len(set(tokens)) / some,
        ]
    )
    return found, counts / some, n


def votes(found: np.ndarray, n_words: int) -> int:
    """The heuristics' votes as one number in base 3; a text without words gets bad votes only."""
    pattern = 0
    for share, (_, above, below, least) in zip(found, HEURISTICS, strict=True):
        vote = BAD if not n_words else NONE if n_words < least else BAD if share > above else GOOD if share < below else NONE
        pattern = pattern * 3 + vote
    return pattern


def unpacked(patterns: np.ndarray) -> np.ndarray:
    """Votes [pattern, heuristic]."""
    powers = 3 ** np.arange(len(HEURISTICS) - 1, -1, -1)
    return patterns[:, None] // powers[None] % 3


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[dict[int, float], np.ndarray]:
    """Posterior of good per pattern, and each heuristic's P(vote | class) as [class, heuristic, vote].

    A heuristic that does not vote says nothing. Starts from the votes, where a bad one weighs more, as junk has one fault
    and not all; add-one smoothing keeps every probability above 0.
    """
    ballots = unpacked(patterns)
    balance = (ballots == GOOD).sum(1) - 3.0 * (ballots == BAD).sum(1)
    good = 1 / (1 + np.exp(-np.clip(balance, -30, 30)))
    chance = np.zeros((2, len(HEURISTICS), 3))
    for _ in range(rounds):
        for side, weight in ((0, counts * (1 - good)), (1, counts * good)):
            for vote in range(3):
                chance[side, :, vote] = ((ballots == vote) * weight[:, None]).sum(0) + 1
        chance /= chance.sum(2, keepdims=True)
        prior = np.clip((counts * good).sum() / max(counts.sum(), 1), 1e-3, 1 - 1e-3)
        ratio = np.log(chance[1] / chance[0])
        ratio[:, NONE] = 0
        odds = np.log(prior / (1 - prior)) + ratio[np.arange(len(HEURISTICS))[None], ballots].sum(1)
        good = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(patterns.tolist(), good.tolist(), strict=True)), chance


def fit_scorer(features: np.ndarray, labels: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels; features are scaled to comparable size first."""
    size = np.sqrt((features**2).mean(0)) + 0.01
    x = features / size
    weights, bias, step, velocity = np.zeros(x.shape[1]), 0.0, 0.3, 0.0
    for _ in range(rounds):
        gap = 1 / (1 + np.exp(-np.clip(x @ weights + bias, -30, 30))) - labels
        gradient = x.T @ gap / len(labels) + 1e-4 * weights
        velocity = 0.9 * velocity - step * gradient / max(1.0, np.sqrt((x**2).sum(1).mean()))
        weights = weights + velocity
        bias -= step * gap.mean()
    return weights / size, float(bias)


def score_quality(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_sample: int = 6000, threshold: float = 0.5
) -> DataFrame:
    """The input rows with weak_label (posterior of good), score (0 to 1) and keep; columns of these names are replaced.

    Votes are counted over all documents. The scorer is fitted in one task on the ``max_sample`` rows with the smallest
    hash of id and text. Null and empty texts have no words, get bad votes only and are scored like any other text; an
    empty table gives no rows.
    """
    ship(documents.sparkSession)
    documents = documents.drop("weak_label", "score", "keep")
    place = documents.columns.index(text_col)

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, totals = Shapes(), np.zeros(3 ** len(HEURISTICS), np.int64)
        for batch in batches:
            for text in batch.column(0):
                found, _, n = shares(text.as_py() or "", shapes)
                totals[votes(found, n)] += 1
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(totals[seen])], names=["pattern", "n"])

    counted = documents.select(text_col).mapInArrow(patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    rows = sorted(map(tuple, counted.collect()))  # at most 3 ** 7 patterns
    posterior, _ = fit_votes(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], float)) if rows else ({}, None)

    order = F.xxhash64(F.col(id_col), F.col(text_col))
    hashes = documents.select(order.alias("order")).orderBy("order").limit(max_sample)
    bound = hashes.agg(F.max("order")).first()[0]

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            buckets, values, labels = [], [], []
            for text in batch["text"]:
                found, counts, n = shares(text.as_py() or "", shapes)
                use = np.flatnonzero(counts)
                buckets.append(use)
                values.append(counts[use])
                labels.append(posterior[votes(found, n)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float64())), pa.array(labels, pa.float64()), batch["order"]],
                names=["buckets", "values", "label", "order"],
            )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = [], []
        for batch in batches:
            room = max_sample - len(x)  # repeated rows share a hash and may be more than asked for
            for use, values in zip(batch["buckets"][:room], batch["values"][:room], strict=True):
                row = np.zeros(BUCKETS, np.float32)
                row[use.values.to_numpy()] = values.values.to_numpy()
                x.append(row)
            y += batch["label"][:room].to_pylist()
        if not y:
            return
        features = np.array(x, np.float32)
        used = np.flatnonzero(features.any(0))
        weights, bias = fit_scorer(features[:, used], np.array(y))
        yield pa.RecordBatch.from_arrays(
            [pa.array([*used.tolist(), -1], pa.int64()), pa.array([*weights.tolist(), bias], pa.float64())], names=["bucket", "weight"]
        )

    sample = documents.select(F.col(text_col).alias("text"), order.alias("order")).filter(F.col("order") <= F.lit(bound))
    sample = sample.mapInArrow(sampled, "buckets array<long>, values array<double>, label double, order long")
    sample = sample.repartition(1).sortWithinPartitions("order", "label")
    found = dict(map(tuple, sample.mapInArrow(fitted, "bucket long, weight double").collect()))  # at most BUCKETS + 1 rows
    weights, bias = np.zeros(BUCKETS), found.pop(-1, 0.0)
    for bucket, weight in found.items():
        weights[bucket] = weight
    added = [T.StructField("weak_label", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("keep", T.BooleanType())]
    schema = T.StructType([*documents.schema.fields, *added])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            weak, score = [], []
            for text in batch.column(place):
                found, counts, n = shares(text.as_py() or "", shapes)
                weak.append(posterior[votes(found, n)])
                score.append(1 / (1 + np.exp(-np.clip(counts @ weights + bias, -30, 30))))
            columns = [pa.array(weak, pa.float64()), pa.array(score, pa.float64()), pa.array([s >= threshold for s in score], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return documents.mapInArrow(scored, schema)
