"""A quality classifier on learned subword vectors, averaged over a document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, pieces

#: Hash buckets of words and character n-grams.
BUCKETS = 1 << 15
#: Character n-grams inside words, the space before and after a word included.
NGRAMS = (3, 4)
DIMENSIONS = 8
EPOCHS = 12
RATE = 0.1
#: Features of no effect that are added to every average, so that a few words decide little.
NEUTRAL = 20
#: Documents of the sample to fit on, half of each label where there are as many.
TRAIN_ROWS = 3000
#: Characters that are hashed at once.
BLOCK = 1 << 19
#: Characters of short texts worked on together, which bounds a worker's arrays.
TOGETHER = 1 << 16

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(32))) * _MIX
    return (mixed >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int32)


def _features(group: list[tuple[int, str]], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words and character n-grams of the texts, and which text each is of."""
    joined = " " + " ".join(text for _, text in group) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([1] + [len(text) + 1 for _, text in group])
    of = np.searchsorted(starts, np.arange(len(points)), "right").astype(np.int32) - 1
    of = np.clip(of, 0, len(group) - 1)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    points = np.where(space, 32, points).astype(np.uint64)

    # words: differences of one running polynomial, moved to a common power
    edges = np.diff(space.astype(np.int8))
    begins = np.flatnonzero(edges == -1) + 1
    ends = np.flatnonzero(edges == 1) + 1
    powers = np.cumprod(np.full(len(points), _PRIME, np.uint64))
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(points * powers)])
    back = np.cumprod(np.full(len(points), _INVERSE, np.uint64))
    words = (running[ends] - running[begins]) * back[begins]
    # a word that repeats the word before it is one marker, whatever the word
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (of[begins[1:]] == of[begins[:-1]])
    words[again] = _PRIME
    found, owner = [_buckets(words, buckets)], [of[begins]]

    # n-grams: a space may stand at either end, not inside
    for n in NGRAMS:
        if len(points) < n:
            continue
        width = len(points) - n + 1
        gram = np.full(width, np.uint64(n))
        inside = np.ones(width, bool)
        for i in range(n):
            gram = gram * _PRIME + points[i : i + width]
            if 0 < i < n - 1:
                inside &= ~space[i : i + width]
        inside &= ~(space[:width] & space[n - 1 :])
        at = np.flatnonzero(inside)
        found.append(_buckets(gram[at], buckets))
        owner.append(of[at + 1])
    return np.concatenate(found), np.concatenate(owner)


@dataclass(frozen=True)
class QualityModel:
    """Vectors of the buckets times the output layer: what one feature adds to the odds.

    The average of vectors and the output layer are both linear, so the difference of
    the two outputs is the average of one number for each bucket.
    """

    weights: np.ndarray
    bias: float

    def scores(self, texts: pd.Series) -> pd.Series:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for group in pieces(texts, BLOCK, TOGETHER):
            found, owner = _features(group, len(self.weights))
            rows = np.array([at for at, _ in group])
            np.add.at(total, rows, np.bincount(owner, self.weights[found], len(group)))
            np.add.at(count, rows, np.bincount(owner, minlength=len(group)))
        odds = total / (count + NEUTRAL) + self.bias
        return pd.Series(1 / (1 + np.exp(-np.clip(odds, -50, 50))))


def _sampled(labels: DataFrame, doc_id: str, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, half of each label, in the order of a hash."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("y"))
    halves = [
        known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows // 2) for y in (0, 1)
    ]
    return halves[0].union(halves[1])


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    rows: int = TRAIN_ROWS, seed: int = 7,
) -> QualityModel:
    """Learn the vectors by stochastic gradient descent on a sample of labelled documents.

    The sample has at most ``rows`` documents, half of each label where there are as
    many; of each the driver receives the counts of its buckets, never the text. A label
    other than 0 or 1 and an id without a document teach nothing; of an id labelled twice
    the larger label counts, of an id with several texts the least. A text without
    features, and every text if nothing could be learned, gets the share of label 1.
    """
    sample = F.broadcast(_sampled(labels, doc_id, label, rows))
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.join(sample, "id").groupBy("id", "y").agg(F.min("text").alias("text"))

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row_id, y, body in zip(frame["id"], frame["y"], frame["text"]):
                counts = np.zeros(BUCKETS, np.int64)
                for group in pieces([body], BLOCK):
                    counts += np.bincount(_features(group, BUCKETS)[0], minlength=BUCKETS)
                used = np.flatnonzero(counts)
                share = (counts[used] / (counts.sum() + NEUTRAL)).astype(np.float32)
                yield pd.DataFrame(
                    {"id": [row_id], "y": [y], "used": [used.astype(np.uint16).tobytes()], "share": [share.tobytes()]}
                )

    kind = texts.schema["id"].dataType.simpleString()
    found = texts.mapInPandas(counted, f"id {kind}, y int, used binary, share binary").collect()
    found.sort(key=lambda r: r["id"])
    examples = [(r["y"], np.frombuffer(r["used"], np.uint16), np.frombuffer(r["share"], np.float32)) for r in found]
    counts = labels.groupBy(F.col(label).alias("y")).count().where(F.col("y").isin(0, 1)).collect()
    of = {int(r["y"]): r["count"] for r in counts}
    prior = float(np.log((of.get(1, 0) + 1) / (of.get(0, 0) + 1)))
    return _descend([e for e in examples if len(e[1])], prior, seed)


def _descend(examples: list[tuple[int, np.ndarray, np.ndarray]], prior: float, seed: int) -> QualityModel:
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    outputs = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.array([0, prior], np.float32)
    steps, step = EPOCHS * len(examples), 0
    for _ in range(EPOCHS):
        for at in rng.permutation(len(examples)):
            y, used, share = examples[at]
            rate = RATE * (1 - step / steps)
            step += 1
            rows = vectors[used]
            hidden = share @ rows
            logits = hidden @ outputs + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[y] -= 1
            # a document's features share one step, however many they are
            pull = (share / (share @ share))[:, None] * (outputs @ error)[None, :]
            outputs -= 5 * rate * np.outer(hidden, error)
            vectors[used] = rows - rate * pull
    return QualityModel((vectors @ (outputs[:, 1] - outputs[:, 0])).astype(np.float32), prior)


def score(df: DataFrame, model: QualityModel, text: str = "text", column: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 for its whole text, in a column of that name.

    Null and empty texts have no features; their score is that of the bias alone.
    A column of the same name is replaced. A long text is counted in pieces and scored whole;
    repeated rows are scored one by one, equal texts alike, and an empty table stays empty.
    """
    sent = df.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield QualityModel(*sent.value).scores(texts)

    return df.withColumn(column, scored(F.col(f"`{text}`")))


def labelled_fold(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The labels that may be learned from: those whose id is not in the held-out third."""
    return labels.where(F.col(doc_id).isNotNull() & ~in_fold(doc_id, 3, 1))
