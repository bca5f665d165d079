"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .common import in_fold

#: Lengths of the n-grams; a blank stands before and after each word.
NGRAMS = (1, 2, 3)
#: N-grams of a profile, of a document's as of a language's.
PROFILE = 300
#: Documents of each language to learn from, at most about so many.
TRAIN_ROWS = 4000
#: Letters that are counted at once.
BLOCK = 1 << 19

#: What a prediction says of a text without letters.
UNKNOWN = "und"

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _letters(text: str) -> np.ndarray:
    """The code points of a text's letters in lower case; one blank for all between them, and at its ends."""
    lowered = f" {text} ".lower()
    parts = []
    for start in range(0, len(lowered), BLOCK):
        part = lowered[start : start + BLOCK]
        if part.isascii():
            points = np.frombuffer(part.encode(), np.uint8)
            parts.append(np.where((points >= 97) & (points <= 122), points, 32).astype(np.uint32))
        else:
            letters = "".join([c if c.isalpha() else " " for c in part])
            parts.append(np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32))
    points = np.concatenate(parts)
    blank = points == 32
    return points[~(blank & np.concatenate([[False], blank[:-1]]))]


def _grams(points: np.ndarray, starts: int) -> np.ndarray:
    """A number for every n-gram that begins at one of the first ``starts`` points."""
    blank = points == 32
    points = points.astype(np.uint64)
    found = []
    for n in NGRAMS:
        width = min(len(points) - n + 1, starts)
        if width < 1:
            continue
        gram = np.full(width, np.uint64(n))
        for i in range(n):
            gram = gram * _PRIME + points[i : i + width]
        inner = ~blank[1 : width + 1] if n == 3 else ~blank[:width] if n == 1 else np.ones(width, bool)
        found.append(gram[inner])
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text and how often each occurs, whatever its length.

    Blocks of a long text overlap by what its longest n-grams need, so that every n-gram is
    counted where it begins, and cuts change nothing.
    """
    grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    points = _letters(text or "")
    for start in range(0, len(points), BLOCK):
        block = points[start : start + BLOCK + max(NGRAMS) - 1]
        new, often = np.unique(_grams(block, BLOCK), return_counts=True)
        if len(grams):
            both = np.concatenate([grams, new])
            grams, at = np.unique(both, return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, often]), len(grams)).astype(np.int64)
        else:
            grams, counts = new, often
    return grams, counts


@dataclass(frozen=True)
class Profiles:
    """For each language its n-grams in ascending order, and the rank of each by frequency."""

    languages: list[str]
    grams: list[np.ndarray]
    ranks: list[np.ndarray]
    size: int

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language, and how much nearer it is than a profile that shares nothing."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        grams, counts = _counted(text)
        top = np.lexsort((grams, -counts))[: self.size]
        grams, distances = grams[top], []
        for known, ranks in zip(self.grams, self.ranks):
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            places = np.abs(ranks[at] - np.arange(len(grams)))
            distances.append(int(np.where(known[at] == grams, places, self.size).sum()))
        best = int(np.argmin(distances))
        return self.languages[best], 1 - distances[best] / (self.size * len(grams))


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    rows: int = TRAIN_ROWS, size: int = PROFILE,
) -> Profiles:
    """The profile of every language that ``docs`` name.

    Of a language with more than ``rows`` documents, about that many are learned from,
    chosen by a hash of their id; all n-grams of these are counted, by the executors. The
    driver receives ``size`` n-grams of each language. Null languages and texts teach
    nothing. Equal counts are ordered by the n-gram's number.
    """
    known = docs.select(
        F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    ).where("lang is not null and text is not null")
    # written, so that its size is known and texts need not move to meet a few shares
    shares = known.groupBy("lang").agg(F.least(F.lit(1.0), rows / F.count("*")).alias("share"))
    shares = materialise(shares, "shares")
    chance = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) / float(1 << 20)
    sample = known.join(shares, "lang").where(chance < F.col("share")).select("lang", "text")

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for language, texts in frame.groupby("lang")["text"]:
                grams, counts = [], []
                for body in texts:
                    found, often = _counted(body)
                    grams.append(found)
                    counts.append(often)
                new, at = np.unique(np.concatenate(grams), return_inverse=True)
                total = np.bincount(at, np.concatenate(counts), len(new)).astype(np.int64)
                yield pd.DataFrame({"lang": language, "gram": new.view(np.int64), "n": total})

    totals = sample.mapInPandas(counted, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # the best of every part first, so that no task orders all n-grams of a language
    order = [F.desc("n"), F.col("gram")]
    part = F.pmod("gram", F.lit(64))
    best = totals.withColumn("place", F.row_number().over(W.partitionBy("lang", part).orderBy(*order)))
    best = best.where(F.col("place") <= size)
    best = best.withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("place") <= size)
    found: dict[str, list] = {}
    for row in best.select("lang", "gram", "place").collect():
        found.setdefault(row["lang"], []).append((row["gram"] % (1 << 64), row["place"] - 1))
    languages = sorted(found)
    ordered = [sorted(found[name]) for name in languages]
    return Profiles(
        languages,
        [np.array([g for g, _ in rows_], np.uint64) for rows_ in ordered],
        [np.array([r for _, r in rows_], np.int64) for rows_ in ordered],
        size,
    )


def identify(df: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` for the whole text; columns so named are replaced.

    A document's ``size`` most frequent n-grams are ranked; an n-gram is as far out of
    place as its ranks differ, or by ``size`` where the language lacks it. The language
    with the least sum is predicted, the first by name of equal ones; the score is one
    minus the sum's share of the largest possible. Texts that are null or have no letter
    are ``und`` with score 0, as is every text if no language was learned.
    """
    sent = df.sparkSession.sparkContext.broadcast((profiles.languages, profiles.grams, profiles.ranks, profiles.size))

    @F.pandas_udf("lang_pred string, score double")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Profiles(*sent.value)
        for texts in batches:
            yield pd.DataFrame([known.predict(t) for t in texts], columns=["lang_pred", "score"])

    columns = [F.col(f"`{c}`") for c in df.columns if c not in ("lang_pred", "score")]
    return df.select(*columns, identified(F.col(f"`{text}`")).alias("found language")).select(
        *columns, F.col("found language.lang_pred"), F.col("found language.score")
    )


def learnable(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents that may be learned from: those not in the held-out quarter."""
    return docs.where(F.col(doc_id).isNotNull() & ~in_fold(doc_id, 4, 2))
