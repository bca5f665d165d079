"""Toxicity from a lexicon, misspelt terms included, weighed by their context."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, worker_store

#: Labelled documents to learn from, half of each label where there are as many.
TRAIN_ROWS = 4000
#: Different surroundings in toxic documents that make a word a term: so many, and so many
#: for each toxic document; and the least share of all its surroundings that must be toxic.
EVIDENCE = 8
FREQUENCY = 0.01
PRECISION = 0.9
#: Words a worker remembers at least.
REMEMBERED = 200_000

#: What a term counts if misspelt by one or two edits, quoted, or aimed at someone.
MISSPELT = (1.0, 0.7, 0.5)
QUOTED = 0.3
AIMED = 1.3
#: Words on either side that are a term's context.
WINDOW = 6

#: Words that report speech or speak of words, and words for the reader.
REPORTING = frozenset("""
    said says say quoted quote quotes called calls word words term phrase wrote writes mean means
    meaning definition defined slur insult insults synonym reported sagte wort begriff nannte schrieb
    zitat bedeutet mot terme phrase dit citation signifie appelé palabra término dijo cita significa llamó
""".split())
READER = frozenset("you your yours yourself u ur du dich dir dein deine sie ihr euch tu te toi ton ta vous votre usted tú tus ustedes vosotros eres".split())
OPENING, CLOSING = "\"“„«‘‹", "\"”“»’›"

WORD = re.compile(r"[^\W\d_]+")
#: A word, with digits and masking signs between its letters; the same in SQL, for texts in lower case.
MASKED = re.compile(r"[^\W\d_]+(?:[0-9@$*!]{1,2}[^\W\d_]+)*")
SIGN = re.compile(r"[0-9@$*!]{1,2}[^\W\d_]")
MASKED_SQL = r"\p{L}+(?:[0-9@$*!]{1,2}\p{L}+)+"


def edits(length: int) -> int:
    """How many edits a term of that length may suffer and still be told."""
    return 0 if length < 5 else 1 if length < 9 else 2


class Lexicon:
    """A trie of terms, searched with the Levenshtein automaton of a word."""

    def __init__(self, terms: list[str], reach: list[int] | None = None) -> None:
        self.allowed = [edits(len(term)) for term in terms] if reach is None else reach
        self.children: list[dict[str, int]] = [{}]
        self.term = [-1]
        self.reach = [0]
        for number, term in enumerate(terms):
            node = 0
            allowed = self.allowed[number]
            self.reach[0] = max(self.reach[0], allowed)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.term)
                    self.children.append({})
                    self.term.append(-1)
                    self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], allowed)
            self.term[node] = number
        self.terms = terms
        self.near = self._near()

    def _near(self) -> re.Pattern:
        """What a word must show to be near a term at all.

        A term cut into one part more than it may suffer edits keeps one part whole: the
        first at the start, the last at the end, or one between them anywhere.
        """
        starts, ends, inside = set(), set(), set()
        for term, allowed in zip(self.terms, self.allowed):
            parts = allowed + 1
            cuts = [len(term) * i // parts for i in range(parts + 1)]
            pieces = [term[a:b] for a, b in zip(cuts, cuts[1:])]
            starts.add(pieces[0])
            ends.add(pieces[-1])
            inside.update(pieces[1:-1])
        either = [f"^(?:{'|'.join(map(re.escape, sorted(starts)))})"] if starts else ["(?!)"]
        if ends:
            either.append(f"(?:{'|'.join(map(re.escape, sorted(ends)))})$")
        if inside:
            either.append(f"(?:{'|'.join(map(re.escape, sorted(inside)))})")
        return re.compile("|".join(either))

    def closest(self, word: str) -> tuple[int, int] | None:
        """The term fewest edits away, and how many; of equally close ones the first listed.

        A state of the automaton is the row of distances between the letters read so far
        and the beginnings of the word, cut off above what is allowed. The trie is walked
        only where some entry of the row is still within reach of a term below.
        """
        if not self.near.search(word):
            return None
        best: tuple[int, int] | None = None
        most = self.reach[0]
        stack = [(0, tuple(min(i, most + 1) for i in range(len(word) + 1)))]
        while stack:
            node, row = stack.pop()
            number = self.term[node]
            if number >= 0 and row[-1] <= self.allowed[number]:
                if best is None or (row[-1], number) < best:
                    best = (row[-1], number)
            for letter, child in self.children[node].items():
                following = [row[0] + 1]
                for i, own in enumerate(word):
                    following.append(min(row[i] + (own != letter), row[i + 1] + 1, following[i] + 1))
                if min(following) <= self.reach[child]:
                    stack.append((child, tuple(following)))
        return None if best is None else (best[1], best[0])


@dataclass(frozen=True)
class ToxicityModel:
    """Terms with weights and edits they may suffer, words that only look like them, a logistic curve."""

    terms: list[str]
    weights: list[float]
    reach: list[int]
    harmless: frozenset[str] = field(default_factory=frozenset)
    slope: float = 4.0
    offset: float = -4.0

    def parts(self) -> tuple:
        return self.terms, self.weights, self.reach, self.harmless, self.slope, self.offset


class Scorer:
    """Evidence and scores of texts, remembering the words it has looked up."""

    def __init__(self, model: ToxicityModel) -> None:
        self.model = model
        self.lexicon = Lexicon(model.terms, model.reach)
        self.known = Memo(self._look_up, REMEMBERED)

    def _look_up(self, word: str) -> tuple[int, int] | int:
        if word in self.model.harmless or not self.model.terms:
            return 0
        return self.lexicon.closest(word) or 0

    def _spans(self, text: str) -> Iterator[tuple[int, int]]:
        """Where the words of a text lie; one with digits or signs inside is cut there, unless it is near a term."""
        for found in MASKED.finditer(text):
            word = found.group()
            if word.isalpha() or self.known[word]:
                yield found.span()
            else:
                start = found.start()
                yield from ((start + m.start(), start + m.end()) for m in WORD.finditer(word))

    def evidence(self, text: str | None) -> float:
        """The weights of all terms in a text, each scaled by its spelling and its context."""
        if not text:
            return 0.0
        lowered = text.lower()
        known = self.known
        if not any(known[word] for word in WORD.findall(lowered)):
            # most texts hold no sign before a letter, and need no second look
            if not SIGN.search(lowered) or not any(known[word] for word in MASKED.findall(lowered) if not word.isalpha()):
                return 0.0
        hits = [i for i, (start, end) in enumerate(self._spans(lowered)) if known[lowered[start:end]]]
        wanted = {j for i in hits for j in range(i - WINDOW, i + WINDOW + 1)}
        spans = {i: span for i, span in enumerate(self._spans(lowered)) if i in wanted}
        total = 0.0
        for i in hits:
            start, end = spans[i]
            number, distance = known[lowered[start:end]]
            near = [lowered[slice(*spans[j])] for j in range(i - WINDOW, i + WINDOW + 1) if j in spans and j != i]
            value = self.model.weights[number] * MISSPELT[distance]
            first = min(spans[j][0] for j in range(i - WINDOW, i + 1) if j in spans)
            final = max(spans[j][1] for j in range(i, i + WINDOW + 1) if j in spans)
            if self._quoted(lowered[first:start], lowered[end:final]) or any(w in REPORTING for w in near):
                value *= QUOTED
            if any(w in READER for w in near):
                value *= AIMED
            total += value
        return total

    @staticmethod
    def _quoted(before: str, after: str) -> bool:
        """Whether quotation marks stand around: opened before in the window, closed after it."""
        opened = max((before.rfind(mark) for mark in OPENING), default=-1)
        closed = min((at for at in map(after.find, CLOSING) if at >= 0), default=-1)
        if opened < 0 or closed < 0:
            return False
        # an even number of straight marks before means that they are closed already
        return before[opened] != '"' or before.count('"') % 2 == 1

    def score(self, text: str | None) -> float:
        return float(_curve(np.log1p(self.evidence(text)), self.model.slope, self.model.offset))


def _curve(x, slope: float, offset: float):
    return 1 / (1 + np.exp(-np.clip(slope * x + offset, -50, 50)))


def _sampled(labels: DataFrame, doc_id: str, label: str, rows: int) -> DataFrame:
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("y"))
    halves = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows // 2) for y in (0, 1)]
    return halves[0].union(halves[1])


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    rows: int = TRAIN_ROWS, terms: dict[str, float] | None = None,
) -> ToxicityModel:
    """Learn a lexicon and a logistic curve from a sample of labelled documents.

    At most ``rows`` documents, half of each label where there are as many. A word is a
    term if at least ``EVIDENCE`` different pairs of neighbours, and ``FREQUENCY`` pairs for
    each toxic document, surround it in toxic documents, and ``PRECISION`` of all that
    surround it do; so copies of one text prove little, and neither does a word that
    happens to occur in a few. All of them are taken, which the sample bounds, and ``terms``,
    rarer ones with weights of their own, are added. A term whose look-alikes at some
    distance occur in harmless documents as well is matched at smaller distances only, and
    single look-alikes of harmless documents are remembered as harmless. A word with one or two
    digits or masking signs between its letters is one word too, each text that holds it being
    one surrounding. Equal texts teach once. Labels other than 0 and 1,
    and ids without a document, teach nothing; of an id labelled twice the larger label
    counts, of an id with several texts the least.
    """
    sample = F.broadcast(_sampled(labels, doc_id, label, rows))
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.join(sample, "id").groupBy("id", "y").agg(F.min("text").alias("text"))
    texts = texts.groupBy("text").agg(F.max("y").alias("y"))
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")
    grown = texts.select("y", "text", F.concat(F.array(F.lit("")), words, F.array(F.lit(""))).alias("w"))
    at = F.sequence(F.lit(1), F.size("w") - 2)
    around = F.transform(at, lambda i: F.struct(
        F.get("w", i).alias("word"), F.xxhash64(F.get("w", i - 1), F.get("w", i + 1)).alias("around")
    ))
    # a word with digits or signs inside is also one word, in the surroundings of its text
    masked = F.transform(F.regexp_extract_all(F.lower("text"), F.lit(MASKED_SQL), F.lit(0)), lambda w: F.struct(
        w.alias("word"), F.xxhash64("text").alias("around")
    ))
    grown = grown.where(F.size("w") > 2).select("y", F.explode(F.concat(around, masked)).alias("e")).select("e.*", "y")
    around = grown.groupBy("word", "around").agg(F.max("y").alias("toxic"), F.min("y").alias("both"))
    seen = around.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("both")).alias("good"))
    toxic = texts.where("y = 1").count()
    strong = (F.col("bad") >= max(EVIDENCE, FREQUENCY * toxic)) & (F.col("bad") >= PRECISION * (F.col("bad") + F.col("good"))) & (F.length("word") > 2)
    found = seen.where(strong).orderBy(F.desc("bad"), "word").collect()
    weights = {r["word"]: float(np.log2(1 + (r["bad"] + 1) / (r["good"] + 1)) / 4) for r in found}
    weights |= terms or {}
    model = ToxicityModel(list(weights), list(weights.values()), [edits(len(t)) for t in weights])
    if not weights:
        return model

    alike = docs.sparkSession.sparkContext.broadcast(model.terms)

    @F.pandas_udf("term int, distance int")
    def looks_alike(batch: pd.Series) -> pd.DataFrame:
        lexicon = Lexicon(alike.value)
        return pd.DataFrame([lexicon.closest(w) or (-1, 0) for w in batch], columns=["term", "distance"])

    alike_words = seen.select("word", "bad", "good", looks_alike("word").alias("a")).where("a.distance > 0")
    spelt = alike_words.groupBy("a.term", "a.distance").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()
    reach = list(model.reach)
    for r in spelt:
        if r["bad"] + 1 < PRECISION * (r["bad"] + r["good"] + 1):
            reach[r["term"]] = min(reach[r["term"]], r["distance"] - 1)
    clean = alike_words.where("good > 0 and good >= bad").select("word", "a.*").collect()
    harmless = frozenset(r["word"] for r in clean if r["distance"] <= reach[r["term"]]) - weights.keys()
    model = ToxicityModel(model.terms, model.weights, reach, harmless)
    sent = docs.sparkSession.sparkContext.broadcast(model.parts())

    @F.pandas_udf("double")
    def evident(batch: pd.Series) -> pd.Series:
        scorer = Scorer(ToxicityModel(*sent.value))
        return pd.Series([scorer.evidence(t) for t in batch], dtype="float64")

    points = texts.select("y", F.log1p(evident("text")).alias("x")).groupBy("y", F.round("x", 6).alias("x")).count().collect()
    return ToxicityModel(model.terms, model.weights, reach, harmless, *_logistic(points))


def _logistic(points: list) -> tuple[float, float]:
    """Slope and offset of the curve, by Newton's method with a little shrinkage."""
    if len({p["y"] for p in points}) < 2:
        return ToxicityModel.slope, ToxicityModel.offset
    x = np.array([p["x"] for p in points], float)
    y = np.array([p["y"] for p in points], float)
    n = np.array([p["count"] for p in points], float)
    n /= np.where(y == 1, n[y == 1].sum(), n[y == 0].sum())
    design, beta = np.stack([x, np.ones(len(x))], 1), np.zeros(2)
    ridge = 1e-3 * np.eye(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (n * (y - p)) - ridge @ beta
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + ridge, gradient)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


def score(df: DataFrame, model: ToxicityModel, text: str = "text", column: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1 for its whole text; a column of that name is replaced.

    A term may be misspelt by digits and masking signs between its letters as well; words
    merely joined by these count apart. Texts without a term, empty and null ones have the
    score of no evidence; a text of any length is read whole, an empty table stays empty.
    """
    sent = df.sparkSession.sparkContext.broadcast(model.parts())
    key = ("toxicity", repr(model.parts()[:3]), tuple(sorted(model.harmless)), model.slope, model.offset)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = worker_store(key, lambda: Scorer(ToxicityModel(*sent.value)))
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return df.withColumn(column, scored(F.col(f"`{text}`")))
