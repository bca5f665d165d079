"""Spelling variants: words one edit apart, from products of blocked letter-count matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Letters of words: Latin ones of one byte in Latin-1.
LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LETTERS, LEAST_COUNT, FACTOR = 7, 2, 10
#: One run in so many, by its document, loses a letter.
LOSES = 31

#: Words and letters of a block's piece, on average; two pieces are multiplied at a time.
WORDS, CHARACTERS = 2048, 1 << 20
#: Pieces of a block that meet as many of another one in a task.
TOGETHER = 16
#: Pieces of a partition of the join, on average.
SHARE = 32
#: Letters of candidate pairs that are compared at once.
COMPARED = 1 << 22
#: Letters are of one class if their code points leave the same remainder by this number.
CLASSES = 5
#: The code points of letters, and where each has its place in a vector of counts.
POINTS = [*range(97, 123), *range(0xC0, 0x100)]

_UPPER, _LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))
_SLOT = np.zeros(256, np.int64)
_SLOT[POINTS] = np.arange(len(POINTS))


def _steps() -> list[tuple[int, ...]]:
    """How blocks one edit apart differ, in length and in letters of all classes but the last.

    Every pair of blocks once: one more letter of some class, or one of a class instead of
    one of a later class, or of the same.
    """
    unit = np.eye(CLASSES, dtype=int)
    same = [np.zeros(CLASSES, int)] + [unit[j] - unit[i] for i in range(CLASSES) for j in range(i)]
    steps = [(0, *step) for step in same] + [(1, *step) for step in unit]
    return [tuple(int(x) for x in step[:-1]) for step in steps]


STEPS = _steps()
#: What names a block: the length of its words, and their letters of each class but the last.
BLOCK = ["length", *[f"of{c}" for c in range(CLASSES - 1)]]


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS, loses: int = LOSES) -> DataFrame:
    """``(word, n)``: the distinct words of at least ``least`` letters, and how often each occurs.

    A word is a maximal run of letters, A to Z in lower case. Where ``loses`` divides the
    CRC-32 of ``id:run``, the run lost the letter at that number's remainder by its length;
    a null id is written as nothing.
    """
    # a run of fewer letters cannot give a word, and a greedy match of more is a whole run
    runs = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[{LETTERS}]{{{least},}}"), 0)
    found = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    found = found.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    found = found.select(F.when(F.col("h") % loses == 0, shorter).otherwise(F.col("run")).alias("word"))
    return found.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))


def _held(word: Column, remainder: int) -> Column:
    """How many letters of a class a word has."""
    letters = "".join(chr(c) for c in POINTS if c % CLASSES == remainder)
    return F.length(word) - F.length(F.translate(word, letters, ""))


def _pieces(vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks of words in pieces of bounded size: ``(BLOCK, piece, words)``, and ``(BLOCK, pieces)``.

    An edit changes a word's length by one at most, and the number of its letters of each
    class by one at most, so only neighbouring blocks hold words one edit apart.
    """
    word = F.col("word")
    keyed = vocabulary.select("word", F.length(word).alias("length"), *[_held(word, c).alias(f"of{c}") for c in range(CLASSES - 1)])
    many = F.greatest(F.ceil(F.count("*") / WORDS), F.ceil(F.count("*") * F.first("length") / CHARACTERS))
    sizes = materialise(keyed.groupBy(*BLOCK).agg(many.alias("pieces")), "blocks")
    dealt = keyed.join(sizes, BLOCK).withColumn("piece", F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int"))
    return materialise(dealt.groupBy(*BLOCK, "piece").agg(F.collect_list("word").alias("words")), "pieces"), sizes


def _buckets(of: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.floor((F.col(of) - 1) / TOGETHER).cast("int")))


def _matrix(listed: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(listed).encode("latin-1"), np.uint8).reshape(-1, length)


def _counts(letters: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each word, exact in products of floats."""
    rows = np.arange(len(letters))[:, None] * len(POINTS)
    counts = np.bincount((rows + _SLOT[letters]).ravel(), minlength=len(letters) * len(POINTS)).reshape(len(letters), -1)
    return counts.astype(np.float32 if letters.shape[1] <= 2048 else np.float64)


def near_pairs(left: list[str], right: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of two lists that are one edit apart.

    The words of a list are of one length, those of the right one as long or longer by
    one. ``same`` says that the lists are one list, whose pairs are wanted once.

    Squared distances of letter counts come from one matrix product. One replaced letter
    makes it two, and one inserted letter one; what is left is verified letter by letter.
    """
    a, b = _matrix(left, len(left[0])), _matrix(right, len(right[0]))
    longer = b.shape[1] - a.shape[1]
    x, y = _counts(a), _counts(b)
    used = np.flatnonzero(x.any(axis=0) | y.any(axis=0))
    x, y = x[:, used], y[:, used]
    # two more columns, so that the product is the squared distance itself
    x = np.column_stack([x, (x * x).sum(axis=1), np.ones(len(x), x.dtype)])
    y = np.column_stack([-2 * y, np.ones(len(y), y.dtype), (y * y).sum(axis=1)])
    rows, columns = np.divmod(np.flatnonzero(x @ y.T <= 2), len(y))
    if same:
        once = rows < columns
        rows, columns = rows[once], columns[once]
    kept = np.zeros(len(rows), bool)
    step = max(COMPARED // b.shape[1], 1)
    for start in range(0, len(rows), step):
        part = slice(start, start + step)
        p, q = a[rows[part]], b[columns[part]]
        if longer:
            before = np.logical_and.accumulate(p == q[:, :-1], axis=1).sum(axis=1)
            after = np.logical_and.accumulate((p == q[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            kept[part] = before + after >= p.shape[1]
        else:
            kept[part] = (p != q).sum(axis=1) == 1
    return rows[kept], columns[kept]


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``(word, other)``: words of ``vocabulary`` that are one edit apart, each pair both ways.

    Words are distinct. Pieces of neighbouring blocks are joined as whole rows, some of one
    block with some of the other, so that no key grows with a block; a task multiplies two
    pieces at a time and returns only pairs that are one edit apart.
    """
    pieces, sizes = _pieces(vocabulary)
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("step"), *[F.lit(d).alias(c) for c, d in zip(BLOCK, step)]) for i, step in enumerate(STEPS)]))
    here, there = [F.col(f"s.{c}") for c in BLOCK], [F.col(c) for c in BLOCK]
    key = [*BLOCK, "step", "left bucket", "right bucket"]
    # a left piece goes to the block one step on, once for every bucket of that block; a right
    # one stays, once for every bucket of the block one step back
    left = pieces.select("*", steps.alias("s")).select(
        *[(a + b).alias(c) for a, b, c in zip(here, there, BLOCK)], "s.step", F.col("piece").alias("own"), F.col("words").alias("left"))
    left = left.join(sizes, BLOCK).withColumn("left bucket", F.floor(F.col("own") / TOGETHER).cast("int")).withColumn("right bucket", _buckets("pieces"))
    back = sizes.select("pieces", F.struct(*BLOCK).alias("from"), steps.alias("s")).select(
        *[(F.col(f"s.{c}") + F.col(f"from.{c}")).alias(c) for c in BLOCK], "s.step", "pieces")
    back = materialise(back, "blocks-back")  # many times its source, so that its size is known
    right = pieces.withColumnRenamed("words", "right").join(back, BLOCK)
    right = right.withColumn("right bucket", F.floor(F.col("piece") / TOGETHER).cast("int")).withColumn("left bucket", _buckets("pieces"))
    # work follows the number of pieces, not their bytes
    parts = pieces.count() // SHARE + 1
    left = left.select(*key, "own", "left").repartition(parts, *key)
    met = left.join(right.select(*key, "piece", "right").repartition(parts, *key), key)
    itself = F.col("step") == 0
    met = met.where(~itself | (F.col("own") <= F.col("piece"))).select("left", "right", (itself & (F.col("own") == F.col("piece"))).alias("same"))

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one, other = batch.column("left")[at].as_py(), batch.column("right")[at].as_py()
                rows, columns = near_pairs(one, other, batch.column("same")[at].as_py())
                if len(rows):
                    a, b = pa.array(one, pa.string()).take(pa.array(rows)), pa.array(other, pa.string()).take(pa.array(columns))
                    yield pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]), pa.concat_arrays([b, a])], ["word", "other"])

    return met.mapInArrow(multiplied, "word string, other string")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form, by pointer doubling.

    A form occurs ``FACTOR`` times as often as its word, two times or more. Counts are below
    2**63, so a chain has fewer than 19 links, which five doublings cover.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range(5):
        reached = materialise(reached, "roots")
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reached = reached.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return reached


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT, factor: int = FACTOR, loses: int = LOSES,
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of ``least`` letters that occurs ``least_count`` times.

    Two words are near if one inserted, deleted or replaced letter makes one the other.
    ``form`` is the near word that occurs most often, of equally frequent ones the first in
    code-point order, if it occurs ``factor`` times as often as the word, ten at least; else
    null. ``root`` is where the forms lead: the last word that has none, or the word itself.
    ``n_near`` counts the near words.

    Null and empty texts hold no words, and texts of any length are read whole. Every row
    counts, repeated ones too. Empty tables give no rows. Columns other than the two named
    are not looked at, whatever their names.

    Only distinct words leave the counting; a frequent word is summed before the shuffle.
    Blocks of any size are cut into pieces, so a task holds two pieces at a time; products
    grow with the square of a block's distinct words, what is returned with the near pairs.
    """
    if factor < 10 or least_count < 2:
        raise ValueError("chains of forms are followed up to 31 links: factor must be 10 and least_count 2 at least")
    vocabulary = materialise(words(docs, doc_id, text, least, loses).where(F.col("n") >= least_count), "vocabulary")
    near = materialise(near_words(vocabulary.select("word")), "near")
    counted = near.join(vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    facts = counted.groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = vocabulary.join(facts, "word", "left")
    follows = F.coalesce(-F.col("best.less") >= factor * F.col("n"), F.lit(False))
    joined = joined.select(
        "word", F.when(follows, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(follows, -F.col("best.less")).alias("form_n"),
    )
    joined = materialise(joined, "forms")
    roots = materialise(_roots(joined.where("form is not null")), "roots")
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
