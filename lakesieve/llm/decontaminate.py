"""Benchmark items inside documents, by size-partitioned MinHash containment search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

WORDS = 5
CONTAINMENT = 0.8


def word_hashes(text: Column) -> Column:
    """The hash of every word of a text: of its runs of letters and digits, in lower case."""
    split = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(split, lambda w: F.xxhash64(w))


def _runs(h: Column, words: int) -> Column:
    """Hashes of every ``words`` words in a row, of a sequence that has so many."""
    return F.transform(F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)]))


def shingle_hashes(text: Column, words: int = WORDS, shorter: Sequence[int] = ()) -> Column:
    """Hashes of the distinct word shingles of a text, as an array.

    A shingle is ``words`` words in a row; a text of fewer words is one shingle, a text
    without words or null has none. Runs of the ``shorter`` lengths are added to both.
    """
    none = F.array().cast("array<bigint>")

    def shingled(h: Column) -> Column:
        whole = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(none)
        found = F.when(F.size(h) >= words, _runs(h, words)).otherwise(whole)
        for n in shorter:
            found = F.concat(found, F.when(F.size(h) >= n, _runs(h, n)).otherwise(none))
        return F.array_distinct(found)

    # a one-element array, so that the hashed words are made once and not for every use
    return F.element_at(F.transform(F.array(word_hashes(text)), shingled), 1)


def sketches(items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """``(item, hash)``: the bottom MinHash values of every item, with its ``size``.

    Items are partitioned by size, that is by their number of distinct shingles up to
    the next power of two. The ``k`` least hashes of an item are a uniform sample of its
    shingles; ``k`` is set per partition, one more than the shingles the largest item of
    the partition may lack, so a document that contains enough of an item holds at least
    one value of its sketch: the search has no false negatives.
    """
    sized = items.withColumn("class", F.ceil(F.log2("size")).cast("int"))
    largest = sized.groupBy("class").agg(F.max("size").alias("most"))
    kept = F.floor(F.col("most") * F.lit(1 - containment) + F.lit(1e-9)).cast("int") + 1
    bottom = sized.join(largest, "class").select(
        "item", "size", F.explode(F.slice(F.array_sort("hashes"), F.lit(1), kept)).alias("hash")
    )
    return bottom


def contaminated(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", containment: float = CONTAINMENT, words: int = WORDS,
) -> DataFrame:
    """Pairs ``(doc_id, item_id)`` with ``shared`` of the item's ``size`` shingles and ``containment``.

    A pair is kept when the document contains at least that share of the item's distinct
    shingles. Repeated rows of documents or items give one pair for each pair of ids; the
    same id with several texts is as many documents, of which the fullest match counts.
    Texts without words contain nothing and are contained in nothing. An item of fewer than
    ``words`` words is one shingle, found wherever these words stand in a row, so an item of
    one common word is found in many documents. For it, documents get shingles of the lengths
    that such items have, and of no others. A null id is kept as null. Other columns are not
    looked at.

    Items and their sketches are written first, so their size is known: Spark sends them to
    the documents where they are small, and joins by a shuffle, which it can split, where not.
    An empty table of either kind gives no pairs; texts of any length are searched whole.
    """
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("t")).distinct()
    length = F.least(F.size(word_hashes(F.col("t"))), F.lit(words)).alias("length")
    wanted = wanted.select("item_id", length, shingle_hashes(F.col("t"), words).alias("hashes"))
    wanted = wanted.select(F.xxhash64("hashes").alias("item"), "item_id", "length", F.size("hashes").alias("size"), "hashes")
    wanted = materialise(wanted.where("size > 0").distinct(), "items")
    # at most one row for each length below that of a shingle
    shorter = sorted(r.length for r in wanted.where(F.col("length") < words).select("length").distinct().collect())
    sets = wanted.dropDuplicates(["item"]).select("item", "size", "hashes")
    sketch = materialise(sketches(sets, containment), "sketches")

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).where("t is not null")
    source = source.withColumn("of", F.xxhash64("t"))
    hashed = source.select("doc_id", "of", shingle_hashes(F.col("t"), words, shorter).alias("all"))
    hashed = hashed.select("doc_id", "of", "all", F.size("all").alias("held"))
    met = hashed.select("doc_id", "of", "held", F.explode("all").alias("hash")).join(sketch, "hash")
    met = met.where(F.col("held") >= F.ceil(F.col("size") * containment - 1e-9))
    candidates = materialise(met.select("doc_id", "of", "item").distinct(), "candidates")

    # exact containment, on the candidates alone
    texts = source.join(candidates.select("of").distinct(), "of", "left_semi").select("of", "t").distinct()
    texts = texts.select("of", shingle_hashes(F.col("t"), words, shorter).alias("all"))
    pairs = candidates.select("of", "item").distinct().join(sets, "item").join(texts, "of")
    pairs = pairs.select("of", "item", "size", F.size(F.array_intersect("all", "hashes")).alias("shared"))
    full = pairs.where(F.col("shared") >= F.col("size") * F.lit(containment) - F.lit(1e-9))
    named = wanted.select("item", "item_id").distinct()
    best = F.max(F.struct((F.col("shared") / F.col("size")).alias("containment"), "shared", "size"))
    return (
        candidates.join(full, ["of", "item"])
        .join(named, "item")
        .groupBy("doc_id", "item_id")
        .agg(best.alias("m"))
        .select("doc_id", "item_id", "m.shared", "m.size", "m.containment")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **named) -> DataFrame:
    """The rows of ``docs`` whose id is in no pair of ``contaminated``; null ids by the same rule."""
    found = contaminated(docs, items, doc_id, **named).select(F.col("doc_id").alias("bad id")).distinct()
    return docs.join(found, docs[doc_id].eqNullSafe(found["bad id"]), "left_anti")
