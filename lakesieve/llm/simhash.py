"""SimHash near-duplicates through an inverted index over positions of bytes."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .components import components

SHINGLE_WORDS = 3
SEED = 42
BITS = 3
BYTES = 8

#: All sets of five of the eight byte positions.
FIVES = list(combinations(range(BYTES), 5))


def _fingerprint(text: str | None, words: int, seed: int) -> int:
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(found) - words + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], seed) for s, e in zip(starts, ends[words - 1 :].tolist())]
    # little-endian bytes, lowest bit first: column i of the table is bit i of a hash
    set_bits = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[start : start + (1 << 16)], dtype="<u8").view(np.uint8)
        table = np.unpackbits(block.reshape(-1, BYTES), axis=1, bitorder="little")
        set_bits += table.sum(axis=0, dtype=np.int64)
    bits = set_bits * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``fp``, the 64-bit SimHash of its text, as a signed integer.

    Bytes A-Z are lower-cased, words are runs of bytes other than ASCII white space,
    and every run of ``words`` words counts as often as it occurs. A shorter text is
    one shingle; a text without words, or null, has fingerprint zero.
    """

    @F.pandas_udf("bigint")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t, words, seed) for t in texts], dtype="int64")

    return df.withColumn("fp", fingerprint(F.col(text)))


def _byte(column: str, position: int) -> F.Column:
    return F.shiftrightunsigned(F.col(column), 8 * position).bitwiseAND(F.lit(255))


def _posting(five: tuple[int, ...]) -> F.Column:
    """The number of a set of positions, and the bytes found there, in one integer."""
    key = F.lit(FIVES.index(five)).cast("bigint")
    for position in five:
        key = F.shiftleft(key, 8).bitwiseOR(_byte("fp", position))
    return key


def fingerprint_links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """Pairs ``a < b`` of the distinct fingerprints ``fp`` at most ``bits`` bits apart.

    Fingerprints that differ in ``bits`` bits agree in at least ``8 - bits`` of their
    eight positional bytes; for three bits, in five. A posting of the index names five
    positions and the bytes there, so every pair wanted meets, and no pair that shares
    fewer positional bytes than guaranteed does: near copies of one template, which often
    share four, make no candidates by that alone. The postings a pair shares are tallied: ``k``
    equal bytes give as many as there are sets of five among them. Pairs with too few go, the
    rest are verified by counting differing bits. Single-byte postings would hold 1/256 of all fingerprints each; these
    hold about one in a million million.

    Every fingerprint occurs once, however many documents share it, and at most 128
    fingerprints can all lie within three bits of each other, so no group of copies
    makes the number of links grow with its square.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the index finds fingerprints up to three bits apart")
    postings = distinct.select("fp", F.explode(F.array(*map(_posting, FIVES))).alias("key"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    # Spark takes the postings to be as small as the fingerprints they are made from, and would broadcast them
    met = postings.withColumnRenamed("fp", "a").hint("merge").join(postings.withColumnRenamed("fp", "b"), "key").where("a < b")
    tallied = met.groupBy("a", "b").agg(F.count("*").alias("sets"))
    # as many sets as the bytes that are guaranteed to be equal have among them
    enough = tallied.where(F.col("sets") >= comb(BYTES - bits, len(FIVES[0])))
    return enough.where(F.bit_count(differ) <= bits).select("a", "b")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every row.

    Documents are linked when their fingerprints differ in at most ``bits`` bits, and
    ``component_id`` is the least ``doc_id`` that links lead to, itself included. Texts
    that are empty or null share fingerprint zero and so one component. Null ids are
    kept and name no component unless nothing else does, when it is null; repeated rows
    are kept. Other columns are not looked at. Texts of any length are read whole; an empty
    table gives no row.
    """
    found = fingerprints(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    return _linked(materialise(found.select("doc_id", "fp"), "fingerprints"), bits)


def _linked(found: DataFrame, bits: int) -> DataFrame:
    """The rows of ``found``, which has ``doc_id`` and ``fp``, with their ``component_id``."""
    heads = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("head")), "heads")
    roots = components(fingerprint_links(heads.select("fp"), bits))
    named = heads.join(roots, heads["fp"] == roots["node"], "left").select(
        "fp", "head", F.coalesce("root", "fp").alias("root")
    )
    named = materialise(named, "roots")
    least = named.groupBy("root").agg(F.min("head").alias("component_id"))
    return found.join(named.join(least, "root").select("fp", "component_id"), "fp").select(
        *found.columns, "component_id"
    )


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """The rows of ``df`` that lead their component: those with its least ``doc_id``.

    Of repeated rows with that id one stays, the one with the least text, then the
    least JSON of the row. Of a component without any id one row stays, by the same rule.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    order = F.struct(F.col("text"), F.to_json("row"))
    rows = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), row.alias("row"))
    # a second pass over the texts, to find the rows without an id, would start Python workers
    # beside those of the first, as many for each filter that Spark derives from a join
    printed = fingerprints(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    printed = printed.withColumn("text", F.when(F.col("doc_id").isNull(), F.col("text").cast("binary")))
    found = _linked(materialise(printed, "fingerprints"), bits)
    leaders = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("copies"))
    led = rows.join(leaders, rows["id"] == leaders["doc_id"])
    single = led.where("copies = 1").select("row.*")
    repeated = led.where("copies > 1").groupBy("id").agg(F.min_by("row", order).alias("row"))
    nameless = found.where("doc_id is null and component_id is null").select(F.col("text").alias("of"), "fp").distinct()
    blank = rows.where("id is null").join(nameless, F.col("text").cast("binary").eqNullSafe(F.col("of")))
    blank = blank.groupBy("fp").agg(F.min_by("row", order).alias("row"))
    return single.union(repeated.select("row.*")).union(blank.select("row.*"))
