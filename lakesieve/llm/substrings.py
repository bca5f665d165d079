"""Repeated passages, found by content-defined chunks of a gear rolling hash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise

#: Bytes the rolling hash looks back on: it is shifted by one bit a byte, in 16 bits.
LOOK_BACK = 16
#: A cut falls where the hash's upper bits are zero, so after 2**BITS bytes on average.
BITS = 5
#: No cut follows a possible cut within so many bytes, and none is further than MOST away.
LEAST, MOST = 8, 1024
#: Bytes of consecutive chunks that one earlier place must hold as well.
SPAN = 100
#: Bytes that are hashed at once, and a cut may move to reach the start of a word.
BLOCK, WORD = 1 << 20, 32

_GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=2).digest(), "big") for b in range(256)], np.uint16)


def _possible(data: np.ndarray) -> np.ndarray:
    """Positions after which a cut is possible; each depends on the bytes just before it alone."""
    found = []
    for start in range(0, len(data), BLOCK):
        before = max(start - LOOK_BACK + 1, 0)
        rolled = _GEAR[data[before : start + BLOCK]]
        span = 1
        while span < LOOK_BACK:
            # the sum over twice as many bytes, from two sums over half as many
            shifted = np.zeros_like(rolled)
            shifted[span:] = rolled[:-span] << np.uint16(span)
            rolled = rolled + shifted
            span *= 2
        at = np.flatnonzero(rolled >> np.uint16(16 - BITS) == 0) + before + 1
        found.append(at[at > start])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def cuts(body: bytes) -> np.ndarray:
    """Where the chunks of a text end, in bytes; the last end is the text's.

    Whether a cut falls at a place is decided by the bytes around it and by no earlier
    cut, so an insertion changes the chunks it touches and no others. Cuts move on to the
    next start of a word, or of a character where no word starts near.
    """
    data = np.frombuffer(body, np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    at = _possible(data)
    if len(at):
        at = at[np.concatenate([[True], np.diff(at) >= LEAST])]
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        words = np.append(np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, len(data))
        letters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        word = words[np.searchsorted(words, at)]
        letter = letters[np.searchsorted(letters, at)]
        at = np.unique(np.where(word - at <= WORD, word, letter))
    at = at[(at > 0) & (at < len(data))]
    edges = np.concatenate([[0], at, [len(data)]])
    wide = np.flatnonzero(np.diff(edges) > MOST)
    if len(wide):
        letters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        more = [np.arange(edges[i] + MOST, edges[i + 1], MOST) for i in wide]
        more = letters[np.searchsorted(letters, np.concatenate(more))]
        edges = np.unique(np.concatenate([edges, more]))
    return edges[1:]


def windows(ends: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """``(last, before)``: the runs of chunks that hold ``span`` bytes, by their first chunk.

    The shortest run from chunk ``i`` ends with chunk ``last[i]``, and the longer ones with
    the chunks up to ``before[i]``, without it: those that hold fewer bytes without ``i``.
    So a stretch of chunks, of ``span`` bytes or more, is the union of the runs inside it.
    """
    begins = np.concatenate([[0], ends[:-1]])
    last = np.searchsorted(ends, begins + span)
    return last, np.maximum(np.append(last[1:], len(ends)), last + 1)


def chunk_runs(df: DataFrame, span: int = SPAN) -> DataFrame:
    """``(id, of, h1, h2, start, stop, more)`` of the runs of ``span`` bytes of ``(id, of, text)``.

    One row for each chunk that begins one. The 96 bits of the shortest run's digest are
    ``h1`` and ``h2``; ``more`` are the digests and ends of the longer ones, null for none.
    Offsets are in bytes.
    """

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, stops, digests, sizes, longer, longer_stops = [], [], [], [], [], [], []
            held = 0
            for row, text in enumerate(batch.column("text")):
                body = text.as_buffer().to_pybytes() if text.is_valid else b""
                ends = cuts(body)
                if len(ends):
                    last, before = windows(ends, span)
                    n = int(np.searchsorted(last, len(ends)))  # from there on, fewer bytes are left
                    begins = np.concatenate([[0], ends[:-1]])[:n]
                    last, more = last[:n], before[:n] - last[:n] - 1
                    digest = hashlib.blake2b
                    digests += [digest(body[a:b], digest_size=12).digest() for a, b in zip(begins.tolist(), ends[last].tolist())]
                    of = np.repeat(np.arange(n), more)
                    at = last[of] + 1 + np.arange(len(of)) - np.repeat(np.cumsum(more) - more, more)
                    longer += [digest(body[a:b], digest_size=8).digest() for a, b in zip(begins[of].tolist(), ends[at].tolist())]
                    rows.append(np.full(n, row))
                    starts.append(begins)
                    stops.append(ends[last])
                    sizes.append(more)
                    longer_stops.append(ends[at])
                    held += n
                if rows and (held >= 200_000 or row == batch.num_rows - 1):
                    at = pa.array(np.concatenate(rows).astype(np.int64))
                    digest_of = np.frombuffer(b"".join(digests), [("h1", "<i8"), ("h2", "<i4")])
                    ends_of = (pa.array(np.concatenate(part).astype(np.int32)) for part in (starts, stops))
                    size = np.concatenate(sizes)
                    runs = pa.StructArray.from_arrays(
                        [pa.array(np.frombuffer(b"".join(longer), "<i8").copy()), pa.array(np.concatenate(longer_stops).astype(np.int32))],
                        ["digest", "stop"],
                    )
                    offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("id").take(at), batch.column("of").take(at),
                            pa.array(digest_of["h1"].copy()), pa.array(digest_of["h2"].copy()), *ends_of,
                            pa.ListArray.from_arrays(offsets, runs, mask=pa.array(size == 0)),
                        ],
                        ["id", "of", "h1", "h2", "start", "stop", "more"],
                    )
                    rows, starts, stops, digests, sizes, longer, longer_stops, held = [], [], [], [], [], [], [], 0

    kind = df.schema["id"].dataType.simpleString()
    return df.mapInArrow(
        chunked, f"id {kind}, of bigint, h1 bigint, h2 int, start int, stop int, more array<struct<digest: bigint, stop: int>>"
    )


def repeated_passages(df: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """``(id, of, start, stop, first_ids)`` of every passage that earlier ones repeat.

    The first holder of a run of chunks that is ``span`` bytes long or just longer, by id,
    then by the 64-bit hash ``of`` its text, then by place, keeps it; a null id comes first. A
    passage is what such runs cover elsewhere without a gap, so each of its bytes lies in
    ``span`` bytes that one earlier place holds in one piece, whatever else of the passage
    other documents hold first. A run that overlaps its first holder is none.
    ``first_ids`` are the ids of the first holders, and may hold the document itself. Rows
    with the same id and text are one document. Null and empty texts hold nothing, and an
    empty table gives no rows; a null id is not listed among ``first_ids``. Texts of any
    length are cut into chunks whole.

    A run that very many documents share is counted before the shuffle, and the join
    that marks its holders can be split: nothing gathers them. Documents are read twice.
    """
    docs = df.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text is not null")
    docs = docs.select("id", F.xxhash64("text").alias("of"), "text")
    found = chunk_runs(docs, span)
    # most runs are unique: a part of the digest, counted alone, tells so at the least cost, and
    # a longer run is repeated only where the shortest from the same chunk is;
    # what is joined is written first, so that both joins can be split where a run is hot
    common = materialise(found.groupBy("h1").count().where("count > 1").select("h1"), "common")
    found = materialise(found.join(common, "h1"), "runs")
    shortest = F.array(F.struct(F.lit(None).cast("bigint").alias("digest"), F.col("stop")))
    runs = F.when(F.col("more").isNull(), shortest).otherwise(F.concat(shortest, "more"))
    found = found.select("id", "of", "h1", "h2", "start", F.inline(runs)).withColumn("digest", F.coalesce("digest", F.lit(0)))
    place = F.struct(F.col("id").isNotNull().alias("known"), "id", "of", "start")
    firsts = found.groupBy("h1", "h2", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    firsts = materialise(firsts.where("n > 1").select("h1", "h2", "digest", "first"), "firsts")
    again = found.join(firsts, ["h1", "h2", "digest"]).select("id", "of", "start", "stop", "first", place.alias("own"))
    here = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("of") == F.col("first.of"))
    overlaps = here & (F.col("first.start") + F.col("stop") - F.col("start") > F.col("start"))
    again = again.where((F.col("own") != F.col("first")) & ~overlaps)
    again = again.groupBy("id", "of", "start", "stop").agg(F.min("first.id").alias("first_id"))
    inside = W.partitionBy("id", "of").orderBy("start", "stop")
    reached = F.max("stop").over(inside.rowsBetween(W.unboundedPreceding, -1))
    runs = again.withColumn("fresh", F.coalesce(reached < F.col("start"), F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("fresh").over(inside))
    return runs.groupBy("id", "of", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sort_array(F.collect_set("first_id")).alias("first_ids")
    ).drop("run")


def _cut(df: DataFrame, doc_id: str, text: str, span: int) -> DataFrame:
    """``(row, passages, first_ids)``: the rows that change, with their text cut."""
    spans = repeated_passages(df, doc_id, text, span)
    spans = spans.groupBy("id", "of").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("passages"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("first_ids")))).alias("first_ids"),
    )
    spans = spans.withColumnsRenamed({"id": "cut id", "of": "cut of"})
    columns = [F.col(f"`{c}`") for c in df.columns]
    rows = df.select(F.struct(*columns).alias("row"), F.col(f"`{text}`").alias("t"), F.col(f"`{doc_id}`").alias("id"))

    @F.pandas_udf("string")
    def kept(texts: pd.Series, passages: pd.Series) -> pd.Series:
        out = []
        for body, cut in zip(texts, passages):
            data, parts, at = body.encode(), [], 0
            for one in cut:
                parts.append(data[at : one["start"]])
                at = one["stop"]
            out.append(b"".join([*parts, data[at:]]).decode("utf-8", "replace"))
        return pd.Series(out, dtype="object")

    same = F.col("id").eqNullSafe(F.col("cut id")) & (F.xxhash64("t") == F.col("cut of"))
    cut = rows.join(spans, same).withColumn("t", kept("t", "passages"))
    changed = [F.col("t").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in df.columns]
    return cut.select(F.struct(*changed).alias("row"), "passages", "first_ids")


def cut_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """The documents that repeat passages of others: ``df``'s columns, ``text`` without the passages.

    ``passages`` lists what was cut, as ``(start, stop)`` in bytes of the whole text, and
    ``first_ids`` the documents that keep it. Columns so named are replaced. Documents
    without repeated passages are not in the result: they stay as they are.
    """
    own = [F.col("row").getField(c).alias(c) for c in df.columns if c not in ("passages", "first_ids")]
    return _cut(df, doc_id, text, span).select(*own, "passages", "first_ids")


def drop_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """All rows of ``df``, with ``text`` cut where ``cut_repeats`` cuts it."""
    spans = materialise(repeated_passages(df, doc_id, text, span).select("id", "of").distinct(), "cut")
    spans = spans.withColumnsRenamed({"id": "cut id", "of": "cut of"})
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("cut id")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("cut of"))
    return df.join(spans, same, "left_anti").union(_cut(df, doc_id, text, span).select("row.*"))
