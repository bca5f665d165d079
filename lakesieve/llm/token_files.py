"""Token ids in binary files: documents in order, entropy-coded, read back in parallel."""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, read_parquet, small_frame
from . import rans
from .bpe import _alphabet
from .common import Memo, worker_store

#: The id after every document.
END = 2
#: Ids of a frame, with the rest of its last document; and frames of a file, at most.
FRAME, FRAMES = 1 << 20, 16
#: A frame's first bytes, and those between it and the next.
MAGIC, AFTER = b"LSV1", "\nend of frame\n"
#: Distinct units whose ids a worker remembers, of at most so many characters.
REMEMBERED, UNIT = 200_000, 64
#: The marks between a Latin letter and a space: a piece of its own, if none is an apostrophe.
MARKS = r"[!-&(-/:-@\[-`{-~]"
LAST_MARKS = re.compile(rf"{MARKS}(?<=[a-zà-öø-ÿ].){MARKS}*(?=[ \n]|\Z)")

# magic, length of the whole, crc of the table, part, frame, documents, ids, length and crc of the index
_HEAD = "<4sQIQQIQII"
HEAD_BYTES = struct.calcsize(_HEAD)
ORDER = "_order"
#: The printable character that stands for each byte in a vocabulary file.
BYTES = {byte: sign for sign, byte in _alphabet().items() if byte > 127}


class Vocabulary:
    """The tokenizers library on units between spaces, whose ids are remembered.

    Where ``drops_white_space`` does not hold, a whole text goes to the library at once.
    """

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.apart = drops_white_space(self.tokenizer)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4")
        self.known, self.runs = Memo(self._ids, REMEMBERED), None
        if self.apart and runs_of_letters(self.tokenizer):
            self.runs = Memo(self._run, REMEMBERED)
            self.spelt = [np.array([i], self.kind).tobytes() for i in range(self.tokenizer.get_vocab_size(True))]
            self.added = [token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
            self.model = self.tokenizer.model

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _run(self, unit: str) -> bytes:
        """A run of lower Latin letters goes to the library's model without the steps before it."""
        if not unit.isalpha():
            return self._ids(unit)
        spelt = unit if unit.isascii() else unit.encode().decode("latin-1").translate(BYTES)
        return b"".join([self.spelt[token.id] for token in self.model.tokenize(spelt)])

    def encode(self, text: str | None, end: int | None) -> bytes:
        """The ids of a whole text, and ``end`` after them unless it is None, in ``kind``."""
        last = b"" if end is None else np.array([end], self.kind).tobytes()
        if not text:
            return last
        if not self.apart:
            return self._ids(text) + last
        known = self.known
        if self.runs is not None and is_latin(text):
            lower = text.lower()
            if not any(content in lower for content in self.added):
                known, text = self.runs, LAST_MARKS.sub(r" \g<0>", lower)
        units = text.replace("\n", " ").split(" ")
        if len(text) <= UNIT * len(units):
            return b"".join(map(known.__getitem__, units)) + last
        return b"".join([known[unit] if len(unit) <= UNIT else known.make(unit) for unit in units]) + last


def is_latin(text: str) -> bool:
    """Whether all characters are those of Latin-1, which combine with none and are lowered one by one."""
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def drops_white_space(tokenizer) -> bool:
    """Whether a text may be cut at spaces: they give no ids, and no step looks across one."""
    found = json.loads(tokenizer.to_str())
    normal = found.get("normalizer") or {"type": "Sequence", "normalizers": []}
    for step in normal.get("normalizers", [normal]):
        blank = step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " "
        if not blank and step["type"] not in ("NFC", "Lowercase"):
            return False
    cut = found.get("pre_tokenizer") or {"type": None}
    split = cut.get("pretokenizers", [cut])[0]
    if split["type"] != "Split" or split["behavior"] != "Removed" or not split["invert"]:
        return False
    # every alternative is a literal without a space, or a class that holds no white space
    pattern = split["pattern"].get("Regex", r"\s")
    plain = all(r"\s" not in part or part.startswith(r"[^\s") for part in pattern.split("|"))
    added = found["added_tokens"]
    return plain and " " not in pattern and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in added)


def runs_of_letters(tokenizer) -> bool:
    """Whether a run of letters between spaces, and one of marks after it, are pieces of their own.

    Given ``drops_white_space``, this is so if letters are lowered, a class of the pattern
    takes all letters, another all else, and bytes then go to the model without more ado.
    """
    found = json.loads(tokenizer.to_str())
    steps = (found.get("normalizer") or {}).get("normalizers", [])
    cut = found["pre_tokenizer"].get("pretokenizers", [])
    if "Lowercase" not in [step["type"] for step in steps] or len(cut) != 2 or found["model"].get("type") != "BPE":
        return False
    classes = [part for part in cut[0]["pattern"]["Regex"].split("|") if not part.startswith("'")]
    plain = cut[1]["type"] == "ByteLevel" and not cut[1]["add_prefix_space"] and not cut[1]["use_regex"]
    return plain and classes[:1] == [r"[\p{L}]+"] and classes[-1:] == [r"[^\s\p{L}\p{N}]+"]


def encode(df: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", end: int | None = END) -> DataFrame:
    """``(doc_id, ids)`` of every row; ``ids`` are those of the whole text as 16 or 32 bits each.

    A null text is encoded like the empty one: ``end`` alone. Texts of any length are encoded
    whole, repeated rows one by one; an empty table gives no row, whatever other columns it has.
    """
    with open(vocabulary, encoding="utf-8") as file:
        definition = file.read()
    sent, key = df.sparkSession.sparkContext.broadcast(definition), hashlib.sha256(definition.encode()).hexdigest()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_store(("tokenizer", key), lambda: Vocabulary(sent.value))
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [words.encode(text, end) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(encoded, T.StructType([rows.schema["doc_id"], T.StructField("ids", T.BinaryType())]))


def id_width(vocabulary: str) -> int:
    with open(vocabulary, encoding="utf-8") as file:
        return Vocabulary(file.read()).kind.itemsize


def _counted(tokens: DataFrame, kind: str) -> dict[int, int]:
    """How often each id occurs; as many numbers as the vocabulary has ids at most."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                ids = np.frombuffer(b"".join(batch.column(0).slice(start, 1024).to_pylist()), kind)
                found = np.bincount(ids, minlength=len(total))
                found[: len(total)] += total
                total = found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(total[ids].astype(np.int64))], ["id", "n"])

    parts = tokens.select("ids").mapInArrow(counted, "id bigint, n bigint")
    return {row["id"]: row["n"] for row in parts.groupBy("id").agg(F.sum("n").alias("n")).collect()}


def _index(documents: pa.Array, lengths: Iterable[int]) -> bytes:
    """The index of a frame: its documents' ids, of whatever type, and their numbers of ids."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([documents, pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _frame(encoder: rans.Encoder, crc: int, part: int, number: int, documents: pa.Array, ids: list[bytes], kind: np.dtype) -> bytes:
    flat = np.frombuffer(b"".join(ids), kind)
    index = _index(documents, [len(i) // kind.itemsize for i in ids])
    body = b"".join(encoder.blocks(flat))
    size = HEAD_BYTES + len(index) + len(body)
    return struct.pack(_HEAD, MAGIC, size, crc, part, number, len(ids), len(flat), len(index), zlib.crc32(index)) + index + body


def write(tokens: DataFrame, path: str, width: int) -> None:
    """Write ``(doc_id, ids)`` to a new folder ``path``, in ascending order of ``doc_id``, null first.

    ``path/table`` holds the frequencies that all files share. ``path/frames`` holds binary
    files of at most ``FRAMES`` frames; a frame holds whole documents, about ``FRAME`` ids,
    with an index, and independent blocks. Documents of one id are ordered by a hash of
    their ids; identical ones by where they are stored, so they can be dealt apart. An empty
    table gives a folder without frames.

    Files are written by Spark's own committer, so a lost task leaves nothing behind.
    """
    spark, kind = tokens.sparkSession, np.dtype(f"<u{width}")
    documents = tokens.schema["doc_id"]
    name = f"tokens-{hashlib.sha256(path.encode()).hexdigest()[:12]}"
    stored = materialise(tokens, name, row_id=True)
    counts = _counted(stored, kind.str)
    table = rans.Table.of(counts)
    rows = [{"id": i, "frequency": f, "bits": table.bits} for i, f in zip(table.ids.tolist(), table.frequency.tolist())]
    small_frame(spark, rows, "id bigint, frequency bigint, bits int").write.parquet(f"{path}/table")
    sent, crc = spark.sparkContext.broadcast(table), table.crc

    position = F.xxhash64("_row.file_path", "_row.row_index")
    keyed = stored.select("doc_id", "ids", F.xxhash64("ids").alias(ORDER), position.alias("position"))
    order = ["doc_id", ORDER, "position"]
    parts = sum(counts.values()) // (FRAME * FRAMES) + 1
    keyed = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    keyed = keyed.select("doc_id", "ids", F.spark_partition_id().alias("part"))

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_store(("rans encoder", crc), lambda: rans.Encoder(sent.value))
        held, ids, size, number, part = [], [], 0, 0, 0
        for batch in batches:
            rows, begin = batch.column("ids"), 0
            for at in range(batch.num_rows):
                ids.append(rows[at].as_py())
                size += len(ids[-1])
                if size >= FRAME * width:
                    part = batch.column("part")[at].as_py()
                    held.append(batch.column("doc_id").slice(begin, at + 1 - begin))
                    yield _one(_frame(encoder, crc, part, number, pa.concat_arrays(held), ids, kind))
                    held, ids, size, number, begin = [], [], 0, number + 1, at + 1
            if begin < batch.num_rows:
                part = batch.column("part")[begin].as_py()
                held.append(batch.column("doc_id").slice(begin))
        if ids:
            yield _one(_frame(encoder, crc, part, number, pa.concat_arrays(held), ids, kind))

    frames = keyed.mapInArrow(framed, "body binary")
    # a string's bytes are written as they are
    writer = frames.select(F.col("body").cast("string").alias("value")).write
    writer.option("lineSep", AFTER).option("maxRecordsPerFile", FRAMES).text(f"{path}/frames")
    meta = [{"kind": documents.dataType.simpleString(), "width": width}]
    small_frame(spark, meta, "kind string, width int").write.parquet(f"{path}/meta")


def _one(body: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["body"])


def _frames(content: bytes) -> Iterator[tuple]:
    """``(head, index, where the blocks begin, where the frame ends)`` of a file's frames."""
    at, after = 0, AFTER.encode()
    while at < len(content):
        if at + HEAD_BYTES > len(content):
            raise rans.Damaged("a frame's head is cut off")
        head = struct.unpack_from(_HEAD, content, at)
        end = at + head[1]
        if head[0] != MAGIC or content[end : end + len(after)] != after:
            raise rans.Damaged("a frame does not end where its head says")
        yield head, at + HEAD_BYTES, at + HEAD_BYTES + head[7], end
        at = end + len(after)


def _read(spark: SparkSession, path: str, added: dict[str, tuple[T.DataType, pa.DataType]], make: Callable) -> DataFrame:
    meta = spark.read.parquet(f"{path}/meta").first()
    rows = spark.read.parquet(f"{path}/table").orderBy("id").collect()
    table = rans.Table(
        np.array([r["id"] for r in rows], np.int64), np.array([r["frequency"] for r in rows], np.uint64), rows[0]["bits"] if rows else rans.BITS
    )
    sent, crc = spark.sparkContext.broadcast(table), table.crc
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/frames")

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                heads = [head for head, *_ in _frames(content.as_py())]
                columns = zip(*[(h[3], h[4], h[6]) for h in heads])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "frame", "n"])

    sizes = files.select("content").mapInArrow(sized, "part bigint, frame bigint, n bigint")
    sizes = materialise(sizes, "frames")
    # one row for each range partition, of FRAMES frames or so: what lies before it
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n").over(W.partitionBy("part").orderBy("frame")) - F.col("n")
    starts = sizes.withColumn("inside", inside).join(parts, "part")
    starts = materialise(starts.select("part", "frame", (F.col("before") + F.col("inside")).alias("begin")), "starts")

    kind = T._parse_datatype_string(meta["kind"])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = worker_store(("rans decoder", crc), lambda: rans.Decoder(sent.value))
        for batch in batches:
            for item in batch.column("content"):
                content = item.as_py()
                for head, index_at, blocks_at, end in _frames(content):
                    _, _, of, part, frame, _, n, length, index_crc = head
                    index = content[index_at : index_at + length]
                    if of != crc or zlib.crc32(index) != index_crc:
                        raise rans.Damaged("a frame's index or table is not the one it was written with")
                    listed = pa.ipc.open_stream(index).read_next_batch()
                    ids = decoder.blocks(content[blocks_at:end])
                    lengths = listed.column("n_tokens").to_numpy()
                    ends = np.cumsum(lengths)
                    if len(ids) != n or (len(ends) and ends[-1] != n):
                        raise rans.Damaged("a frame's documents do not have as many ids as its blocks")
                    fixed = [listed.column("doc_id"), pa.array(np.full(len(ends), part)), pa.array(np.full(len(ends), frame)),
                             pa.array(ends - lengths), pa.array(lengths)]
                    made = [pa.array(values, t) for values, (_, t) in zip(make(ids, ends - lengths, ends), added.values())]
                    yield pa.RecordBatch.from_arrays(fixed + made, ["doc_id", "part", "frame", "inside", "n_tokens", *added])

    fields = [T.StructField("doc_id", kind)] + [T.StructField(c, T.LongType()) for c in ("part", "frame", "inside", "n_tokens")]
    fields += [T.StructField(c, t) for c, (t, _) in added.items()]
    rows = files.select("content").mapInArrow(decoded, T.StructType(fields))
    rows = rows.join(starts, ["part", "frame"])
    return rows.select("doc_id", (F.col("begin") + F.col("inside")).alias("start"), "n_tokens", *added)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document in the files under ``path``.

    ``start`` counts the ids of all documents before it. Files are decoded side by side, and
    every stretch between two checkpoints of a frame with the others. What does not agree
    with its checksums raises ``Damaged``.
    """
    ids = (T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))
    return _read(spark, path, {"ids": ids}, lambda all_, a, b: [np.split(all_.astype(np.int32), b[:-1])])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``: as ``read``, with the CRC-32 of the ids as 32-bit numbers."""

    def checked(ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list:
        data = memoryview(ids.astype("<u4").tobytes())
        return [[zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]]

    return _read(spark, path, {"ids_crc32": (T.LongType(), pa.int64())}, checked)


def round_trip(df: DataFrame, path: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text", end: int | None = END) -> DataFrame:
    """Encode ``df``, write the ids to ``path``, and read them back as ``read_digests`` does.

    Every row is a document, repeated ids and null ids too. Null and empty texts are ``end``
    alone. A text of any length is encoded whole, and lies in one frame. Columns other than
    the two named are not looked at, whatever their names.
    """
    write(encode(df, vocabulary, doc_id, text, end), path, id_width(vocabulary))
    return read_digests(df.sparkSession, path)
