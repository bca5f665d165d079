"""Byte-level BPE by dynamic programming over prefixes."""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import Memo, worker_store

#: The Unicode white space, and the pattern that cuts text before the merges.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^%s\p{L}\p{N}]+|[%s]+(?![^%s])|[%s]+" % ((WHITE,) * 4)


def _letters() -> str:
    """The letters of the basic plane, as the inside of a character class."""
    known = [chr(c).isalpha() for c in range(0x10000)] + [False]
    starts = [c for c in range(0x10000) if known[c] and not known[c - 1]]
    ends = [next(c for c in range(start, 0x10001) if not known[c]) - 1 for start in starts]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends))


#: Units hold whole pieces: a run of letters with the space before it, unless a letter from
#: beyond the basic plane follows; whatever else stands between white space; white space.
UNITS = " ?[%s]++(?![\U00010000-\U0010ffff])| ?[^%s]+|[%s]+(?![^%s])|[%s]+" % (_letters(), *(WHITE,) * 4)

#: Units that a worker remembers at least, prefixes, pairs of tokens, steps of the automaton.
REMEMBERED = 200_000
PREFIXES = 150_000
PAIRS = 80_000
TRANSITIONS = 50_000
#: Rows that are worked on together.
TOGETHER = 200
#: Bytes of a piece whose prefixes are remembered; longer pieces are hardly ever met again.
REPEATED = 48
#: Characters of a text that are cut into units at once.
BLOCK = 1 << 18


def _alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizer:
    """Encodes and decodes like the vocabulary file it is built from.

    Bytes are held as Latin-1 strings. For every prefix of a piece there is exactly one
    token that can end its encoding: of the tokens that are a suffix of the prefix, the
    one compatible with the last token of the prefix before it.
    """

    def __init__(self, definition: str) -> None:
        parsed = json.loads(definition)
        alphabet, model = _alphabet(), parsed["model"]
        spelt = {t: "".join(chr(alphabet[c]) for c in t) for t in model["vocab"]}
        special = {t["content"]: t["id"] for t in parsed.get("added_tokens") or ()}
        self.special = special
        self.split = re.compile("(%s)" % "|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.of = {spelt[t]: i for t, i in model["vocab"].items() if t not in special}
        size = max([*model["vocab"].values(), *special.values()]) + 1
        self.bytes = [b""] * size
        for text, i in self.of.items():
            self.bytes[i] = text.encode("latin-1")
        for text, i in special.items():
            self.bytes[i] = text.encode()
        self.names = [str(i) for i in range(size)]
        self.lengths = [len(b) for b in self.bytes]

        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        vocab = model["vocab"]
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = (vocab[left], vocab[right])
            self.rank[pair] = rank
            self.parts.setdefault(vocab[left + right], (*pair, rank))

        self._build_automaton()
        self.units = re.compile(UNITS)
        self.pieces = regex.compile(PIECES)
        self.compatible = Memo(self._compatible, PAIRS)
        self.sound = Memo(self._sound, PAIRS)
        self.remembered = Memo(self._encode_unit, REMEMBERED)
        self._forget_prefixes()

    def _forget_prefixes(self) -> None:
        """A trie of prefixes met, each with its state and its last token."""
        self.prefixes: dict[int, int] = {}
        self.states, self.last = [0], [-1]

    def _build_automaton(self) -> None:
        """The automaton over the vocabulary that knows every token a prefix ends with.

        ``longest[state]`` is the longest of them, ``shorter[token]`` the next one down.
        """
        self.edges: dict[int, int] = {}
        self.fallback, token_of, parent = [0], [-1], [(0, 0)]
        at = {}
        for text, token in self.of.items():
            state = 0
            for byte in text.encode("latin-1"):
                key = state << 8 | byte
                state = self.edges.setdefault(key, len(token_of))
                if state == len(token_of):
                    token_of.append(-1)
                    parent.append((key >> 8, byte))
                    self.fallback.append(0)
            token_of[state], at[token] = token, state
        depth = [0] * len(token_of)
        for state in range(1, len(token_of)):
            depth[state] = depth[parent[state][0]] + 1
        self.longest = [-1] * len(token_of)
        self.step = Memo(self._step, TRANSITIONS)
        for state in sorted(range(1, len(token_of)), key=depth.__getitem__):
            above, byte = parent[state]
            if above:
                self.fallback[state] = self._step(self.fallback[above] << 8 | byte)
            own = token_of[state]
            self.longest[state] = own if own >= 0 else self.longest[self.fallback[state]]
        self.shorter = {token: self.longest[self.fallback[state]] for token, state in at.items()}

    def _step(self, key: int) -> int:
        state, byte = key >> 8, key & 255
        while (found := self.edges.get(state << 8 | byte)) is None and state:
            state = self.fallback[state]
        return found or 0

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at an edge while a token was merged, each with the rank that ended it."""
        found, ended = [(token, float("inf"))], token
        while ended in self.parts:
            parts = self.parts[ended]
            found.append((parts[side], parts[2]))
            ended = parts[side]
        return found

    def _compatible(self, pair: int) -> bool:
        """Whether the merges of two tokens' bytes end as these two tokens.

        They do not if, while both edges stood side by side, a merge across came before
        the one that used up either; of equal merges the one further left comes first.
        """
        right = self._spine(pair & 0xFFFFF, 0)
        for a, a_ends in self._spine(pair >> 20, 1):
            for b, b_ends in right:
                across = self.rank.get((a, b))
                if across is not None and across < a_ends and across <= b_ends:
                    return False
        return True

    def _sound(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as the token."""
        if token not in self.parts:
            return self.lengths[token] == 1
        left, right, rank = self.parts[token]
        return self.sound[left] and self.sound[right] and self.compatible_until(left, right, rank)

    def compatible_until(self, left: int, right: int, rank: int) -> bool:
        """Whether two tokens stand side by side when the merge of that rank comes."""
        inner = self._spine(right, 0)
        for a, a_ends in self._spine(left, 1):
            for b, b_ends in inner:
                across = self.rank.get((a, b))
                if across is not None and (a, b) != (left, right):
                    if across < min(a_ends, rank) and across <= min(b_ends, rank):
                        return False
        return True

    def _encode_piece(self, piece: str) -> list[int]:
        data = piece.encode("utf-8", "surrogatepass")
        if len(data) > REPEATED:
            last = self._extend([], 0, data)
        else:
            # the last token of a prefix never depends on what follows, so prefixes are shared
            if len(self.last) > PREFIXES:
                self._forget_prefixes()
            prefixes, states, lasts = self.prefixes, self.states, self.last
            last, node = [], 0
            for byte in data:
                key = node << 8 | byte
                child = prefixes.get(key)
                if child is None:
                    child = prefixes[key] = len(lasts)
                    state = self.step[states[node] << 8 | byte]
                    states.append(state)
                    lasts.append(self._last_token(last, state))
                last.append(lasts[child])
                node = child
        lengths, found, end = self.lengths, [], len(data)
        while end:
            token = last[end - 1]
            found.append(token)
            end -= lengths[token]
        found.reverse()
        return found

    def _last_token(self, last: list[int], state: int) -> int:
        """The token that ends the encoding of the next prefix: the compatible suffix."""
        token, end = self.longest[state], len(last) + 1
        while True:
            start = end - self.lengths[token]
            if self.compatible[last[start - 1] << 20 | token] if start else self.sound[token]:
                return token
            token = self.shorter[token]

    def _extend(self, last: list[int], state: int, data: bytes) -> list[int]:
        for byte in data:
            state = self.step[state << 8 | byte]
            last.append(self._last_token(last, state))
        return last

    def _encode_unit(self, unit: str) -> bytes:
        word = unit[1:] if unit[0] == " " else unit
        pieces = [unit] if word.isalpha() else self.pieces.findall(unit)
        return array("I", chain.from_iterable(map(self._encode_piece, pieces))).tobytes()

    def _cut(self, text: str) -> Iterator[list[str]]:
        """The units of a text, in blocks: between two of them stands a space for sure."""
        start = 0
        while len(text) - start > BLOCK:
            end = start + BLOCK
            safe = regex.compile(r"(?<=[^%s]) (?=[^%s])" % (WHITE, WHITE)).search(text, end)
            if safe is None:
                break
            yield self.units.findall(text[start : safe.start()])
            start = safe.start()
        yield self.units.findall(text[start:] if start else text)

    def encode(self, text: str | None) -> np.ndarray:
        found: list[bytes] = []
        known = self.remembered
        parts = self.split.split(text or "") if self.split else [text or ""]
        for at, part in enumerate(parts):
            if at % 2:
                found.append(array("I", [self.special[part]]).tobytes())
            elif part:
                for units in self._cut(part):
                    found.append(b"".join(map(known.__getitem__, units)))
        return np.frombuffer(b"".join(found), np.uint32).astype(np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become the replacement character."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def digests(self, text: str | None) -> tuple[int, str, str]:
        ids = self.encode(text).tolist()
        listed = ",".join(map(self.names.__getitem__, ids))
        decoded = self.decode(ids).encode("utf-8", "surrogatepass")
        return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def _on_workers(spark: SparkSession, path: str):
    """A function that gives each worker its tokenizer; the file is read on the driver alone."""
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    sent, key = spark.sparkContext.broadcast(definition), hashlib.sha256(definition.encode()).hexdigest()
    return lambda: worker_store(("bpe", key), lambda: Tokenizer(sent.value))


def _with(df: DataFrame, path: str, source: str, added: dict[str, tuple], make) -> DataFrame:
    """``df`` with columns made by ``make(tokenizer, value of source)``; columns so named are replaced.

    Rows are worked on a few at a time, so that a worker holds the results of a few texts.
    """
    tokenizer = _on_workers(df.sparkSession, path)
    kept = [c for c in df.columns if c not in added]
    place, places = df.columns.index(source), [df.columns.index(c) for c in kept]
    kinds = [kind for _, kind in added.values()]
    fields = [df.schema[c] for c in kept] + [T.StructField(c, kind) for c, (kind, _) in added.items()]

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(start, TOGETHER)
                made = zip(*[make(tokenizer(), value) for value in part.column(place).to_pylist()])
                new = [pa.array(values, kind) for values, kind in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([part.column(at) for at in places] + new, [*kept, *added])

    return df.mapInArrow(worked, T.StructType(fields))


IDS, TEXT, NUMBER = (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), (T.StringType(), pa.string()), (T.LongType(), pa.int64())


def encode(df: DataFrame, path: str, text: str = "text", column: str = "ids") -> DataFrame:
    """``df`` with the token ids of its whole text; null is encoded like the empty text."""
    return _with(df, path, text, {column: IDS}, lambda t, value: (t.encode(value),))


def decode(df: DataFrame, path: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``df`` with the text of its token ids, special tokens spelt out; null ids give the empty text."""
    return _with(df, path, ids, {column: TEXT}, lambda t, value: (t.decode(value or ()),))


def round_trip(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids``, ``n_tokens`` and ``decoded``: ``encode`` and ``decode`` in one pass.

    Null and empty texts have no ids and decode to the empty text. A text of any length is
    encoded whole, piece by piece; every row is kept, repeated ones too, and an empty table
    stays empty. Columns of the three names are replaced, all others kept.
    """

    def both(tokenizer: Tokenizer, value: str | None) -> tuple:
        ids = tokenizer.encode(value)
        return ids, len(ids), tokenizer.decode(ids.tolist())

    return _with(df, path, text, {"ids": IDS, "n_tokens": NUMBER, "decoded": TEXT}, both)


def digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens``, and SHA-256 of the listed ids and of the decoded text.

    What ``encode`` and ``decode`` give, without moving the ids of whole texts between
    processes. Null and empty texts have no ids. Rows, long texts, empty tables and columns
    of the same names are treated as by ``round_trip``.
    """
    added = {"n_tokens": NUMBER, "ids_sha256": TEXT, "decoded_sha256": TEXT}
    return _with(df, path, text, added, lambda t, value: t.digests(value))
