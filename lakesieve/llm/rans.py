"""A static range asymmetric numeral system over arrays of ids, with checkpoints and checksums."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np

#: Interleaved states of a block, and ids of a block that are encoded one after another.
LANES, BLOCK = 32, 65_536
#: Steps between two checkpoints; a step takes one id into every lane.
STEPS = 512
#: States lie in [LOW, LOW << 32) and are refilled by words of 32 bits.
LOW = 1 << 31
#: Frequencies of a table add up to two to this power, unless it has too many ids for that.
BITS = 20

#: Of a block: the number of its ids, of bytes that follow, their checksum begun with the number of ids, and that of the ids.
_HEAD = "<IIII"
HEAD_BYTES = struct.calcsize(_HEAD)
ONE, WORD = np.uint64(1), np.uint64(32)


class Damaged(ValueError):
    """Encoded bytes do not agree with their checksum, table or length."""


@dataclass(frozen=True)
class Table:
    """How often each id occurs, scaled to a power of two; one for all blocks that share it.

    ``ids`` ascend; ``start`` is the sum of the frequencies before.
    """

    ids: np.ndarray
    frequency: np.ndarray
    bits: int

    @classmethod
    def of(cls, counts: Mapping[int, int]) -> Table:
        """A table of every id that occurs: one each, and the rest of the room in proportion.

        What rounding leaves goes to the ids that occur most often.
        """
        ids = sorted(counts)
        bits = max(BITS, max(len(ids), 1).bit_length() + 2)
        room, total = (1 << bits) - len(ids), sum(counts.values())
        frequency = [1 + counts[i] * room // total for i in ids]
        left = (1 << bits) - sum(frequency)
        for at in sorted(range(len(ids)), key=lambda at: (-counts[ids[at]], at))[:left]:
            frequency[at] += 1
        return cls(np.array(ids, np.int64), np.array(frequency, np.uint64), bits)

    @property
    def crc(self) -> int:
        return zlib.crc32(self.frequency.astype("<u8").tobytes(), zlib.crc32(self.ids.astype("<i8").tobytes()))

    def start(self) -> np.ndarray:
        return np.cumsum(self.frequency) - self.frequency


class Encoder:
    def __init__(self, table: Table) -> None:
        self.table = table
        self.frequency, self.start = table.frequency, table.start()
        self.place = np.full(int(table.ids[-1]) + 1 if len(table.ids) else 0, -1, np.int64)
        self.place[table.ids] = np.arange(len(table.ids))

    def blocks(self, ids: np.ndarray) -> list[bytes]:
        """The blocks of some ids, each of which can be decoded by itself."""
        at = np.asarray(ids, np.int64)
        if len(at) and (at.max() >= len(self.place) or (self.place[at] < 0).any()):
            raise ValueError("an id is not in the table")
        whole = len(at) // BLOCK * BLOCK
        found = self._encode(at[:whole].reshape(-1, BLOCK)) if whole else []
        return found + (self._encode(at[None, whole:]) if whole < len(at) else [])

    def _encode(self, rows: np.ndarray) -> list[bytes]:
        """Blocks of one length, side by side. The last id is repeated until all lanes are full."""
        n = rows.shape[1]
        steps = -(-n // LANES)
        symbols = self.place[np.pad(rows, ((0, 0), (0, steps * LANES - n)), "edge")].reshape(len(rows), steps, LANES)
        shift, room = np.uint64(self.table.bits), np.uint64(63 - self.table.bits)
        state = np.full((len(rows), LANES), LOW, np.uint64)
        full, words = np.zeros(symbols.shape, bool), np.zeros(symbols.shape, np.uint32)
        states = np.zeros((len(rows), -(-steps // STEPS), LANES), np.uint64)
        for step in range(steps - 1, -1, -1):
            symbol = symbols[:, step]
            frequency = self.frequency[symbol]
            over = state >= frequency << room
            full[:, step], words[:, step] = over, state.astype(np.uint32)
            state = np.where(over, state >> WORD, state)
            times = state // frequency
            state = (times << shift) + (state - times * frequency) + self.start[symbol]
            if step % STEPS == 0:
                states[:, step // STEPS] = state
        out = []
        for row in range(len(rows)):
            per_step = full[row].sum(axis=1)
            begins = (np.cumsum(per_step) - per_step)[::STEPS]
            body = states[row].astype("<u8").tobytes() + begins.astype("<u4").tobytes() + words[row][full[row]].astype("<u4").tobytes()
            checked = zlib.crc32(rows[row].astype("<u4").tobytes())
            out.append(struct.pack(_HEAD, n, len(body), zlib.crc32(body, n), checked) + body)
        return out


class Decoder:
    def __init__(self, table: Table) -> None:
        self.table = table
        self.ids, self.frequency, self.start = table.ids, table.frequency, table.start()
        self.symbol = np.repeat(np.arange(len(table.ids), dtype=np.int32), table.frequency.astype(np.int64))

    def blocks(self, data: bytes, start: int = 0) -> np.ndarray:
        """The ids of the blocks from ``start`` to the end of ``data``.

        All stretches between checkpoints, of all blocks, are decoded side by side.
        """
        heads, at = [], start
        while at < len(data):
            if at + HEAD_BYTES > len(data):
                raise Damaged("a block's head is cut off")
            n, size, crc, checked = struct.unpack_from(_HEAD, data, at)
            at += HEAD_BYTES
            if at + size > len(data) or zlib.crc32(memoryview(data)[at : at + size], n) != crc:
                raise Damaged("a block's bytes do not agree with their checksum")
            heads.append((n, at, size, checked))
            at += size
        states, places, steps, bodies, base = [], [], [], [], 0
        for n, at, size, _ in heads:
            total = -(-n // LANES)
            points = -(-total // STEPS)
            states.append(np.frombuffer(data, "<u8", points * LANES, at).reshape(points, LANES))
            begins = np.frombuffer(data, "<u4", points, at + 8 * points * LANES)
            fixed = points * (8 * LANES + 4)
            body = np.frombuffer(data, "<u4", (size - fixed) // 4, at + fixed)
            places.append(begins.astype(np.int64) + base)
            steps.append(np.minimum(STEPS, total - np.arange(points) * STEPS))
            bodies.append(body)
            base += len(body)
        if not heads:
            return np.zeros(0, np.int64)
        words = np.concatenate([*bodies, np.zeros(LANES, np.uint32)]).astype(np.uint64)
        state, place, step = np.concatenate(states).astype(np.uint64), np.concatenate(places), np.concatenate(steps)
        found = [np.zeros(0, np.int64)] * len(step)
        for count in np.unique(step):
            which = np.flatnonzero(step == count)
            for at, ids in zip(which, self._decode(state[which], place[which], int(count), words)):
                found[at] = ids
        out, at = [], 0
        for n, _, _, checked in heads:
            points = -(-(-(-n // LANES)) // STEPS)
            ids = np.concatenate(found[at : at + points])[:n] if points else np.zeros(0, np.int64)
            if zlib.crc32(ids.astype("<u4").tobytes()) != checked:
                raise Damaged("decoded ids do not agree with their checksum")
            out.append(ids)
            at += points
        return np.concatenate(out)

    def _decode(self, state: np.ndarray, place: np.ndarray, steps: int, words: np.ndarray) -> np.ndarray:
        """``steps`` steps of some stretches, from the states and words at which they begin."""
        shift, low = np.uint64(self.table.bits), np.uint64(LOW)
        mask = (ONE << shift) - ONE
        found = np.empty((len(state), steps, LANES), np.int32)
        for step in range(steps):
            slot = state & mask
            symbol = self.symbol[slot]
            found[:, step] = symbol
            state = self.frequency[symbol] * (state >> shift) + slot - self.start[symbol]
            empty = state < low
            taken = np.cumsum(empty, axis=1)
            word = words[np.minimum(place[:, None] + taken - empty, len(words) - 1)]
            state = np.where(empty, state << WORD | word, state)
            place = place + taken[:, -1]
        return self.ids[found.reshape(len(state), steps * LANES)]
