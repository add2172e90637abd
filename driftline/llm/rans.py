"""Static range asymmetric numeral system over token ids, interleaved over lanes so that numpy steps all lanes at once.

Segment: a run of whole documents with one frequency table, shared by its blocks. Block: ``BLOCK`` ids of the segment;
id ``i`` of a block belongs to lane ``i % LANES``. A block is decoded from its own states alone, and a checkpoint in it
(the states and the word position before a step) lets a decoder begin there. A crc32 of its ids guards each stretch from
one checkpoint to the next, so whoever begins at one is as sure as who reads the whole block.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

BITS = 20
LANES = 1024
BLOCK = 1 << 18
#: Steps between checkpoints in a block.
EVERY = 128
LOW = np.uint64(1 << 31)


class Corrupt(ValueError):
    pass


@dataclass
class Table:
    """Frequencies that sum to 2**BITS, of the symbols that occur."""

    symbols: np.ndarray
    freqs: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        counts = np.bincount(ids) if len(ids) else np.empty(0, np.int64)
        symbols = np.flatnonzero(counts)
        total = 1 << BITS
        if not len(symbols):
            return cls(symbols.astype(np.uint32), symbols.astype(np.uint32))
        if len(symbols) > total:
            raise ValueError("more symbols than slots")
        share = counts[symbols] * (total / max(1, counts.sum()))
        freqs = np.maximum(1, np.floor(share)).astype(np.int64)
        rest = total - int(freqs.sum())
        order = np.argsort(-freqs, kind="stable")
        if rest > 0:
            freqs[order[0]] += rest
        for i in order:  # takes the excess from the most frequent symbols
            if rest >= 0:
                break
            give = min(int(freqs[i]) - 1, -rest)
            freqs[i] -= give
            rest += give
        return cls(symbols.astype(np.uint32), freqs.astype(np.uint32))

    def pack(self) -> bytes:
        return zlib.compress(np.concatenate([np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4"), self.freqs.astype("<u4")]).tobytes(), 6)

    @classmethod
    def unpack(cls, data: bytes) -> Table:
        both = np.frombuffer(zlib.decompress(data), "<u4")
        n = len(both) // 2
        table = cls(np.cumsum(both[:n]).astype(np.uint32), both[n:])
        if n and int(table.freqs.sum()) != 1 << BITS:
            raise Corrupt("frequency table")
        return table

    def wide(self) -> tuple[np.ndarray, np.ndarray]:
        """Frequency and cumulated frequency by symbol."""
        n = int(self.symbols[-1]) + 1 if len(self.symbols) else 1
        freq, cum = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        freq[self.symbols] = self.freqs
        cum[self.symbols] = np.cumsum(self.freqs) - self.freqs
        return freq, cum

    def slots(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.symbols)), self.freqs)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def encode_block(ids: np.ndarray, freq: np.ndarray, cum: np.ndarray) -> dict:
    n = len(ids)
    steps = -(-n // LANES)
    state = np.full(LANES, LOW, np.uint64)
    out, points, words = [], [], 0
    shift, bits = np.uint64(32), np.uint64(BITS)
    f_all, c_all = freq[ids], cum[ids]
    top = f_all << np.uint64(63 - BITS)  # ((LOW >> BITS) << 32) * f
    for t in range(steps - 1, -1, -1):
        a, b = t * LANES, min(n, (t + 1) * LANES)
        x, f = state[: b - a], f_all[a:b]
        over = x >= top[a:b]
        if over.any():
            out.append(x[over].astype(np.uint32))
            words += len(out[-1])
            x = np.where(over, x >> shift, x)
        q = x // f
        state[: b - a] = (q << bits) + (x - q * f) + c_all[a:b]
        if t and t % EVERY == 0:
            points.append((t, words, state.copy()))
    return {
        "n": n,
        "crcs": [crc(ids[i : i + EVERY * LANES]) for i in range(0, n, EVERY * LANES)],
        "states": state.astype("<u8").tobytes(),
        "words": (np.concatenate(out[::-1]) if out else np.empty(0, np.uint32)).astype("<u4").tobytes(),
        "points": [{"step": t, "word": words - w, "states": s.astype("<u8").tobytes()} for t, w, s in points[::-1]],
    }


def decode_block(block: dict, table: Table, slots: np.ndarray, first: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids of a block from ``first`` to ``stop``, decoded from the checkpoint before; raises Corrupt if a stretch's checksum differs."""
    n = block["n"]
    stop = n if stop is None else min(stop, n)
    stretch = EVERY * LANES
    if first >= stop:
        return np.empty(0, np.uint32)
    since, until = first // stretch, -(-stop // stretch)
    if since:
        point = block["points"][since - 1]
        at, state = point["word"], np.frombuffer(point["states"], "<u8").copy()
    else:
        at, state = 0, np.frombuffer(block["states"], "<u8").copy()
    words = np.frombuffer(block["words"], "<u4").astype(np.uint64)
    freqs = table.freqs.astype(np.uint64)
    cum = np.cumsum(freqs) - freqs
    mask, bits, shift = np.uint64((1 << BITS) - 1), np.uint64(BITS), np.uint64(32)
    begin, end = since * stretch, min(n, until * stretch)
    ids = np.empty(end - begin, np.uint32)
    for a in range(begin, end, LANES):
        b = min(n, a + LANES)
        x = state[: b - a]
        slot = x & mask
        k = slots.take(slot.view(np.int64))
        ids[a - begin : b - begin] = k
        x = freqs.take(k) * (x >> bits) + slot - cum.take(k)
        low = np.flatnonzero(x < LOW)
        if len(low):
            if at + len(low) > len(words):
                raise Corrupt("words")
            x[low] = (x[low] << shift) | words[at : at + len(low)]
            at += len(low)
        state[: b - a] = x
    ids = table.symbols[ids]
    for i in range(since, until):
        if crc(ids[i * stretch - begin : (i + 1) * stretch - begin]) != block["crcs"][i]:
            raise Corrupt("checksum")
    return ids[first - begin : stop - begin]


def encode(ids: np.ndarray) -> tuple[bytes, list[dict]]:
    """Table and blocks of a segment."""
    table = Table.of(ids)
    freq, cum = table.wide()
    return table.pack(), [encode_block(ids[i : i + BLOCK], freq, cum) for i in range(0, len(ids), BLOCK)]


class Reader:
    """The ids of one segment, whole or in part."""

    def __init__(self, table: bytes, blocks: list[dict]):
        self.blocks = blocks
        self.table = Table.unpack(table) if blocks else None
        self.slots = self.table.slots() if blocks else None

    def ids(self, first: int = 0, stop: int | None = None) -> np.ndarray:
        parts, base = [np.empty(0, np.uint32)], 0
        for block in self.blocks:
            if base + block["n"] > first and (stop is None or base < stop):
                parts.append(decode_block(block, self.table, self.slots, max(0, first - base), None if stop is None else stop - base))
            base += block["n"]
        return np.concatenate(parts)


def decode(table: bytes, blocks: list[dict]) -> np.ndarray:
    return Reader(table, blocks).ids()
