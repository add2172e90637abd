"""Exact batch tokenization with the ``tokenizers`` library, with repeated pieces encoded once.

A byte-level BPE vocabulary splits a text before every space that follows a non-space, so a text is the
concatenation of its space-separated pieces, each encoded with its leading space. It also splits after a run of letters, so
a piece is cut into the letters that it begins with and the rest, if that begins with some other ASCII character. These parts repeat a great
deal, so Arrow dictionary-encodes them and the library encodes each new part once; a bounded cache keeps those that come again.
A text where a space follows other white space, which ends with a space, or which may hold an added token of the vocabulary (such as
an end-of-text mark, which the library finds in texts too) goes through the library whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import KEPT, slices

#: Bytes of parts kept by one worker, about, with ``ENTRY`` for each besides its characters (places, ids, and its share of the table in which it is looked
#: up); beyond that those go that were met but once. Only speed depends on it.
CACHE_BYTES, ENTRY = 80 << 20, 80
#: Bytes of text that are encoded at once, or a single text. More find more repeats, and share one look through what is kept.
AT_ONCE = 8 << 20
#: Parts in one call of the library.
JOINED = 2000
#: Runs of ids that are put together at once.
RUNS = 1 << 16
#: White space of any kind before a space.
RUN = r"[\p{Z}\t\n\x0b\x0c\r\x1c-\x1f\x{85}] "
#: A piece in two parts. Only what is a letter in every version of Unicode counts as one, and only ASCII as no letter.
CUT = r"(?s)^(?P<letters>[A-Za-zÀ-ÖØ-öø-ɏ]+)(?P<rest>[\x00-@\[-`{-\x7f].*)$"


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.added = [str(t.content).strip() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = max(vocabulary.values()) + 1
        before = self.tokenizer.pre_tokenizer
        how = json.loads(before.__getstate__()) if before else {}
        #: whether it is known that the vocabulary splits after letters
        self.cuts = self.tokenizer.normalizer is None and how.get("type") == "ByteLevel" and how.get("use_regex", True)
        self.opens = np.zeros(self.size, bool)
        for token, i in vocabulary.items():
            self.opens[i] = token.startswith("Ġ")
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([""], pa.string())
        self.flat = np.empty(1 << 16, np.int32)
        self.used = 0
        self.start = np.zeros(1 << 15, np.int64)
        self.length = np.zeros(1 << 15, np.int64)
        self.again = np.zeros(1 << 15, bool)

    def held(self) -> int:
        """Bytes that the kept parts take, about."""
        return self.known.nbytes + ENTRY * len(self.known)

    def forget(self) -> None:
        """Drops parts that weren't met again since the last time, or all if they are still many."""
        old = np.flatnonzero(self.again[: len(self.known)])
        known = self.known.take(pa.array(old[old > 0]))
        old = old[old > 0]
        start, length, flat = self.start[old], self.length[old], self.flat
        self.clear()
        if known.nbytes + ENTRY * len(known) <= CACHE_BYTES // 2:
            self._keep(known, _runs(flat, start, length), length)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _keep(self, parts: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        have, n = len(self.known), len(parts)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while have + n > len(self.start):
            self.start = np.concatenate([self.start, np.empty_like(self.start)])
            self.length = np.concatenate([self.length, np.empty_like(self.length)])
            self.again = np.concatenate([self.again, np.zeros_like(self.again)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.length[have : have + n] = lengths
        self.start[have : have + n] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        self.known = pa.concat_arrays([self.known, parts])

    def _learn(self, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and lengths of new parts that open with a space, many in a call; a token that does so too marks where the next one begins."""
        for i in range(0, len(parts), JOINED):
            some = parts[i : i + JOINED]
            ids = np.asarray(self.whole(["".join(some)])[0], np.int32)
            at = np.flatnonzero(self.opens[ids])
            if len(at) == len(some) and at[0] == 0:
                yield ids, np.diff(np.append(at, len(ids)))
            else:
                yield from self._learn_each(some)

    def _learn_each(self, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(parts), JOINED):
            each = self.whole(parts[i : i + JOINED])
            yield np.fromiter(chain.from_iterable(each), np.int32), np.array([len(e) for e in each], np.int64)

    def _slots(self, parts: pa.Array, learn: Callable[[list[str]], Iterator[tuple[np.ndarray, np.ndarray]]]) -> np.ndarray:
        """Where each of the parts is kept, new ones after they were learned."""
        coded = parts.dictionary_encode()
        distinct = coded.dictionary
        slots = pc.fill_null(pc.index_in(distinct, value_set=self.known), -1).to_numpy().astype(np.int64)
        self.again[slots[slots >= 0]] = True
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = len(self.known) + np.arange(len(new))
            fresh = distinct.take(pa.array(new))
            ids, lengths = zip(*learn(fresh.to_numpy(zero_copy_only=False).tolist()))
            self._keep(fresh, np.concatenate(ids), np.concatenate(lengths))
        return slots[coded.indices.to_numpy(zero_copy_only=False)]

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of pieces that follow a space, one after another, and how many each has."""
        if self.held() > CACHE_BYTES:
            self.forget()
        if self.cuts:
            two = pc.extract_regex(pieces, CUT)
            cut = two.is_valid()
            pieces, rest = pc.if_else(cut, two.field("letters"), pieces), pc.if_else(cut, two.field("rest"), "")
        else:
            rest = pa.array([""] * len(pieces), pa.string())
        opening = self._slots(pc.binary_join_element_wise(" ", pieces, ""), self._learn)
        slots = np.stack([opening, self._slots(rest, self._learn_each)], axis=1).ravel()
        length = self.length[slots]
        return _runs(self.flat, self.start[slots], length), length.reshape(-1, 2).sum(axis=1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another (null: empty), and where each text's begin, with the end last."""
        parts, ends, base = [], [np.zeros(1, np.int64)], 0
        for part in slices([pa.record_batch([texts], ["text"])], "text", AT_ONCE):
            ids, bounds = self._encode(part.column("text"))
            parts.append(ids)
            ends.append(bounds[1:] + base)
            base += len(ids)
        return np.concatenate(parts) if parts else np.empty(0, np.int32), np.concatenate(ends)

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another (null: empty), and where each text's begin, with the end last."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        n = len(texts)
        hard = pc.or_(pc.match_substring_regex(texts, RUN), pc.ends_with(texts, " "))
        for token in self.added:
            hard = pc.or_(hard, pc.match_substring(texts, token))
        hard = hard.to_numpy(zero_copy_only=False)
        easy = pc.if_else(pa.array(hard), "", texts) if hard.any() else texts
        lists = pc.split_pattern(easy, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        first = offsets[:-1]
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        inner = np.ones(len(codes), bool)
        inner[first] = False
        needed = np.zeros(len(coded.dictionary), bool)
        needed[codes[inner]] = True
        piece_ids, piece_length = self._pieces(coded.dictionary.filter(pa.array(needed)))
        heads = self.whole(texts.filter(pa.array(hard)).to_pylist()) if hard.any() else []
        heads_of_easy = self.whole(coded.dictionary.take(pa.array(codes[first])).to_pylist())
        taken = iter(heads)
        heads = [next(taken) if h else e for h, e in zip(hard, heads_of_easy)]
        head_length = np.array([len(h) for h in heads], np.int64)
        head_ids = np.fromiter(chain.from_iterable(heads), np.int32, int(head_length.sum()))
        start, length = np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
        own = (np.cumsum(needed) - 1)[codes[inner]]
        start[inner], length[inner] = (np.cumsum(piece_length) - piece_length)[own], piece_length[own]
        start[first] = len(piece_ids) + np.cumsum(head_length) - head_length
        length[first] = head_length
        ids = _runs(np.concatenate([piece_ids, head_ids]), start, length)
        ends = np.cumsum(length)
        bounds = np.concatenate([[0], ends])[offsets] if n else np.zeros(1, np.int64)
        return ids, bounds


def _runs(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``start``, one after another."""
    ends = np.concatenate([[0], np.cumsum(length)])
    shift = start - ends[:-1]
    out = np.empty(int(ends[-1]), flat.dtype)
    for a in range(0, len(length), RUNS):  # places of few runs at a time
        b = min(a + RUNS, len(length))
        out[ends[a] : ends[b]] = flat[np.arange(ends[a], ends[b]) + np.repeat(shift[a:b], length[a:b])]
    return out


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One for each worker process, as long as its tasks tokenize."""
    return Encoder(path)


KEPT.append(encoder)


def with_end(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with id ``end`` after every text."""
    n = len(bounds) - 1
    out = np.full(len(ids) + n, end, ids.dtype)
    keep = np.ones(len(out), bool)
    keep[bounds[1:] + np.arange(n)] = False
    out[keep] = ids
    return out, bounds + np.arange(n + 1)
