"""Distinct word shingles of whole texts as sorted 64-bit hashes, a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
S29, S32 = np.uint64(29), np.uint64(32)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word ``[^\\x20\\x09-\\x0D]+`` of the texts with A-Z lower-cased, and where each text's begin, with the end last."""
    import xxhash

    texts = pc.fill_null(texts.cast(pa.string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    offsets = offsets - offsets[0]
    distinct = coded.dictionary.to_pylist()
    empty = np.fromiter((not w for w in distinct), bool, len(distinct))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    if empty.any():
        keep = ~empty[codes]
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return hashes[codes], offsets


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingles of ``k`` words; with fewer words, the whole sequence as one."""
    words, offsets = word_hashes(texts)
    n = len(words)
    runs = words.copy()
    mixed = {1: runs.copy()}
    for i in range(1, k):
        runs = (runs ^ (runs >> S29)) * A
        runs[: max(0, n - i)] += words[i:] * B
        mixed[i + 1] = runs.copy() if i + 1 < k else runs
    for a, b in zip(offsets[:-1], offsets[1:]):
        size = min(k, b - a)
        own = mixed[size][a : b - size + 1] if size else words[:0]
        own = own ^ (own >> S32) ^ np.uint64(size)
        yield np.unique(own.view(np.int64))
